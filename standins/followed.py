"""A landing that grows, followed batch by batch and read back from its store."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.operators import infer, pairs
from corpusloom.settings import checkpoint_dir
from corpusloom.streaming.follow import follow, open_landing

from .base import query, table, text
from .landing import STRIDE, land


@query(
    "followed_awards",
    f"""
    WITH items AS (
      SELECT 1 AS page, c_custkey AS k, 'Award of ' || c_name AS title FROM customer WHERE c_custkey % 2 = 0
      UNION ALL
      SELECT 2, c_custkey, 'Later award of ' || c_name FROM customer WHERE c_custkey % 2 = 1 OR c_custkey % 10 = 0),
    placed AS (SELECT *, page * {STRIDE} + row_number() OVER (PARTITION BY page ORDER BY k) - 1 AS ordinal FROM items),
    firsts AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ordinal) AS n FROM placed)
    SELECT ordinal, k::varchar AS entity_id, 'What is ' || title || '?' AS question FROM firsts WHERE n = 1""",
)
def followed_awards(spark, sf):
    """Two pages that land one after the other; the second one repeats entities of the first."""
    c = table(spark, sf, "customer")
    base = f"{checkpoint_dir(spark).rstrip('/')}/followed-{uuid.uuid4().hex}"
    store = open_landing(spark, f"{base}/store", buckets=8)
    even = F.col("c_custkey") % 2 == 0
    landings = [
        (c.where(even), "Award of "),
        (c.where(~even | (F.col("c_custkey") % 10 == 0)), "Later award of "),
    ]
    for page, (rows, lead) in enumerate(landings, start=1):
        item = F.struct(text("c_custkey").alias("id"), F.concat(F.lit(lead), F.col("c_name")).alias("title"))
        lines = rows.select(F.lit(page).alias("page"), F.col("c_custkey").alias("o"), F.to_json(item).alias("line"))
        land(lines, '{"response":{"award":[', "]}}", folder=f"{base}/pages/{page}")
        follow(store, "nsf-awards", f"{base}/pages/*/*", infer.echo_backend).awaitTermination()
    found = store.read("pairs").join(store.read("taken").select("ordinal", "entity_id"), "ordinal")
    return found.select("ordinal", "entity_id", pairs.question_of().alias("question"))
