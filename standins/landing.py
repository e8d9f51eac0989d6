"""Scans of landed files: tables are written as JSON documents below the shared folder, one per page, and
scanned from there."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.operators import domains
from corpusloom.settings import checkpoint_dir
from corpusloom.sources import landed

from .base import query, table, text

STRIDE = landed.PAGE_STRIDE
# keys on a page; documents above LARGE bytes are read in ranges
PAGE = 100_000
LARGE = 100_000


def escaped(line):
    """A text as it stands inside a JSON string."""
    quoted = F.to_json(F.array(line))
    return F.substring(quoted, F.lit(3), F.length(quoted) - 4)


def land(rows, head, tail, inner=lambda line: line, folder=None):
    """``rows`` (page, o, line) as one document per page: items in the order of ``o`` between ``head`` and
    ``tail``. Returns the folder, a new one by default."""
    folder = folder or f"{checkpoint_dir(rows.sparkSession).rstrip('/')}/landed-{uuid.uuid4().hex}"
    place = F.row_number().over(W.partitionBy("page").orderBy("o"))
    lines = rows.withColumn("n", place).select("page", "n", inner(F.concat(F.when(F.col("n") > 1, ",").otherwise(""), "line")).alias("value"))
    edges = rows.select("page").distinct().select(
        "page",
        F.explode(F.array(F.struct(F.lit(0).alias("n"), F.lit(head).alias("value")), F.struct(F.lit(2147483647).alias("n"), F.lit(tail).alias("value")))).alias("e"),
    ).select("page", "e.n", "e.value")
    # a page is one file, so one task writes it; a page has at most PAGE rows
    whole = lines.unionAll(edges).repartition("page").sortWithinPartitions("page", "n")
    whole.select("page", "value").write.partitionBy("page").option("lineSep", " ").text(folder)
    return folder


def scan(spark, folder, name, large=LARGE):
    spec = domains.REGISTRY[name]
    return landed.scan_items(spark, f"{folder}/*", spec.item_type, spec.list_keys, large)


def ordinal_sql(key: str) -> str:
    return f"""dense_rank() OVER (ORDER BY {key} // {PAGE}) * {STRIDE}
      + row_number() OVER (PARTITION BY {key} // {PAGE} ORDER BY {key}) - 1"""


@query(
    "landed_projects",
    f"""SELECT {ordinal_sql("o_orderkey")} AS ordinal, o_orderkey::varchar AS project_id, 'by "' || o_clerk || '" }}],' AS pi,
          o_orderstatus AS fos, 'disk ' || o_orderkey || '|tape' AS resources
        FROM (SELECT *, coalesce(o_orderpriority, '') AS o_clerk FROM orders)""",
)
def landed_projects(spark, sf):
    """Large documents with nested lists and texts that look like structure, read in ranges."""
    o = table(spark, sf, "orders")
    unit = lambda name: F.struct(name.alias("resourceName"))
    item = F.struct(
        text("o_orderkey").alias("projectId"),
        F.concat(F.lit('by "'), F.coalesce("o_orderpriority", F.lit("")), F.lit('" }],')).alias("pi"),
        F.col("o_orderstatus").alias("fos"),
        F.array(unit(F.concat(F.lit("disk "), text("o_orderkey"))), unit(F.lit("tape"))).alias("resources"),
    )
    rows = o.select(F.floor(F.col("o_orderkey") / PAGE).alias("page"), F.col("o_orderkey").alias("o"), F.to_json(item).alias("line"))
    found = scan(spark, land(rows, '{"pages":9,"projects":[', "]}"), "allocations")
    return found.select(
        "ordinal", F.col("projectId").alias("project_id"), "pi", "fos", F.array_join("resources.resourceName", "|").alias("resources")
    )


@query(
    "landed_resources",
    f"""SELECT {ordinal_sql("p_partkey")} AS ordinal, p_partkey::varchar AS id, p_name || ' \\ "é"' AS name, p_brand AS organization
        FROM part""",
)
def landed_resources(spark, sf):
    """The same inside a tool-response envelope: the document is an escaped string of another."""
    p = table(spark, sf, "part")
    item = F.struct(
        text("p_partkey").alias("id"), F.concat("p_name", F.lit(' \\ "é"')).alias("name"), F.array("p_brand").alias("organization_names")
    )
    rows = p.select(F.floor(F.col("p_partkey") / PAGE).alias("page"), F.col("p_partkey").alias("o"), F.to_json(item).alias("line"))
    head, tail = '{"content":[{"type":"text","text":"{\\"resources\\":[', ']}"}]}'
    found = scan(spark, land(rows, head, tail, escaped), "compute-resources")
    return found.select("ordinal", "id", "name", F.array_join("organization_names", ",").alias("organization"))


@query(
    "landed_awards",
    f"""SELECT {ordinal_sql("c_custkey")} AS ordinal, c_custkey::varchar AS id, 'Award of ' || c_name AS title FROM customer""",
)
def landed_awards(spark, sf):
    """Documents below the limit, each read whole."""
    c = table(spark, sf, "customer")
    item = F.struct(text("c_custkey").alias("id"), F.concat(F.lit("Award of "), F.col("c_name")).alias("title"))
    rows = c.select(F.floor(F.col("c_custkey") / PAGE).alias("page"), F.col("c_custkey").alias("o"), F.to_json(item).alias("line"))
    found = scan(spark, land(rows, '{"response":{"award":[', "]}}"), "nsf-awards", landed.LARGE)
    return found.select("ordinal", "id", "title")
