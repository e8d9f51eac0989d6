"""Model answers kept in a ledger: resumed asking, both passes with failures and malformed answers."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from corpusloom.operators import infer, pairs
from corpusloom.operators.domains import REGISTRY
from corpusloom.operators.ledger import Ledger
from corpusloom.settings import checkpoint_dir

from .base import query, table, text


def new_ledger(spark, tag=""):
    return Ledger(spark, f"{checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}", tag)


@query(
    "ledger_answers",
    """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN 'first ' || o_orderpriority || '/32: ' || (o_custkey % 500) END AS text,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'ValueError: low' END AS error FROM orders""",
)
def ledger_answers(spark, sf):
    """Equal prompts of many rows are asked once; what a first run answered keeps that answer in the next."""

    def backend(word):
        def factory():
            def call(system: str, user: str, max_tokens: int) -> str:
                if system == "5-LOW":
                    raise ValueError("low")
                return f"{word} {system}/{max_tokens}: {user}"

            return call

        return factory

    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("system"), text(F.col("o_custkey") % 500).alias("user")
    )
    book = new_ledger(spark)
    book.answered(rows, backend("first"), 32)
    return book.answered(rows, backend("second"), 32)


@query(
    "ledger_two_pass",
    """WITH c AS (SELECT *, c_custkey % 7 AS a, c_custkey % 5 AS b FROM customer),
       made AS (SELECT *, unnest(CASE WHEN b = 0 THEN [1, 2] ELSE [1] END) AS seq FROM c WHERE a > 1 AND b NOT IN (1, 2))
       SELECT 'nsf-awards_' || c_custkey || '_' || seq AS id, 'Pass ' || seq || ' of ' || c_name || '?' AS question,
         NULL::varchar AS stage FROM made
       UNION ALL SELECT c_custkey::varchar, 'ValueError: first', 'battery' FROM c WHERE a = 0
       UNION ALL SELECT c_custkey::varchar, 'ValueError: second', 'discovery' FROM c WHERE a > 1 AND b = 1""",
)
def ledger_two_pass(spark, sf):
    """Both passes with items, failed calls and malformed answers in either."""

    def backend():
        def call(system: str, user: str, max_tokens: int) -> str:
            head = dict(line.split(": ", 1) for line in user.split("\n")[:3])
            number, name = int(head["Entity ID"]), head["Entity name"]
            if "Pairs so far:" in system:
                if number % 5 == 1:
                    raise ValueError("second")
                if number % 5 == 2:
                    return '[{"question": "cut"]'
                return json.dumps([{"question": f"Pass 2 of {name}?", "answer": "Yes."}] if number % 5 == 0 else [])
            if number % 7 == 0:
                raise ValueError("first")
            if number % 7 == 1:
                return '[{"question": "no answer"}]'
            return json.dumps([{"question": f"Pass 1 of {name}?", "answer": "Yes."}])

        return call

    rows = table(spark, sf, "customer").select(
        F.lit("nsf-awards").alias("domain"),
        text("c_custkey").alias("entity_id"),
        F.col("c_name").alias("entity_name"),
        F.col("c_custkey").alias("ordinal"),
        F.to_json(F.struct("c_mktsegment")).alias("entity_json"),
        F.to_json(F.struct("c_mktsegment")).alias("source_data"),
        F.lit("0").alias("source_hash"),
    )
    made = infer.two_pass(rows, REGISTRY["nsf-awards"], backend, ledger=new_ledger(spark))
    asked = pairs.explode_pairs(made).select("id", pairs.question_of().alias("question"), F.lit(None).cast("string").alias("stage"))
    return asked.unionAll(infer.failures(made).select("entity_id", "message", "stage"))
