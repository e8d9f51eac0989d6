"""Reproducible global shuffle into shards: a Feistel permutation over global row numbers.

Only DataFrame and SQL functions are used. Rows get their number from an exact distributed rank (range
partitioning plus a running sum over one small row per slice); the permutation itself is arithmetic on
that number, so the place of any row can be computed from (row number, row count, seed) alone, and the
inverse as well, without looking at other rows.
"""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import positions

#: All arithmetic is modulo this prime, so every product stays below 2^62.
PRIME = 2**31 - 1
ROUNDS = 6
#: Cycle-walking steps tried for every row that left the domain, before the exact bound is used.
FIRST_WALK = 16


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three odd-looking constants below PRIME for each round, from the seed."""
    keys = []
    for i in range(rounds):
        digest = hashlib.sha256(f"{seed}:{i}".encode()).digest()
        keys.append(tuple(1 + int.from_bytes(digest[8 * k : 8 * k + 8], "big") % (PRIME - 1) for k in range(3)))
    return keys


def sides(n: int) -> tuple[int, int]:
    """The two moduli of the network: a * b >= n, and a * b - n < a."""
    a = max(1, isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def mixed(v: Column, key: Column) -> Column:
    """Round function: a keyed quadratic map modulo PRIME."""
    t = F.pmod((v + key["add"]) * key["mul"], F.lit(PRIME))
    return F.pmod(t * t + key["end"], F.lit(PRIME))


def feistel(x: Column, n: int, seed: int) -> Column:
    """One pass of the network: a bijection of 0 .. a*b-1."""
    a, b = sides(n)
    keys = F.array(
        *[
            F.struct(
                F.lit(add).cast("long").alias("add"),
                F.lit(mul).cast("long").alias("mul"),
                F.lit(end).cast("long").alias("end"),
                F.lit(i % 2 == 0).alias("even"),
            )
            for i, (add, mul, end) in enumerate(round_keys(seed))
        ]
    )
    start = F.struct(
        F.pmod(x, F.lit(a)).cast("long").alias("l"),
        F.call_function("div", x, F.lit(a).cast("long")).alias("r"),
    )

    def turn(s: Column, k: Column) -> Column:
        return F.struct(
            F.when(k["even"], F.pmod(s["l"] + mixed(s["r"], k), F.lit(a))).otherwise(s["l"]).alias("l"),
            F.when(k["even"], s["r"]).otherwise(F.pmod(s["r"] + mixed(s["l"], k), F.lit(b))).alias("r"),
        )

    return F.aggregate(keys, start, turn, lambda s: s["r"] * F.lit(a) + s["l"])


def permuted(x: Column, n: int, seed: int) -> Column:
    """``x`` (0 .. n-1) under a permutation of 0 .. n-1.

    Results outside the domain are walked on along their cycle. A walk can meet each of the
    a*b - n outside values once at most, which bounds its length; that bound is only spent on rows
    that are still outside after the first steps.
    """
    a, b = sides(n)
    outside = a * b - n

    def walk(y: Column, steps: int) -> Column:
        path = F.when(y >= n, F.sequence(F.lit(1), F.lit(steps))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(path, y, lambda z, _: F.when(z >= n, feistel(z, n, seed)).otherwise(z))

    def settled(y: Column) -> Column:
        return walk(y, min(outside, FIRST_WALK)) if outside else y

    # the one-element aggregates only bind an intermediate value, so that it is computed once
    once = F.array(F.lit(0))
    near = F.aggregate(once, x.cast("long"), lambda z, _: feistel(z, n, seed), settled)
    if outside <= FIRST_WALK:
        return near
    return F.aggregate(once, near, lambda z, _: z, lambda z: walk(z, outside))


def shuffled(df: DataFrame, order: list[Column], shards: int, seed: int = 0) -> DataFrame:
    """All rows with ``row_number`` (0-based rank by ``order``), ``shard`` and ``slot``.

    Shard sizes differ by one at most, slots are gapless from 0 in every shard, and
    ``permuted = slot * shards + shard``. Rows that tie in ``order`` are numbered in any order; NULLs
    come first. An empty table gives an empty result. Columns named like the results are replaced.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    keep = [c for c in df.columns if c not in ("row_number", "shard", "slot")]
    # own names while the rows are laid out: any column of the input may be called like ours
    inner = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"),
        *[c.alias(f"o{i}") for i, c in enumerate(order)],
    )
    placed = positions(inner, [], [f"o{i}" for i in range(len(order))])
    n = placed.select("members").limit(1).collect()
    n = n[0][0] if n else 0
    number = (F.col("position") - 1).cast("long")
    return (
        placed.withColumn("at", number)
        .withColumn("to", permuted(F.col("at"), n, seed) if n else F.col("at"))
        .select(
            *[F.col("doc").getField(c).alias(c) for c in keep],
            F.col("at").alias("row_number"),
            F.pmod("to", F.lit(shards)).cast("int").alias("shard"),
            F.expr(f"`to` div {shards}").cast("long").alias("slot"),
        )
    )


def document_shards(docs: DataFrame, shards: int = 24, seed: int = 0) -> DataFrame:
    """Size, checksum and place of every document; the text itself is not shuffled.

    A NULL text has no bytes: size 8, checksum 0. Rows with the same id are told apart by their text;
    equal rows take neighbouring row numbers.
    """
    narrow = docs.select(
        F.col("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64("text").alias("tie"),
    )
    return shuffled(narrow, [F.col("doc_id"), F.col("tie")], shards, seed).select(
        "doc_id",
        (F.col("bytes") + 8).alias("size"),
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
