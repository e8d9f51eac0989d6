"""Scans of landed catalog responses, one JSON document per file. Usual pages are read whole and exploded,
documents above ``LARGE`` bytes in ranges (``bodies``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import positions
from . import bodies

ENVELOPE = "content array<struct<type:string,text:string>>"
# arrival position = page number * PAGE_STRIDE + position on the page
PAGE_STRIDE = 1 << 32
#: Larger documents are read in ranges by many tasks.
LARGE = 64 << 20


def natural(path: Column) -> Column:
    """Sort key of a path in which numbers count as numbers, however long they are."""
    wide = F.regexp_replace(path, r"(\d+)", "0" * 40 + "$1")
    return F.regexp_replace(wide, r"\d*(\d{40})", "$1")


def numbered(pages: DataFrame) -> DataFrame:
    """``pages`` (path, value) with ``page``: the rank of its path, in natural order."""
    ranks = pages.select("path").distinct()
    ranks = ranks.withColumn("page", F.row_number().over(Window.orderBy(natural(F.col("path")), "path")).cast("bigint"))
    return pages.join(ranks, "path")


def plain(path: Column) -> Column:
    """A path as both readers write it: one writes a local path with one slash, one with three."""
    return F.regexp_replace(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")


def ranked(spark: SparkSession, path: str) -> DataFrame:
    """Landed files as ``path, page, bytes``: the rank in natural path order. Paths are distinct, so pages
    never tie, whatever the files are called."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    order = Window.orderBy(natural(F.col("path")), "path")  # one small row per file
    return listed.select(
        plain(F.col("path")).alias("path"), F.row_number().over(order).cast("bigint").alias("page"), F.col("length").alias("bytes")
    )


def read_pages(spark: SparkSession, path: str, large: int | None = None) -> DataFrame:
    """Landed files as ``page, key, value``: rank of the file, stem of its name, the text. Files above
    ``large`` bytes are left out (and not read)."""
    texts = spark.read.text(path, wholetext=True)
    if large is not None:
        texts = texts.where(F.col("_metadata.file_size") <= large)
    texts = texts.select(
        plain(F.col("_metadata.file_path")).alias("path"),
        F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "").alias("key"),
        "value",
    )
    return texts.join(ranked(spark, path), "path").select("page", "key", "value")


def read_lines(spark: SparkSession, path: str, page: int = 1) -> DataFrame:
    """JSON-lines files (one item per line), which Spark can split, as items of one page: ``ordinal`` is
    the rank of (file, line offset) as far as Spark's row order inside a file goes."""
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    rows = rows.where(F.trim("value") != "").select(natural(F.col("path")).alias("file"), "block", "at", "value")
    ranked = positions(rows, [], ["file", "block", "at"])
    return ranked.select((F.lit(page * PAGE_STRIDE) + F.col("position") - 1).alias("ordinal"), "value")


def unwrap(pages: DataFrame) -> DataFrame:
    """Adds ``body``: the text inside a tool-response envelope; anything else passes through."""
    first = F.get(F.col("_envelope")["content"], F.lit(0))
    inner = F.coalesce(first["text"], F.lit(""))
    body = F.when(first["type"] == "text", inner).otherwise(F.col("value"))
    return pages.withColumn("_envelope", F.from_json("value", ENVELOPE)).withColumn("body", body).drop("_envelope")


def body_type(item_type: str, keys: tuple[str, ...]) -> str:
    """One type with all the list keys, so that a body is parsed once."""
    fields = []
    for key in keys:
        head, _, tail = key.partition(".")
        listed = f"array<{item_type}>"
        fields.append(f"`{head}` " + (f"struct<`{tail}`:{listed}>" if tail else listed))
    return ", ".join(fields)


def explode_items(pages: DataFrame, item_type: str, keys: tuple[str, ...]) -> DataFrame:
    """Pages (``page, value``) to one row per item: ``ordinal`` plus the item's fields.

    The first present list among ``keys`` counts; a dotted key looks one level down. The outer
    explode is on purpose: the plain one would add a test of the list and parse the page twice.
    """
    bare = F.ltrim("body").startswith("[")  # a body may also be the list itself
    parsed = unwrap(pages).withColumn("_b", F.from_json(F.when(~bare, F.col("body")), body_type(item_type, keys)))
    parsed = parsed.withColumn("_l", F.from_json(F.when(bare, F.col("body")), f"array<{item_type}>"))
    listed = F.coalesce(*[F.col(f"_b.{key}") for key in keys], F.col("_l"))
    items = parsed.select("page", F.posexplode_outer(listed).alias("pos", "item"))
    return items.where("pos IS NOT NULL").select(
        (F.col("page") * F.lit(PAGE_STRIDE) + F.col("pos")).alias("ordinal"), "item.*"
    )


def page_total(pages: DataFrame) -> DataFrame:
    """First page only, with ``pages``: the number of pages it announces (1 when it does not)."""
    first = unwrap(pages.where("page = 1"))
    announced = F.from_json("body", "pages bigint")["pages"]
    return first.select("page", "value", F.coalesce(announced, F.lit(1)).alias("pages"))


def explode_details(pages: DataFrame, detail_type: str) -> DataFrame:
    """Per-entity detail responses (``key, value``) to ``entity_id, detail``; unreadable ones
    have NULL fields."""
    return unwrap(pages).select(
        F.col("key").alias("entity_id"), F.from_json("body", detail_type).alias("detail")
    )


def scan_items(
    spark: SparkSession, path: str, item_type: str, keys: tuple[str, ...], large: int = LARGE
) -> DataFrame:
    """Items of all landed files with their arrival position. Documents above ``large`` bytes give the same
    rows as small ones: the size only chooses who reads them."""
    if not ranked(spark, path).where(F.col("bytes") > large).take(1):
        return explode_items(read_pages(spark, path), item_type, keys)
    small = explode_items(read_pages(spark, path, large), item_type, keys)
    return small.unionByName(explode_bodies(spark, path, item_type, keys, large))


def explode_bodies(spark: SparkSession, path: str, item_type: str, keys: tuple[str, ...], large: int) -> DataFrame:
    """``explode_items`` for the documents above ``large`` bytes."""
    found = bodies.listed(bodies.large_rows(spark, path, large), keys)
    found = found.withColumn("path", plain(F.col("path"))).join(ranked(spark, path), "path")
    ordinal = F.col("page") * F.lit(PAGE_STRIDE) + F.col("position")
    return found.select(ordinal.alias("ordinal"), F.from_json("text", item_type).alias("item")).select("ordinal", "item.*")


def scan_details(spark: SparkSession, path: str, detail_type: str) -> DataFrame:
    return explode_details(read_pages(spark, path), detail_type)
