"""JSON expressions: canonical form and hash, strict parses of model output, layout for readers."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHORT_HASH = 16


def sort_fields(c: Column, dtype: T.DataType) -> Column:
    """Rebuild nested structs with their fields in alphabetical order, at every depth."""
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        rebuilt = F.struct(*[sort_fields(c[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(c.isNotNull(), rebuilt)
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StructType, T.ArrayType)):
        return F.transform(c, lambda x: sort_fields(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(c)))
    return c


def canonical_json(c: Column, dtype: T.DataType) -> Column:
    return F.to_json(sort_fields(c, dtype))


def content_hash(c: Column, dtype: T.DataType) -> Column:
    """Full SHA-256 of the key-sorted JSON; the short form is its prefix."""
    return F.sha2(canonical_json(c, dtype), 256)


def short_hash(full: Column) -> Column:
    return F.substring(full, 1, SHORT_HASH)


def bracketed(text: Column) -> Column:
    """From the first ``[`` to the last ``]`` of a text, NULL when there is no such span."""
    first = F.instr(text, "[")
    last = F.length(text) - F.instr(F.reverse(text), "]") + 1
    there = (first > 0) & text.contains("]") & (last > first)
    return F.when(there, F.substring(text, first, last - first + 1))


def parse_array(df: DataFrame, text: str, out: str, element: str) -> DataFrame:
    """Adds ``<out>_raw``: the one JSON array in a text, NULL when there is none or more than that;
    and ``<out>_span``: the text it was read from.

    A plain ``from_json`` ignores whatever follows the first value. So the span is put inside an
    array inside an object with a second field: text after the array breaks the parse, makes a
    second element, or closes the object before the second field. Every step is a column of its
    own, so that nothing is parsed twice.
    """
    span, wrapped = f"{out}_span", f"_{out}_wrapped"
    whole = F.col(wrapped)["end"] & (F.size(F.col(wrapped)["only"]) == 1)
    return (
        df.withColumn(span, bracketed(F.col(text)))
        .withColumn(
            wrapped,
            F.from_json(
                F.concat(F.lit('{"only":['), F.col(span), F.lit('],"end":true}')),
                f"only array<array<{element}>>, end boolean",
            ),
        )
        .withColumn(f"{out}_raw", F.when(whole, F.get(F.col(wrapped)["only"], F.lit(0))))
        .drop(wrapped)
    )


QA_ITEM = "struct<question:string,answer:string>"


def parse_qa(df: DataFrame, text: str, out: str, whole_items: bool = False) -> DataFrame:
    """Adds ``<out>_state`` (none, ok or malformed) and ``<out>_items`` for a model answer.

    With ``whole_items`` an item without question or answer spoils the answer, as in the first
    pass.
    """
    raw, state = F.col(f"{out}_raw"), F.col(f"{out}_state")

    def broken(x: Column) -> Column:
        if whole_items:
            return x.isNull() | x["question"].isNull() | x["answer"].isNull()
        return x.isNull()

    none = F.array().cast(f"array<{QA_ITEM}>")
    return (
        parse_array(df, text, out, QA_ITEM)
        .withColumn(
            f"{out}_state",
            F.when(F.col(f"{out}_span").isNull(), F.lit("none"))
            .when(raw.isNull() | F.exists(raw, broken), F.lit("malformed"))
            .otherwise(F.lit("ok")),
        )
        .withColumn(f"{out}_items", F.when(state == "ok", raw).otherwise(none))
        .drop(f"{out}_raw", f"{out}_span")
    )


def parse_scores(df: DataFrame, text: str, out: str = "scores") -> DataFrame:
    """Adds ``out``: the judge entries as ``array<struct(pair_id, f, r, c, issues)>``, NULL when
    there is no readable array.

    Elements are read as maps so that a missing score (counts as 0) and an explicit null or a
    non-number (leaves the pair unscored) stay apart.
    """

    def score(m: Column, name: str) -> Column:
        given = F.map_contains_key(m, F.lit(name))
        return F.when(given, F.trim(m[name]).try_cast("double")).otherwise(F.lit(0.0))

    def entry(m: Column) -> Column:
        issues = F.from_json(m["issues"], "array<string>")
        none = F.array().cast("array<string>")
        return F.struct(
            m["pair_id"].alias("pair_id"),
            score(m, "faithfulness").alias("faithfulness"),
            score(m, "relevance").alias("relevance"),
            score(m, "completeness").alias("completeness"),
            F.when(F.map_contains_key(m, F.lit("issues")), issues).otherwise(none).alias("issues"),
        )

    usable = F.filter(f"_{out}_raw", lambda m: m.isNotNull() & m["pair_id"].isNotNull())
    return (
        parse_array(df, text, f"_{out}", "map<string,string>")
        .withColumn(out, F.transform(usable, entry))
        .drop(f"_{out}_raw", f"_{out}_span")
    )


def filled(c: Column) -> Column:
    """The text, or NULL when it is empty, so that an empty field disappears from the JSON."""
    return F.nullif(c, F.lit(""))


def filled_variant(c: Column) -> Column:
    """A VARIANT field, or NULL when its value is empty (null, '', 0, false, [] or {})."""
    return F.when(~F.to_json(c).isin("null", '""', "0", "0.0", "false", "[]", "{}"), c)


def filled_array(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def _indented(text: str) -> str:
    try:
        return json.dumps(json.loads(text), indent=2)
    except ValueError:
        return text


@F.pandas_udf(T.StringType())
def indent_json(texts: pd.Series) -> pd.Series:
    """Two-blank indented, ASCII-only layout in the order of the text's own fields, which no built-in
    writer keeps; what is not JSON passes through unchanged."""
    return texts.map(_indented, na_action="ignore")
