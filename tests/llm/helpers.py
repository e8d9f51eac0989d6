"""Small tables shared by the tests of the training-data operators."""

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves
CLASHING = "shard int, slot long, tie long, h long, score double, _row long, position long, epoch long, doc string"


def odd_docs(spark):
    """NULLs in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
    rows = [
        (None, None, None, None, None),
        (1, "", "en", "src0", 0),
        (1, "", "en", "src0", 0),
        (2, "a few plain words in one short text", "en", "src0", 35),
        (2, "a few plain words in one short text", "en", "src0", 35),
        (2, "another text under an id that is taken", None, "src1", 1),
        (3, "a few plain words in one short text", "de", None, None),
        (4, long_text, "en", "src0", len(long_text)),
        (5, " \n\t ", "fr", "odd", 4),
        (6, "x" * 300_000, "en", "src0", 300_000),
        (None, "text without an id, twice over", "en", "src0", 5),
    ]
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 0.5, 6, 7, 8, "doc") for r in rows], f"{COLUMNS}, {CLASHING}")


def empty_docs(spark):
    return spark.createDataFrame([], f"{COLUMNS}, {CLASHING}")


def of_texts(spark, texts, start=0):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts, start)]
    return spark.createDataFrame(rows, COLUMNS)
