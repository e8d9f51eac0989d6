"""Text expressions. All of them are built-in column functions and stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: patterns, markers and word lists ----------------------------------------
TAG = "<[^>]+>"
SPACE = r"[\s\x1c-\x1f]"  # with (?U): the Unicode white space set including the ASCII separators
INTEGER = r"(?U)^[\s\x1c-\x1f]*[+-]?[0-9]+(_[0-9]+)*[\s\x1c-\x1f]*$"
SLUG_WIDTH = 30
GPU_MODEL = r"(?U)(A100|V100|H100|A40|A30|A10|RTX\s*\d+)"
GPU_VENDOR = "NVIDIA "
NODE_GPU_PATTERNS = [
    r"(?iU)NVIDIA\s+([A-Z]\d+\s*\d*\s*(?:GB)?)",
    r"(?iU)(A100|V100|H100|A40|A30|RTX\s*\d+)",
]
STATUS_TAIL = r"(?iUd)\s*-\s*(COMING SOON|RETIRED|BETA).*$"
SOON_NOTE = r"(?iU)\s*\(coming soon\)"
CITATION = "<<SRC:([^:>]+):([^>]+)>>"
CITATION_START = "<<SRC:"
# ----------------------------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Trim Unicode white space on both ends (``trim`` alone only knows the blank)."""
    return F.regexp_replace(c, f"(?U)^{SPACE}+|{SPACE}+$", "")


def strip_html(c: Column) -> Column:
    """Drop tags, collapse white space, trim; NULL and the empty text pass through."""
    untagged = F.regexp_replace(c, TAG, "")
    return F.trim(F.regexp_replace(untagged, f"(?U){SPACE}+", " "))


def slugify(c: Column) -> Column:
    words = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_")
    return F.substring(F.btrim(words, F.lit("_")), 1, SLUG_WIDTH)


def truncate(c: Column, width: int) -> Column:
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("..."))).otherwise(c)


def format_currency(c: Column) -> Column:
    """Integer text of any length to ``$1,234,567``; other text stays as it is; NULL gives ''."""
    digits = F.ltrim(F.regexp_replace(c, "[^0-9]+", ""), F.lit("0"))
    zero = digits == ""
    # up to 18 digits fit a number; longer ones are grouped as text
    short = F.format_number(F.when(F.length(digits) <= 18, digits).try_cast("bigint"), 0)
    long = F.regexp_replace(digits, "(?<=[0-9])(?=([0-9]{3})+$)", ",")
    grouped = F.when(zero, "0").when(F.length(digits) <= 18, short).otherwise(long)
    sign = F.when(c.contains("-") & ~zero, "-").otherwise("")
    money = F.concat(F.lit("$"), sign, grouped)
    return F.coalesce(F.when(c.rlike(INTEGER), money).otherwise(c), F.lit(""))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest."""
    runs = F.regexp_extract_all(c, F.lit(r"([\p{L}]+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def name_list(names: Column) -> Column:
    """``A`` / ``A and B`` / ``A, B, and C``."""
    size = F.size(names)
    last = F.element_at(names, -1)
    head = F.array_join(F.slice(names, F.lit(1), F.greatest(size - 1, F.lit(0))), ", ")
    return (
        F.when(size == 1, last)
        .when(size == 2, F.concat(head, F.lit(" and "), last))
        .otherwise(F.concat(head, F.lit(", and "), last))
    )


def normalize_gpu(c: Column) -> Column:
    model = F.regexp_extract(F.upper(strip(c)), GPU_MODEL, 1)
    return F.when(model != "", F.concat(F.lit(GPU_VENDOR), model)).otherwise(F.lit(""))


def soften_label(c: Column) -> Column:
    """Tone down the upper-case announcement in a resource name but keep the information."""
    softened = F.replace(
        F.replace(c, F.lit("- COMING SOON"), F.lit("(coming soon)")),
        F.lit("COMING SOON"),
        F.lit("(coming soon)"),
    )
    return F.when(c.contains("COMING SOON"), strip(softened)).otherwise(c)


def clean_name(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, STATUS_TAIL, ""), SOON_NOTE, ""))


def display_name(name: Column, description: Column) -> Column:
    """For an all-lower-case name, the casing its first whole-word mention in the description has."""
    quoted = F.regexp_replace(name, r"([\\.\[\]{}()*+\-?^$|#&~])", r"\\$1")
    pattern = F.concat(F.lit(r"(?iU)(\b"), quoted, F.lit(r"\b)"))
    mention = F.call_function("regexp_extract", description, pattern, F.lit(1))
    is_lower = (F.lower(name) == name) & name.rlike(r"\p{Ll}")
    return F.when(
        is_lower & (F.coalesce(description, F.lit("")) != "") & (mention != ""), mention
    ).otherwise(name)


def complexity(question: Column, keywords: list[str]) -> Column:
    lowered = F.lower(question)
    hit = F.lit(False)
    for word in keywords:
        hit = hit | lowered.contains(word)
    return F.when(hit, F.lit("moderate")).otherwise(F.lit("simple"))


def has_citation(answer: Column) -> Column:
    return answer.contains(CITATION_START)


def citation(domain: Column, entity_id: Column) -> Column:
    return F.concat(F.lit(CITATION_START), domain, F.lit(":"), entity_id, F.lit(">>"))


def split_citation(raw: Column) -> Column:
    """``<<SRC:domain:id>>`` to a struct; the domain ends at the first colon."""
    body = F.substring(raw, F.lit(len(CITATION_START) + 1), F.length(raw) - 8)
    domain = F.substring_index(body, ":", 1)
    entity_id = F.substring(body, F.length(domain) + 2, F.length(body))
    return F.struct(raw.alias("raw"), domain.alias("domain"), entity_id.alias("entity_id"))


def citation_markers(answer: Column) -> Column:
    """All markers of a text in order, found in one pass."""
    return F.regexp_extract_all(answer, F.lit(CITATION), F.lit(0))


def parse_citation(raw: Column) -> Column:
    """A marker the text *starts* with, else NULL; ``raw`` keeps the whole text."""
    marker = split_citation(F.regexp_extract(raw, f"^{CITATION}", 0))
    parsed = F.struct(raw.alias("raw"), marker["domain"].alias("domain"), marker["entity_id"].alias("entity_id"))
    return F.when(raw.rlike(f"^{CITATION}"), parsed)
