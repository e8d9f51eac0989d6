"""Mixing sources to target weights by hierarchical budgeting over a domain / language / source tree.

Only DataFrame and SQL functions are used. Token budgets flow down the tree: every node shares its
budget among its children in proportion to their weights. A child never gets more than its capacity
(its tokens times the permitted epochs); what it cannot use goes to its siblings first, and only what
all siblings together cannot use is passed to the siblings of the ancestors, because a node's own
capacity is the sum of its children's. Sharing is exact integer water filling, done with windows over
siblings. A leaf takes whole epochs of its documents, then the prefix of one more seeded epoch that
fits the rest of its budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..settings import written

LEVELS = ["domain", "lang", "source"]
NONE = "(none)"
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the order key that name a bucket: a hot leaf's running sum is over 4096 totals, and
#: only the one bucket in which its prefix ends is looked at row by row.
BUCKET = 3


def words(text: Column) -> Column:
    """Number of white-space separated words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document within a seeded epoch: 32 hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def weight_of(weights: dict[tuple[str, ...], int], path: list[Column]) -> Column:
    """Integer weight of the tree node at ``path``; 1 where ``weights`` names none.

    A key is a full path or ends a path that starts with "*" (any parents).
    """
    depth = len(path)
    exact = {k: v for k, v in weights.items() if len(k) == depth and k[0] != "*"}
    anywhere = {k[1:]: v for k, v in weights.items() if k[0] == "*" and len(k) == 2}
    found = F.lit(None).cast("long")
    for table, key in ((exact, path), (anywhere, path[-1:])):
        if table:
            pairs = [F.lit(x) for k, v in table.items() for x in ("\x1f".join(k), int(v))]
            found = F.coalesce(found, F.element_at(F.create_map(*pairs), F.concat_ws("\x1f", *key)).cast("long"))
    return F.coalesce(found, F.lit(1).cast("long"))


def fill(nodes: DataFrame, parents: list[str], budget: str, cap: str, weight: str, out: str) -> DataFrame:
    """Share ``budget`` (equal on all siblings, never above their caps' sum) among siblings.

    In the order of cap / weight the children that take their whole cap are a prefix; the others take
    shares of the rest in proportion to their weights, rounded down, and the first of them one more
    until nothing is left. Children of weight 0 get nothing; their cap must be 0.
    """
    name = [c for c in LEVELS if c in nodes.columns][-1]
    siblings = W.partitionBy(*parents)
    order = siblings.orderBy("_ratio", name)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onwards = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    steps = (
        nodes.withColumn("_ratio", F.when(F.col(weight) > 0, F.col(cap) / F.col(weight)).otherwise(F.lit(0.0)))
        .withColumn("_before", F.coalesce(F.sum(cap).over(before), F.lit(0)))
        .withColumn("_rest", F.sum(weight).over(onwards))
        .withColumn(
            "_full",
            (F.col(cap) == 0) | (F.col(cap) * F.col("_rest") <= (F.col(budget) - F.col("_before")) * F.col(weight)),
        )
        .withColumn("_taken", F.sum(F.when(F.col("_full"), F.col(cap)).otherwise(0)).over(siblings))
        .withColumn("_open", F.sum(F.when(F.col("_full"), 0).otherwise(F.col(weight))).over(siblings))
        .withColumn("_left", F.col(budget) - F.col("_taken"))
        .withColumn("_share", F.when(F.col("_full"), F.col(cap)).otherwise(F.expr(f"({weight} * _left) div _open")))
        .withColumn("_crumbs", F.col(budget) - F.sum("_share").over(siblings))
        .withColumn("_turn", F.row_number().over(W.partitionBy(*parents, "_full").orderBy("_ratio", name)))
        .withColumn(out, F.col("_share") + F.when(~F.col("_full") & (F.col("_turn") <= F.col("_crumbs")), 1).otherwise(0))
    )
    return steps.drop(*[c for c in steps.columns if c.startswith("_")])


def budgets(
    units: DataFrame, weights: dict[tuple[str, ...], int], share: tuple[int, int], max_epochs: int
) -> DataFrame:
    """One row per leaf: its documents, tokens, budget, whole epochs and tokens of the last one.

    ``units`` has the levels and ``tokens`` of each document. The root's budget is ``share`` (a
    fraction, as two integers) of all tokens, or all capacity if that is less. Tokens times the
    weights of siblings must stay below 2^63.
    """
    leaves = (
        units.groupBy(*LEVELS)
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("tokens").alias("tokens"))
        .withColumn("w_domain", weight_of(weights, [F.col("domain")]))
        .withColumn("w_lang", weight_of(weights, [F.col("domain"), F.col("lang")]))
        .withColumn("w_source", weight_of(weights, [F.col(c) for c in LEVELS]))
        .withColumn(
            "c_source",
            F.when((F.col("w_domain") > 0) & (F.col("w_lang") > 0) & (F.col("w_source") > 0), F.col("tokens") * max_epochs)
            .otherwise(F.lit(0))
            .cast("long"),
        )
    )
    leaves = written(leaves)  # a few numbers per leaf, read at every level below
    domains = leaves.groupBy("domain").agg(
        F.first("w_domain").alias("w_domain"), F.sum("c_source").alias("c_domain"), F.sum("tokens").alias("t")
    )
    whole = W.partitionBy()
    domains = domains.withColumn(
        "b_root",
        F.least(F.sum("c_domain").over(whole), F.expr(f"(sum(t) OVER () * {share[0]}) div {share[1]}")),
    ).drop("t")
    domains = fill(domains, [], "b_root", "c_domain", "w_domain", "b_domain")
    langs = leaves.groupBy("domain", "lang").agg(F.first("w_lang").alias("w_lang"), F.sum("c_source").alias("c_lang"))
    langs = langs.join(domains.select("domain", "b_domain"), "domain")
    langs = fill(langs, ["domain"], "b_domain", "c_lang", "w_lang", "b_lang")
    sources = leaves.join(langs.select("domain", "lang", "b_lang"), ["domain", "lang"])
    sources = fill(sources, ["domain", "lang"], "b_lang", "c_source", "w_source", "budget")
    some = F.col("tokens") > 0
    return sources.select(
        *LEVELS,
        "documents",
        "tokens",
        "budget",
        F.when(some, F.expr("budget div tokens")).otherwise(0).cast("long").alias("epochs"),
        F.when(some, F.expr("budget % tokens")).otherwise(0).cast("long").alias("rest"),
    )


def cutoffs(units: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Leaves with ``cutoff``: documents whose key of the last epoch is not above it are in its prefix.

    The prefix is the longest one whose tokens do not exceed ``rest``; rows with the same id share a
    key and are taken or left together.
    """
    keyed = written(
        units.join(leaves.where("rest > 0").select(*LEVELS, "epochs", "rest"), LEVELS).select(
            *LEVELS, "tokens", "rest", order_key(seed, F.col("epochs"), F.col("doc_id")).alias("key")
        )
    ).withColumn("bucket", F.substring("key", 1, BUCKET))
    leaf = W.partitionBy(*LEVELS)
    totals = keyed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("t"), F.first("rest").alias("rest"))
    ends = (
        totals.withColumn("upto", F.sum("t").over(leaf.orderBy("bucket")))
        .where("upto > rest")
        .groupBy(*LEVELS)
        .agg(F.min_by("bucket", "bucket").alias("bucket"), F.min_by(F.expr("upto - t"), "bucket").alias("before"))
    )
    inside = (
        keyed.join(ends, [*LEVELS, "bucket"])
        .groupBy(*LEVELS, "bucket", "before", "rest", "key")
        .agg(F.sum("tokens").alias("t"))
        .withColumn("upto", F.col("before") + F.sum("t").over(leaf.orderBy("key")))
        .groupBy(*LEVELS)
        .agg(
            F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("key"))), F.first("bucket")).alias("cutoff")
        )
    )
    return leaves.join(inside, LEVELS, "left").withColumn("cutoff", F.coalesce("cutoff", F.lit("")))


def default_domain() -> Column:
    """Domain of a source when the table has no such column: five numbered sources to a domain."""
    number = F.expr(r"try_cast(regexp_extract(source, '[0-9]+$', 0) AS bigint) div 5")
    return F.concat(F.lit("domain"), F.coalesce(number.cast("string"), F.lit("")))


def _levels(domain: Column | None) -> list[Column]:
    domain = default_domain() if domain is None else domain
    raw = [domain, F.col("lang"), F.col("source")]
    return [F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for c, n in zip(raw, LEVELS, strict=True)]


def plan(
    docs: DataFrame,
    weights: dict[tuple[str, ...], int],
    share: tuple[int, int] = (1, 1),
    max_epochs: int = 4,
    seed: int = 0,
    domain: Column | None = None,
) -> DataFrame:
    """The whole mixing decision, one row per leaf (see ``budgets`` and ``cutoffs``)."""
    units = written(docs.select(*_levels(domain), F.col("doc_id"), words(F.col("text")).alias("tokens")))
    leaves = written(budgets(units, weights, share, max_epochs))
    return written(cutoffs(units, leaves, seed))


def mixed(docs: DataFrame, leaves: DataFrame, seed: int = 0, domain: Column | None = None) -> DataFrame:
    """``docs`` repeated as ``leaves`` says, as struct ``doc`` with the levels and ``epoch``.

    NULL languages and sources are a leaf of their own; NULL and empty texts have no tokens: they come
    along with every whole epoch of their leaf, and in the prefix if their key is in it. A leaf without
    any token gives nothing. An empty table gives an empty result. The documents are not shuffled
    while the leaves fit a broadcast join.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *_levels(domain))
    rows = rows.join(leaves.select(*LEVELS, "epochs", "rest", "cutoff"), LEVELS)
    key = order_key(seed, F.col("epochs"), F.col("doc.doc_id"))
    last = (F.col("rest") > 0) & (key <= F.col("cutoff"))
    times = F.col("epochs") + F.when(last, 1).otherwise(0)
    return rows.where(times > 0).select(
        "doc", *LEVELS, F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias("epoch")
    )
