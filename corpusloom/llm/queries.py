"""One check query per operator, over whole tables with production parameters, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytenet, decontaminate, jaccard, mixing, negatives, pii, quality, secrets, sharding, substrings, tokenstore, toxicity, vectors, zones

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


@query("op4_feistel_shards")
def feistel_shards(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf, "documents"), 24, seed=20240607)


#: Integer weights of the tree's nodes; nodes not named weigh 1.
MIX_WEIGHTS = {
    ("domain0",): 4, ("domain1",): 3, ("domain2",): 2, ("domain3",): 1,
    ("*", "en"): 6, ("*", "de"): 2, ("*", "fr"): 2, ("*", "es"): 1,
    ("*", "src0"): 3, ("*", "src5"): 2,
}
MIX_SEED = 11
MIX_EPOCHS = 3


def _fill_sql(source: str, parents: str, budget: str, cap: str, weight: str, name: str, out: str) -> str:
    """Water filling among siblings, step by step; the twin of ``mixing.fill``."""
    by = f"PARTITION BY {parents}" if parents else ""
    also = f"{parents}, " if parents else ""
    order = f"ORDER BY {cap} / {weight}::double, {name}"
    return f"""(
      SELECT * EXCLUDE (bef, rst, ful, tak, opn, shr),
        (shr + CASE WHEN NOT ful AND row_number() OVER (PARTITION BY {also}ful {order})
          <= {budget} - sum(shr) OVER ({by}) THEN 1 ELSE 0 END)::bigint AS {out}
      FROM (SELECT *, CASE WHEN ful THEN {cap} ELSE ({weight} * ({budget} - tak)) // opn END AS shr
      FROM (SELECT *, sum(CASE WHEN ful THEN {cap} ELSE 0 END) OVER ({by}) AS tak,
          sum(CASE WHEN ful THEN 0 ELSE {weight} END) OVER ({by}) AS opn
      FROM (SELECT *, {cap} = 0 OR {cap} * rst <= ({budget} - bef) * {weight} AS ful
      FROM (SELECT *, coalesce(sum({cap}) OVER ({by} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bef,
          sum({weight}) OVER ({by} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rst
      FROM {source})))))"""


def _weight_sql(key: str, *columns: str) -> str:
    cases = " ".join(f"WHEN {c} = '{k[-1]}' THEN {w}" for c in columns for k, w in MIX_WEIGHTS.items() if (len(k) == 1) == (key == "domain"))
    return f"CASE {cases} ELSE 1 END"


MIX_SQL = f"""
  WITH d AS (
    SELECT doc_id, 'domain' || coalesce((try_cast(regexp_extract(source, '[0-9]+$') AS bigint) // 5)::varchar, '') AS domain,
      coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
      coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
    FROM documents),
  leaves AS (
    SELECT domain, lang, source, sum(tokens) AS tokens, sum(tokens) * {MIX_EPOCHS} AS c_source,
      {_weight_sql("domain", "domain")} AS w_domain, {_weight_sql("lang", "lang")} AS w_lang, {_weight_sql("source", "source")} AS w_source
    FROM d GROUP BY domain, lang, source),
  root AS (
    SELECT domain, any_value(w_domain) AS w_domain, sum(c_source) AS c_domain,
      least(sum(sum(c_source)) OVER (), sum(sum(tokens)) OVER () * 3 // 4) AS b_root
    FROM leaves GROUP BY domain),
  domains AS (SELECT * FROM {_fill_sql("root", "", "b_root", "c_domain", "w_domain", "domain", "b_domain")}),
  under AS (
    SELECT domain, lang, any_value(w_lang) AS w_lang, sum(c_source) AS c_lang, any_value(b_domain) AS b_domain
    FROM leaves JOIN domains USING (domain) GROUP BY domain, lang),
  langs AS (SELECT * FROM {_fill_sql("under", "domain", "b_domain", "c_lang", "w_lang", "lang", "b_lang")}),
  below AS (SELECT leaves.*, b_lang FROM leaves JOIN langs USING (domain, lang)),
  shared AS (SELECT * FROM {_fill_sql("below", "domain, lang", "b_lang", "c_source", "w_source", "source", "budget")}),
  plan AS (
    SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END::bigint AS epochs,
      CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END::bigint AS rest FROM shared),
  placed AS (
    SELECT doc_id, domain, lang, source, epochs, rest,
      sum(d.tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('{MIX_SEED}:' || epochs || ':' || doc_id)) AS upto
    FROM d JOIN plan USING (domain, lang, source))
  SELECT doc_id, domain, lang, source, unnest(range(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)) AS epoch
  FROM placed"""


@query("op6_budget_mixture", MIX_SQL)
def budget_mixture(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    leaves = mixing.plan(docs, MIX_WEIGHTS, (3, 4), MIX_EPOCHS, MIX_SEED)
    return mixing.mixed(docs.select("doc_id", "lang", "source"), leaves, MIX_SEED).select(
        F.col("doc.doc_id").alias("doc_id"), *mixing.LEVELS, "epoch"
    )


@query("op3_toxic_segments")
def toxic_segments(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.passages(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "passages",
    )


@query("op5_ngram_join")
def ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    join = jaccard.NgramJoin(table(spark, sf, "documents"), size=3, num=9, den=10)
    return join.members().select("doc_id", F.col("n").alias("n_shingles"), "component_id")


@query("op8_robust_outliers")
def robust_outliers(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.outliers(quality.measured(table(spark, sf, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@query("op9_cgk_decontamination")
def cgk_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op7_secret_layers")
def secret_layers(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.scanned(table(spark, sf, "documents")).drop("found")


@query("op2_weak_pii")
def weak_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return pii.scanned(docs, pii.fit(docs)).drop("found")


@query("op1_token_index")
def token_index(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf, "documents")
    store = tokenstore.write(docs, tokenstore.new_folder(spark), public_tokenizers.path("byte_bpe_50k.json"))
    return tokenstore.digests(tokenstore.keys_of(docs.select("doc_id")), store)


@query("op10_suffix_groups")
def suffix_groups(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf, "documents")).drop("kept", "spans")


NEGATIVES_SQL = """
  WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: floor(256 * x::double)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  scored AS (
    SELECT a.rid AS aid, a.vec_id AS anchor_id, b.rid AS bid, b.vec_id, a.label = b.label AS alike,
      list_inner_product(a.q, b.q)::bigint AS score
    FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0),
  positives AS (
    SELECT aid, anchor_id, vec_id AS positive_id, score AS positive_score,
      row_number() OVER (PARTITION BY aid ORDER BY score DESC, vec_id, bid)::int AS positive_rank
    FROM scored WHERE alike QUALIFY positive_rank <= 5)
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.aid, positive_rank ORDER BY n.score DESC, n.vec_id, n.bid)::int AS rank,
    n.vec_id AS negative_id, positive_score, n.score AS negative_score, positive_rank
  FROM positives p JOIN scored n ON p.aid = n.aid AND NOT n.alike
    AND 100 * n.score >= 30 * positive_score AND 100 * n.score <= 90 * positive_score
  QUALIFY rank <= 10"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return negatives.mined(vectors.quantised(rows, ["vec_id", "label"], 256), F.col("vec_id") % 100 == 0)


CLUSTERS, CLUSTER_ROUNDS = 8, 10


def _cluster_sql() -> str:
    """The rounds written out, one pair of steps after the other."""
    assign = """(SELECT rid, any_value(vec_id) AS vec_id, any_value(q) AS q, arg_min(k, d * 64 + k) AS k, min(d) AS d
      FROM (SELECT rid, vec_id, q, k,
          list_inner_product(q, q) - 2 * list_inner_product(q, c) + list_inner_product(c, c) AS d FROM v, {centroids})
      GROUP BY rid)"""
    steps = []
    for r in range(CLUSTER_ROUNDS):
        steps.append(f"a{r} AS MATERIALIZED {assign.format(centroids=f'c{r}')}")
        steps.append(f"""c{r + 1} AS MATERIALIZED (
          SELECT c.k, coalesce(any_value(m.c), any_value(c.c)) AS c FROM c{r} c LEFT JOIN (
            SELECT k, list(x ORDER BY i) AS c FROM (
              SELECT k, i, floor(sum(x) / count(*)) AS x
              FROM (SELECT k, unnest(q) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY k, i) GROUP BY k) m USING (k)
          GROUP BY c.k)""")
    return f"""
      WITH v AS MATERIALIZED (
        SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) = 64
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST) - 1 AS k, q AS c FROM v
        QUALIFY k < {CLUSTERS}),
      {", ".join(steps)},
      final AS MATERIALIZED {assign.format(centroids=f"c{CLUSTER_ROUNDS}")}
      SELECT vec_id, k::int AS cluster, d::bigint AS distance,
        (sum(d) OVER (PARTITION BY k))::bigint AS cluster_inertia, (sum(d) OVER ())::bigint AS inertia,
        sha256(array_to_string(list_transform(c, lambda x: x::bigint), ',')) AS centroid_sha256
      FROM final JOIN c{CLUSTER_ROUNDS} USING (k)"""


@query("op13_zone_clusters", _cluster_sql())
def zone_clusters(spark: SparkSession, sf: str) -> DataFrame:
    rows = vectors.quantised(table(spark, sf, "embeddings"), ["vec_id"], 1024, width=64)
    return zones.report(zones.cluster(rows, zones.starts(rows, 64, CLUSTERS, "3"), CLUSTER_ROUNDS))


@query("op12_byte_quality")
def byte_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    net = bytenet.fit(docs, table(spark, sf, "labels"), "quality", ~held_out)
    scored = bytenet.scored(docs, net, ["doc_id"])
    # a document without an id belongs to neither side of the split; its labels cannot be learnt either
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
