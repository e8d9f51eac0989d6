"""Selection and text expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.functions.structured import short_hash
from corpusloom.operators import citations, incremental, select

from .base import query, slug_sql, strip_html_sql, table, text

# ---- selection --------------------------------------------------------------------------------------


@query(
    "required_fields",
    """SELECT event_id::varchar AS entity_id, event_type AS name FROM events
       WHERE event_type <> 'error' AND value > 0""",
)
def required_fields(spark, sf):
    items = table(spark, sf, "events").select(
        F.when(F.col("value") > 0, text("event_id")).alias("entity_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise(F.lit("")).alias("name"),
    )
    return select.required_fields(items, "entity_id", "name")


@query(
    "entity_allow_list",
    """SELECT doc_id::varchar AS entity_id, lang FROM documents
       WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND lang IN ('en', 'de')""",
)
def entity_allow_list(spark, sf):
    docs = table(spark, sf, "documents").select(text("doc_id").alias("entity_id"), "lang")
    good = table(spark, sf, "labels").where("quality = 1").select(text("doc_id").alias("id"))
    return select.allow_list(select.allow_list(docs, good), ["en", "de"], "lang")


@query(
    "dedup_keep_first",
    """SELECT doc_id, lang, n_chars FROM documents
       QUALIFY row_number() OVER (PARTITION BY lower(text) ORDER BY doc_id) = 1""",
)
def dedup_keep_first(spark, sf):
    docs = table(spark, sf, "documents").withColumnRenamed("doc_id", "ordinal")
    first = select.keep_first(docs, F.sha2(F.lower("text"), 256))
    return first.select(F.col("ordinal").alias("doc_id"), "lang", "n_chars")


@query(
    "first_n_entities",
    """SELECT event_id AS ordinal, user_id FROM (
         SELECT * FROM events WHERE event_type <> 'error'
         QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1)
       ORDER BY event_id LIMIT 25""",
)
def first_n_entities(spark, sf):
    items = table(spark, sf, "events").where("event_type <> 'error'")
    items = items.select(F.col("event_id").alias("ordinal"), "user_id")
    return select.first_n(select.keep_first(items, "user_id"), 25)


@query(
    "comparison_records",
    """SELECT user_id::varchar AS entity_id, min(event_id) AS ordinal,
         arg_max(event_type, event_id) AS name, arg_max(value, event_id) AS amount
       FROM events GROUP BY user_id""",
)
def comparison_records(spark, sf):
    rows = table(spark, sf, "events").select(
        text("user_id").alias("entity_id"),
        F.col("event_id").alias("ordinal"),
        F.col("event_type").alias("name"),
        F.col("value").alias("amount"),
    )
    return select.last_write(rows)


# ---- text ---------------------------------------------------------------------------------------------


@query("strip_html_pages", f"SELECT page_id, {strip_html_sql('html')} AS body FROM pages")
def strip_html_pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.strip_html(F.col("html")).alias("body"))


@query(
    "truncate_text",
    """SELECT doc_id,
         CASE WHEN length(text) > 1500 THEN substr(text, 1, 1500) || '...' ELSE text END AS example_use,
         CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...' ELSE text END AS preview
       FROM documents""",
)
def truncate_text(spark, sf):
    body = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", tx.truncate(body, 1500).alias("example_use"), tx.truncate(body, 150).alias("preview")
    )


@query("slugify", f"SELECT page_id, {slug_sql('url')} AS slug FROM pages")
def slugify(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.slugify(F.col("url")).alias("slug"))


GPU_NAME = """p_brand || CASE p_type WHEN 'STANDARD' THEN ' nvidia a100-' WHEN 'MEDIUM' THEN ' Quadro RTX  '
  WHEN 'SMALL' THEN ' v100/A30 ' WHEN 'LARGE' THEN ' A10 ' ELSE ' none ' END || p_size"""


@query(
    "normalize_gpu",
    f"""SELECT p_partkey, CASE WHEN m = '' THEN '' ELSE 'NVIDIA ' || m END AS gpu FROM (
          SELECT p_partkey, regexp_extract(upper(trim({GPU_NAME})),
            '(A100|V100|H100|A40|A30|A10|RTX\\s*\\d+)', 1) AS m FROM part)""",
)
def normalize_gpu(spark, sf):
    kind = F.col("p_type")
    middle = (
        F.when(kind == "STANDARD", " nvidia a100-")
        .when(kind == "MEDIUM", " Quadro RTX  ")
        .when(kind == "SMALL", " v100/A30 ")
        .when(kind == "LARGE", " A10 ")
        .otherwise(" none ")
    )
    name = F.concat(F.col("p_brand"), middle, text("p_size"))
    return table(spark, sf, "part").select("p_partkey", tx.normalize_gpu(name).alias("gpu"))


@query(
    "format_currency",
    """SELECT o_orderkey,
         '$' || format('{:,}', (o_totalprice * 100)::bigint * 1000) AS whole,
         CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_totalprice::decimal(18,2)::varchar END AS other
       FROM orders""",
)
def format_currency(spark, sf):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint") * 1000
    kept = F.when(F.col("o_orderstatus") != "O", text(F.col("o_totalprice").cast("decimal(18,2)")))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        tx.format_currency(F.concat(F.lit(" "), text(cents))).alias("whole"),
        tx.format_currency(kept).alias("other"),
    )


@query(
    "clean_entity_name",
    """SELECT p_partkey, softened,
         trim(regexp_replace(regexp_replace(softened, '(?i)\\s*-\\s*(COMING SOON|RETIRED|BETA).*$', ''),
           '(?i)\\s*\\(coming soon\\)', '', 'g')) AS name
       FROM (SELECT p_partkey, CASE WHEN contains(raw, 'COMING SOON')
            THEN trim(replace(replace(raw, '- COMING SOON', '(coming soon)'), 'COMING SOON', '(coming soon)'))
            ELSE raw END AS softened
          FROM (SELECT p_partkey, p_name || CASE p_type WHEN 'STANDARD' THEN ' - COMING SOON'
              WHEN 'MEDIUM' THEN ' - retired 2020' WHEN 'SMALL' THEN ' COMING SOON ' WHEN 'LARGE' THEN '-Beta'
              ELSE '' END AS raw FROM part))""",
)
def clean_entity_name(spark, sf):
    kind = F.col("p_type")
    tail = (
        F.when(kind == "STANDARD", " - COMING SOON")
        .when(kind == "MEDIUM", " - retired 2020")
        .when(kind == "SMALL", " COMING SOON ")
        .when(kind == "LARGE", "-Beta")
        .otherwise("")
    )
    rows = table(spark, sf, "part").select(
        "p_partkey", tx.soften_label(F.concat(F.col("p_name"), tail)).alias("softened")
    )
    return rows.withColumn("name", tx.clean_name(F.col("softened")))


@query(
    "resolve_display_name",
    """SELECT doc_id, CASE WHEN name = '' THEN name WHEN hit <> '' THEN hit ELSE name END AS display FROM (
         SELECT doc_id, name, regexp_extract(text,
           '(?i)(?:^|[^\\p{L}\\p{M}\\p{N}_])(' || name || ')(?:$|[^\\p{L}\\p{M}\\p{N}_])', 1) AS hit
         FROM (SELECT doc_id, text, lower(regexp_extract(text, '[\\p{L}]+')) AS name FROM documents))""",
)
def resolve_display_name(spark, sf):
    rows = table(spark, sf, "documents").withColumn(
        "name", F.lower(F.regexp_extract("text", r"[\p{L}]+", 0))
    )
    return rows.select("doc_id", tx.display_name(F.col("name"), F.col("text")).alias("display"))


def _complex_sql(c: str, words: list[str]) -> str:
    hit = " OR ".join(f"contains(lower({c}), '{w}')" for w in words)
    return f"CASE WHEN {hit} THEN 'moderate' ELSE 'simple' END"


def _complexity_sql() -> str:
    from corpusloom.operators.domains import REGISTRY

    columns = ", ".join(
        f"{_complex_sql('q', s.keywords)} AS {n.replace('-', '_')}" for n, s in REGISTRY.items()
    )
    return f"""SELECT conv_id, turn, {columns} FROM (
        SELECT conv_id, turn, CASE role WHEN 'user' THEN 'How to ' WHEN 'system' THEN 'EXAMPLE ' ELSE '' END
          || text AS q FROM conversations)"""


@query("classify_complexity", _complexity_sql())
def classify_complexity(spark, sf):
    from corpusloom.operators.domains import REGISTRY

    lead = F.when(F.col("role") == "user", "How to ").when(F.col("role") == "system", "EXAMPLE ").otherwise("")
    question = F.concat(lead, F.col("text"))
    return table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        *[tx.complexity(question, s.keywords).alias(n.replace("-", "_")) for n, s in REGISTRY.items()],
    )


# ---- citations -------------------------------------------------------------------------------------------

ANSWERS_SQL = """
  SELECT o_orderkey AS id, 'What is order ' || o_orderkey || '? ' || repeat(o_orderpriority || ' ', 10) AS question,
    'Order ' || o_orderkey || '.' ||
    CASE WHEN o_orderpriority = '1-URGENT' THEN ' <<SRC:>> <<SRC:broken'
         ELSE chr(10) || chr(10) || '<<SRC:customer:' || (o_custkey + 100) || '>>' END ||
    CASE o_orderstatus WHEN 'P' THEN ' <<SRC:docs:page:' || o_custkey || '>>'
         WHEN 'F' THEN '<<SRC:part:' || o_orderkey || '>>' ELSE '' END AS answer
  FROM orders"""


def answers(spark, sf):
    key, customer = text("o_orderkey"), text(F.col("o_custkey") + 100)
    first = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(" <<SRC:>> <<SRC:broken")).otherwise(
        F.concat(F.lit("\n\n<<SRC:customer:"), customer, F.lit(">>"))
    )
    second = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit(" <<SRC:docs:page:"), text("o_custkey"), F.lit(">>")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("<<SRC:part:"), key, F.lit(">>")))
        .otherwise(F.lit(""))
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(
            F.lit("What is order "), key, F.lit("? "),
            F.repeat(F.concat(F.col("o_orderpriority"), F.lit(" ")), F.lit(10)),
        ).alias("question"),
        F.concat(F.lit("Order "), key, F.lit("."), first, second).alias("answer"),
    )


CITES_SQL = f"""
  SELECT id, unnest(range(1, len(m) + 1)) AS place, unnest(m) AS raw FROM (
    SELECT id, regexp_extract_all(answer, '<<SRC:[^:>]+:[^>]+>>') AS m FROM ({ANSWERS_SQL}))"""

PARSED_SQL = f"""
  SELECT id, place, raw, regexp_extract(raw, '<<SRC:([^:>]+):([^>]+)>>', 1) AS domain,
    regexp_extract(raw, '<<SRC:([^:>]+):([^>]+)>>', 2) AS entity_id FROM ({CITES_SQL})"""


@query("citation_extract", PARSED_SQL)
def citation_extract(spark, sf):
    return citations.extract(answers(spark, sf)).withColumn("place", F.col("place").cast("bigint"))


KNOWN_SQL = """
  SELECT 'customer' AS domain, c_custkey::varchar AS entity_id FROM customer
  UNION ALL SELECT 'part', p_partkey::varchar FROM part"""
LOADED = ["customer", "part"]


def known(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("domain"), text("c_custkey").alias("entity_id")
    )
    parts = table(spark, sf, "part").select(
        F.lit("part").alias("domain"), text("p_partkey").alias("entity_id")
    )
    return customers.unionByName(parts)


CHECK_SQL = f"""
  SELECT c.*, ok AS valid, CASE WHEN NOT ok THEN 'Entity ''' || entity_id || ''' not found in ' || domain END AS error
  FROM (SELECT p.*, p.domain NOT IN ('customer', 'part') OR k.entity_id IS NOT NULL AS ok
        FROM ({PARSED_SQL}) p LEFT JOIN ({KNOWN_SQL}) k ON p.domain = k.domain AND p.entity_id = k.entity_id) c"""
CHECK_COLUMNS = "id, place, raw, domain, entity_id, valid, error"


def checked(spark, sf):
    return citations.check(citations.extract(answers(spark, sf)), known(spark, sf), LOADED)


@query("citation_check", f"SELECT {CHECK_COLUMNS} FROM ({CHECK_SQL})")
def citation_check(spark, sf):
    rows = checked(spark, sf).withColumn("place", F.col("place").cast("bigint"))
    return rows.select(*[c.strip() for c in CHECK_COLUMNS.split(",")])


VERDICT_SQL = f"""
  SELECT a.id, question, coalesce(n, 0) AS citations, coalesce(bad, 0) AS invalid,
    coalesce(n, 0) > 0 AS has_citations, coalesce(n, 0) > 0 AND coalesce(bad, 0) = 0 AS all_valid
  FROM ({ANSWERS_SQL}) a LEFT JOIN (
    SELECT id, count(*) AS n, count(*) FILTER (NOT valid) AS bad FROM ({CHECK_SQL}) GROUP BY id) s ON a.id = s.id"""


def verdicts(spark, sf):
    rows = answers(spark, sf)
    return citations.per_answer(rows, checked(spark, sf))


@query("citation_answers", f"SELECT id, citations, invalid, has_citations, all_valid FROM ({VERDICT_SQL})")
def citation_answers(spark, sf):
    return verdicts(spark, sf).select("id", "citations", "invalid", "has_citations", "all_valid")


@query(
    "citation_summary",
    f"""SELECT *, valid * 100 // total AS valid_percent, invalid * 100 // total AS invalid_percent,
          none * 100 // total AS none_percent, invalid = 0 AS ok FROM (
          SELECT count(*) FILTER (all_valid) AS valid, count(*) FILTER (has_citations AND NOT all_valid) AS invalid,
            count(*) FILTER (NOT has_citations) AS none, count(*) AS total FROM ({VERDICT_SQL}))""",
)
def citation_summary(spark, sf):
    return citations.summary(verdicts(spark, sf))


@query(
    "citation_invalid_top",
    f"""SELECT id, invalid, substr(question, 1, 80) || '...' AS preview FROM ({VERDICT_SQL})
        WHERE has_citations AND NOT all_valid ORDER BY id LIMIT 10""",
)
def citation_invalid_top(spark, sf):
    return citations.invalid_top(verdicts(spark, sf), "id").select("id", "invalid", "preview")


@query(
    "known_entities",
    """SELECT DISTINCT domain, entity_id FROM (
         SELECT 'compute-resources' AS domain,
           CASE WHEN s_acctbal > 5000 THEN s_suppkey::varchar ELSE 'R' || s_suppkey END AS entity_id FROM supplier
         UNION ALL SELECT 'software-discovery', p_name FROM part
         UNION ALL SELECT 'affinity-groups', p_size::varchar FROM part
         UNION ALL SELECT 'allocations',
           CASE WHEN o_orderstatus = 'P' THEN 'REQ' || o_orderkey ELSE o_orderkey::varchar END FROM orders
         UNION ALL SELECT 'nsf-awards', c_custkey::varchar FROM customer)""",
)
def known_entities(spark, sf):
    catalogs = {
        "compute-resources": table(spark, sf, "supplier").select(
            F.when(F.col("s_acctbal") > 5000, text("s_suppkey")).otherwise("").alias("id"),
            F.concat(F.lit("R"), text("s_suppkey")).alias("resource_id"),
        ),
        "software-discovery": table(spark, sf, "part").select(F.col("p_name").alias("Name")),
        "affinity-groups": table(spark, sf, "part").select(F.col("p_size").alias("id")),
        "allocations": table(spark, sf, "orders").select(
            F.when(F.col("o_orderstatus") != "P", text("o_orderkey")).alias("projectId"),
            F.concat(F.lit("REQ"), text("o_orderkey")).alias("requestNumber"),
        ),
        "nsf-awards": table(spark, sf, "customer").select(text("c_custkey").alias("awardNumber")),
    }
    rows, _ = citations.load_known(catalogs)
    return rows


@query(
    "entities_from_pairs",
    f"SELECT domain, entity_id FROM ({PARSED_SQL}) UNION SELECT domain, entity_id FROM ({KNOWN_SQL})",
)
def entities_from_pairs(spark, sf):
    return citations.from_pairs(answers(spark, sf), known(spark, sf))


# ---- content hash and the cache ---------------------------------------------------------------------------


def _document_entities(spark, sf):
    return table(spark, sf, "documents").select(
        F.lit("documents").alias("domain"),
        text("doc_id").alias("entity_id"),
        F.col("doc_id").alias("ordinal"),
        F.struct("text", "source", "n_chars", "lang").alias("entity"),
        "lang",
        "source",
        "doc_id",
    )


HASH_SQL = "sha256(to_json({'lang': lang, 'n_chars': n_chars, 'source': source, 'text': text}))"


@query(
    "entity_hash",
    f"SELECT doc_id::varchar AS entity_id, {HASH_SQL} AS full_hash, left({HASH_SQL}, 16) AS source_hash FROM documents",
)
def entity_hash(spark, sf):
    return incremental.with_hash(_document_entities(spark, sf)).select(
        "entity_id", "full_hash", "source_hash"
    )


# earlier snapshot: no Spanish documents yet, other texts in src3 and src7, nothing kept for French
OLD_HASH_SQL = (
    "sha256(to_json({'lang': lang, 'n_chars': n_chars, 'source': source, "
    "'text': CASE WHEN source IN ('src3', 'src7') THEN text || ' (old)' ELSE text END}))"
)
PAIRS_SQL = "CASE WHEN lang = 'fr' THEN [] ELSE ['documents_' || doc_id || '_1', 'documents_' || doc_id || '_2'] END"
CACHE_SQL = f"""
  SELECT 'documents' AS domain, doc_id::varchar AS entity_id, {OLD_HASH_SQL} AS full_hash, {PAIRS_SQL} AS pairs
  FROM documents WHERE lang <> 'es'"""
PLAN_SQL = f"""
  SELECT d.doc_id, d.doc_id::varchar AS entity_id, d.lang, {HASH_SQL} AS full_hash, c.pairs,
    coalesce({HASH_SQL} = c.full_hash, false) AS hit,
    coalesce({HASH_SQL} = c.full_hash AND len(c.pairs) > 0, false) AS reuse
  FROM documents d LEFT JOIN ({CACHE_SQL}) c ON c.entity_id = d.doc_id::varchar"""


def kept_pairs(key):
    from corpusloom.operators.pairs import build_pair

    def one(n: int):
        pid = F.concat(F.lit("documents_"), key, F.lit(f"_{n}"))
        return build_pair(pid, F.lit("Q"), F.lit("A"), F.lit("ref"), F.lit("documents")).withField(
            "metadata.created_at", F.lit("2024-01-01T00:00:00Z")
        )

    return F.array(one(1), one(2))


def old_cache(spark, sf):
    docs = table(spark, sf, "documents").where("lang <> 'es'")
    changed = F.col("source").isin("src3", "src7")
    docs = docs.withColumn(
        "text", F.when(changed, F.concat(F.col("text"), F.lit(" (old)"))).otherwise(F.col("text"))
    ).withColumn("entity", F.struct("text", "source", "n_chars", "lang"))
    pairs = kept_pairs(text("doc_id"))
    return incremental.with_hash(docs).select(
        F.lit("documents").alias("domain"),
        text("doc_id").alias("entity_id"),
        F.col("source_hash").alias("hash"),
        "full_hash",
        F.when(F.col("lang") == "fr", F.slice(pairs, 1, 0)).otherwise(pairs).alias("pairs"),
    )


def planned(spark, sf):
    return incremental.plan(incremental.with_hash(_document_entities(spark, sf)), old_cache(spark, sf))


@query(
    "incremental_plan",
    f"SELECT entity_id, left(full_hash, 16) AS source_hash, hit, reuse FROM ({PLAN_SQL})",
)
def incremental_plan(spark, sf):
    return planned(spark, sf).select("entity_id", "source_hash", "hit", "reuse")


@query(
    "incremental_replay",
    f"""SELECT doc_id AS ordinal, unnest(range(0, len(pairs))) AS sub, unnest(pairs) AS id
        FROM ({PLAN_SQL}) WHERE reuse""",
)
def incremental_replay(spark, sf):
    rows = incremental.replay(planned(spark, sf))
    return rows.select("ordinal", F.col("sub").cast("bigint").alias("sub"), "id")


@query(
    "cache_stats",
    f"SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses FROM ({PLAN_SQL})",
)
def cache_stats(spark, sf):
    return incremental.cache_stats(planned(spark, sf))


@query(
    "cache_upsert",
    f"""SELECT entity_id, left(full_hash, 16) AS hash, 1 AS pairs FROM ({PLAN_SQL}) WHERE NOT reuse
        UNION ALL SELECT entity_id, left(full_hash, 16), len(pairs) FROM ({CACHE_SQL})
          WHERE entity_id NOT IN (SELECT entity_id FROM ({PLAN_SQL}) WHERE NOT reuse)""",
)
def cache_upsert(spark, sf):
    todo = incremental.to_generate(planned(spark, sf))
    written = todo.select(
        "domain",
        "entity_id",
        "ordinal",
        short_hash(F.col("full_hash")).alias("hash"),
        "full_hash",
        F.slice(kept_pairs(F.col("entity_id")), 1, 1).alias("pairs"),
    )
    return incremental.upsert(old_cache(spark, sf), written).select(
        "entity_id", "hash", F.size("pairs").cast("bigint").alias("pairs")
    )
