"""Pairs, responses, judge, prompts, inference, review table and reports over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpusloom.functions.structured import indent_json
from corpusloom.operators import infer, judge, pairs, prompts, reports, review
from corpusloom.operators.domains import REGISTRY
from corpusloom.schema import PAIR_FIELDS, ROLES
from corpusloom.settings import checkpoint_dir
from corpusloom.sources import tables

from .base import query, quote, table, text
from .comparisons import T, awards, compare, members_sql, sampled_sql, AWARDS_SQL

SOFTWARE = REGISTRY["software-discovery"]
ALLOCATIONS = REGISTRY["allocations"]


def _words(c: str, words: list[str]) -> str:
    return " OR ".join(f"contains(lower({c}), '{w}')" for w in words)


# ---- question/answer pairs of the conversations -----------------------------------------------------------

TURNS_SQL = f"""
  SELECT 'conv_' || u.conv_id || '_' || (u.turn + 1) AS id, u.conv_id, u.turn,
    'How to ' || u.text AS question,
    a.text || CASE WHEN u.turn = 0 THEN chr(10) || chr(10) || '<<SRC:conv:' || u.conv_id || '>>' ELSE '' END AS answer,
    'ref/' || u.conv_id AS source_ref, CASE WHEN u.turn = 0 THEN 'opening' ELSE 'follow-up' END AS domain
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'"""


def turns(spark, sf):
    """User turn and the assistant turn after it; other roles are outside the record contract."""
    rows = table(spark, sf, "conversations").where(F.col("role").isin(ROLES))
    user = rows.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("asked"))
    reply = rows.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("told")
    )
    cite = F.when(
        F.col("turn") == 0, F.concat(F.lit("\n\n<<SRC:conv:"), text("conv_id"), F.lit(">>"))
    ).otherwise("")
    return user.join(reply, ["conv_id", "turn"]).select(
        F.concat_ws("_", F.lit("conv"), text("conv_id"), text(F.col("turn") + 1)).alias("id"),
        "conv_id",
        "turn",
        F.concat(F.lit("How to "), F.col("asked")).alias("question"),
        F.concat(F.col("told"), cite).alias("answer"),
        F.concat(F.lit("ref/"), text("conv_id")).alias("source_ref"),
        F.when(F.col("turn") == 0, "opening").otherwise("follow-up").alias("domain"),
    )


def turn_pairs(spark, sf):
    from corpusloom.functions import text as tx

    built = pairs.build_pair(
        F.col("id"),
        F.col("question"),
        F.col("answer"),
        F.col("source_ref"),
        F.col("domain"),
        tx.complexity(F.col("answer"), ALLOCATIONS.keywords),
        source_data=F.to_json(F.struct("conv_id", "turn")),
    )
    return turns(spark, sf).select(built.alias("p")).select("p.*")


COMPLEXITY = f"CASE WHEN {_words('answer', ALLOCATIONS.keywords)} THEN 'moderate' ELSE 'simple' END"


@query(
    "qa_pair_build",
    f"""SELECT id, source_ref, domain, question, answer, {COMPLEXITY} AS complexity,
          'comprehensive' AS granularity, contains(answer, '<<SRC:') AS has_citation,
          'mcp_extraction' AS source, 'user,assistant' AS roles FROM ({TURNS_SQL})""",
)
def qa_pair_build(spark, sf):
    return turn_pairs(spark, sf).select(
        "id",
        "source_ref",
        "domain",
        pairs.question_of().alias("question"),
        pairs.answer_of().alias("answer"),
        "metadata.complexity",
        "metadata.granularity",
        "metadata.has_citation",
        "source",
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
    )


@query(
    "jsonl_roundtrip",
    f"""SELECT id, 'mcp_extraction' AS source, source_ref, domain, question, answer, {COMPLEXITY} AS complexity,
          contains(answer, '<<SRC:') AS has_citation,
          '{{"conv_id":' || conv_id || ',"turn":' || turn || '}}' AS source_data FROM ({TURNS_SQL})""",
)
def jsonl_roundtrip(spark, sf):
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pairs-{uuid.uuid4().hex}"
    tables.write_by_source(turn_pairs(spark, sf).withColumn("source_key", F.col("domain")), folder)
    return tables.load_pairs(spark, folder).select(
        "id",
        "source",
        "source_ref",
        "domain",
        pairs.question_of().alias("question"),
        pairs.answer_of().alias("answer"),
        "metadata.complexity",
        "metadata.has_citation",
        "metadata.source_data",
    )


def sources(spark, sf):
    from corpusloom.plans.extract import comparison_pairs

    members = compare.by_field(awards(spark, sf), "institution")
    made = comparison_pairs(compare.sampled(members, T["award_institution"]))
    return {"conversations": turn_pairs(spark, sf), "comparisons": made}


UNION_SQL = f"""
  SELECT 'conversations' AS source_key, id, source_ref, domain, question FROM ({TURNS_SQL})
  UNION ALL
  SELECT 'comparisons', id, source_ref, domain, question
  FROM ({sampled_sql(members_sql(AWARDS_SQL, 'institution'), T['award_institution'])})"""


@query("union_sources", UNION_SQL)
def union_sources(spark, sf):
    both = tables.union_sources(sources(spark, sf))
    return both.select("source_key", "id", "source_ref", "domain", pairs.question_of().alias("question"))


@query(
    "run_summary",
    f"""SELECT source_key, count(*) AS pairs, string_agg(DISTINCT domain, ', ' ORDER BY domain) AS domains
        FROM ({UNION_SQL}) GROUP BY source_key
        UNION ALL SELECT 'Total', count(*), '' FROM ({UNION_SQL})""",
)
def run_summary(spark, sf):
    return reports.run_summary(tables.union_sources(sources(spark, sf)))


@query("stats_domain", f"SELECT domain, count(*) AS pairs FROM ({TURNS_SQL}) GROUP BY domain")
def stats_domain(spark, sf):
    return reports.by_domain(turn_pairs(spark, sf))


@query(
    "stats_complexity",
    f"SELECT {COMPLEXITY} AS complexity, count(*) AS pairs FROM ({TURNS_SQL}) GROUP BY 1",
)
def stats_complexity(spark, sf):
    return reports.by_complexity(turn_pairs(spark, sf))


@query(
    "stats_citation",
    f"""SELECT count(*) AS total, count(*) FILTER (contains(answer, '<<SRC:')) AS with_citation,
          count(*) FILTER (contains(answer, '<<SRC:')) * 100 // nullif(count(*), 0) AS percent FROM ({TURNS_SQL})""",
)
def stats_citation(spark, sf):
    return reports.citation_share(turn_pairs(spark, sf))


# ---- model responses: one response per document and pass -------------------------------------------------------
# en, other sources: three items, the second without a question. fr: malformed text. es: no array.
# de: an item without an answer. Second pass: one more item; malformed in src1 and src5.

RESPONSES_SQL = f"""
  SELECT doc_id, lang, source, text FROM documents WHERE lang = 'en' AND source NOT IN ('src1', 'src5')"""
ITEMS_SQL = f"""
  SELECT doc_id, 1 AS seq, 'What process is document ' || doc_id || ' about?' AS question, text AS answer FROM ({RESPONSES_SQL})
  UNION ALL
  SELECT doc_id, 3, 'Which source has it?', 'Source ' || source || '.' || chr(10) || chr(10) || '<<SRC:documents:' || doc_id || '>>'
  FROM ({RESPONSES_SQL})
  UNION ALL
  SELECT doc_id, 4, 'How to read "it"?', 'In ' || lang || '.' FROM ({RESPONSES_SQL})"""


def item(question, answer):
    return F.struct(question.alias("question"), answer.alias("answer"))


def first_items():
    key = text("doc_id")
    cite = F.concat(F.lit("\n\n<<SRC:documents:"), key, F.lit(">>"))
    return F.array(
        item(F.concat(F.lit("What process is document "), key, F.lit(" about?")), F.col("text")),
        item(F.lit(""), F.lit("answer without a question")),
        item(F.lit("Which source has it?"), F.concat(F.lit("Source "), F.col("source"), F.lit("."), cite)),
    )


def responses(spark, sf):
    docs = table(spark, sf, "documents")
    listed = F.to_json(first_items())
    first = (
        F.when(F.col("lang") == "fr", F.concat(F.lit("Here are [the pairs: "), listed))
        .when(F.col("lang") == "es", F.lit("no pairs for this one"))
        .when(F.col("lang") == "de", F.lit('[{"question": "What is missing?"}]'))
        .otherwise(F.concat(F.lit("Here are the pairs:\n"), listed, F.lit("\nDone.")))
    )
    more = F.to_json(F.array(item(F.lit('How to read "it"?'), F.concat(F.lit("In "), F.col("lang"), F.lit(".")))))
    second = F.when(F.col("source").isin("src1", "src5"), F.concat(more, F.lit("] x [1]"))).otherwise(
        F.concat(more, F.lit(" end"))
    )
    return docs.withColumn("first_text", first).withColumn("second_text", second)


@query(
    "response_to_pairs",
    f"""SELECT 'software-discovery_' || doc_id || '_' || seq AS id, question, answer,
          CASE WHEN {_words('question', SOFTWARE.keywords)} THEN 'moderate' ELSE 'simple' END AS complexity,
          contains(answer, '<<SRC:') AS has_citation, 'mcp://software-discovery/software/' || doc_id AS source_ref
        FROM ({ITEMS_SQL})""",
)
def response_to_pairs(spark, sf):
    rows = pairs.parse_battery(responses(spark, sf), "first_text")
    rows = pairs.parse_discovery(rows, "second_text").withColumn("items", pairs.merge_passes())
    key = text("doc_id")
    made = pairs.pair_array(
        F.col("items"), F.lit(SOFTWARE.name), key, SOFTWARE.source_ref(key), SOFTWARE.keywords
    )
    rows = pairs.explode_pairs(rows.withColumn("pairs", made).withColumn("ordinal", F.col("doc_id")))
    return rows.select(
        "id",
        pairs.question_of().alias("question"),
        pairs.answer_of().alias("answer"),
        "metadata.complexity",
        "metadata.has_citation",
        "source_ref",
    )


@query(
    "response_states",
    """SELECT doc_id, CASE lang WHEN 'es' THEN 'none' WHEN 'en' THEN 'ok' ELSE 'malformed' END AS battery_state,
         CASE WHEN source IN ('src1', 'src5') THEN 'malformed' ELSE 'ok' END AS discovery_state FROM documents""",
)
def response_states(spark, sf):
    rows = pairs.parse_battery(responses(spark, sf), "first_text")
    rows = pairs.parse_discovery(rows, "second_text")
    return rows.select("doc_id", "battery_state", "discovery_state")


@query(
    "discovery_prompts",
    """SELECT doc_id, CASE WHEN lang <> 'en' THEN '(none)' ELSE
         '1. **Q:** What process is document ' || doc_id || ' about?' || chr(10) || '   **A:** ' ||
         CASE WHEN length(text) > 150 THEN substr(text, 1, 150) || '...' ELSE text END || chr(10) ||
         '2. **Q:** ' || chr(10) || '   **A:** answer without a question' || chr(10) ||
         '3. **Q:** Which source has it?' || chr(10) || '   **A:** Source ' || source || '.' || chr(10) || chr(10) ||
         '<<SRC:documents:' || doc_id || '>>' END AS existing
       FROM documents""",
)
def discovery_prompts(spark, sf):
    rows = pairs.parse_battery(responses(spark, sf), "first_text")
    return rows.select("doc_id", prompts.existing_block(F.col("battery_items")).alias("existing"))


@query(
    "user_prompts",
    """SELECT c_custkey, 'Entity ID: ' || c_custkey || chr(10) || 'Entity name: ' ||
         CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey::varchar ELSE c_name END || chr(10) ||
         'Citation marker: <<SRC:allocations:' || c_custkey || '>>' || chr(10) || chr(10) || 'Data:' || chr(10) ||
         '{' || chr(10) || '  "name": "' || c_name || '",' || chr(10) || '  "segments": [' || chr(10) ||
         '    "' || c_mktsegment || '"' || chr(10) || '  ]' || chr(10) || '}' AS user_text
       FROM customer""",
)
def user_prompts(spark, sf):
    entity = F.to_json(F.struct(F.col("c_name").alias("name"), F.array("c_mktsegment").alias("segments")))
    name = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).otherwise("")
    return table(spark, sf, "customer").select(
        "c_custkey",
        prompts.user_prompt(F.lit("allocations"), text("c_custkey"), indent_json(entity), name).alias("user_text"),
    )


@query(
    "judge_prompts",
    f"""SELECT conv_id, 0::bigint AS block, count(*) AS pairs,
          string_agg('### ' || id || chr(10) || '**Q:** ' || question || chr(10) || '**A:** ' || answer || chr(10),
            chr(10) ORDER BY turn) AS pairs_block
        FROM ({TURNS_SQL}) GROUP BY conv_id""",
)
def judge_prompts(spark, sf):
    rows = turns(spark, sf).withColumn("seq", F.col("turn") + 1)
    blocks = prompts.judge_batches(rows, ["conv_id"], "seq")
    return blocks.withColumn("block", F.col("block").cast("bigint"))


def _guidance_sql() -> str:
    rows = ", ".join(
        f"({quote(d)}, {n}, {quote(f)}, {quote(t)}, {quote(c) if c else 'NULL'})"
        for d, groups in prompts.FIELD_GROUPS.items()
        for n, (f, t, c) in enumerate(groups, start=1)
    )
    return f"""
      WITH g(domain, pos, fields, topic, cond) AS (VALUES {rows}),
      b AS (SELECT domain, string_agg(pos || '. ' || topic || CASE WHEN cond IS NULL THEN '' ELSE
          ' (skip unless: ' || cond || ')' END || chr(10) || '   Data fields: `' || fields || '`', chr(10) ORDER BY pos) AS block
        FROM g GROUP BY domain),
      e AS (SELECT 'compute-resources' AS domain, s_suppkey::varchar AS entity_id FROM supplier
        UNION ALL SELECT 'software-discovery', p_partkey::varchar FROM part
        UNION ALL SELECT 'allocations', o_orderkey::varchar FROM orders
        UNION ALL SELECT 'nsf-awards', c_custkey::varchar FROM customer
        UNION ALL SELECT 'affinity-groups', n_nationkey::varchar FROM nation
        UNION ALL SELECT 'other', r_regionkey::varchar FROM region)
      SELECT e.domain, entity_id, block AS guidance, block IS NOT NULL AS has_system FROM e LEFT JOIN b USING (domain)"""


@query("battery_prompts", _guidance_sql())
def battery_prompts(spark, sf):
    keys = {
        "compute-resources": ("supplier", "s_suppkey"),
        "software-discovery": ("part", "p_partkey"),
        "allocations": ("orders", "o_orderkey"),
        "nsf-awards": ("customer", "c_custkey"),
        "affinity-groups": ("nation", "n_nationkey"),
        "other": ("region", "r_regionkey"),
    }
    rows = None
    for domain, (name, key) in keys.items():
        one = table(spark, sf, name).select(F.lit(domain).alias("domain"), text(key).alias("entity_id"))
        rows = one if rows is None else rows.unionByName(one)
    system = prompts.battery_prompt(F.col("domain"))
    guidance = F.regexp_extract(system, r"(?s)Field groups:\n(.*?)\n\nRules:", 1)
    return rows.select(
        "domain", "entity_id", guidance.alias("guidance"), system.isNotNull().alias("has_system")
    )


CATALOGS = list(REGISTRY)


def _owner_sql() -> str:
    names = ", ".join(f"({n}, {quote(REGISTRY[d].display)})" for n, d in enumerate(CATALOGS))
    return f"""
      WITH g(n, display) AS (VALUES {names})
      SELECT s_suppkey, 'Supplier ' || display AS battery_owner, 'Supplier ' || display AS discovery_owner, display AS unnamed
      FROM supplier JOIN g ON n = s_suppkey % {len(CATALOGS)}"""


@query("owner_prompts", _owner_sql())
def owner_prompts(spark, sf):
    """The catalog owner in the prompts of both passes; none without a name."""
    domain = F.get(F.array(*[F.lit(d) for d in CATALOGS]), (F.col("s_suppkey") % len(CATALOGS)).cast("int"))
    none = F.array().cast("array<struct<question:string,answer:string>>")
    rows = table(spark, sf, "supplier").select(
        "s_suppkey",
        prompts.battery_prompt(domain, "Supplier").alias("battery_owner"),
        prompts.discovery_prompt(domain, none, "Supplier").alias("discovery_owner"),
        prompts.battery_prompt(domain).alias("unnamed"),
    )
    about = lambda c: F.regexp_extract(c, r"pairs about (.*?)\. You get", 1).alias(c)
    return rows.select("s_suppkey", about("battery_owner"), about("discovery_owner"), about("unnamed"))


# ---- judge ---------------------------------------------------------------------------------------------------------

SCORES_SQL = """
  SELECT doc_id, lang, source, 'doc_' || doc_id AS id,
    CASE WHEN lang IN ('en', 'de', 'fr') AND source <> 'src2' THEN
      CASE WHEN lang = 'fr' THEN 0.0 ELSE (n_chars % 1000) / 1000.0 END END::double AS f,
    CASE WHEN lang IN ('en', 'de', 'fr') AND source <> 'src2' THEN 0.9 END::double AS r,
    CASE WHEN lang IN ('en', 'de', 'fr') AND source <> 'src2' THEN CASE WHEN lang = 'de' THEN 1.0 ELSE 0.85 END END::double AS c
  FROM documents"""


def judge_answers(spark, sf):
    """One judge answer per document. de: string scores; fr: no faithfulness; es: no array;
    src2: a score that is no number; every id comes twice, the first entry is void."""
    docs = table(spark, sf, "documents")
    pid = F.concat(F.lit("doc_"), text("doc_id"))
    f = text(F.col("n_chars") % 1000 / F.lit(1000.0))
    head = F.concat(F.lit('{"pair_id":"'), pid, F.lit('",'))
    void = F.concat(head, F.lit('"faithfulness":0,"relevance":0,"completeness":0}'))
    good = (
        F.when(
            F.col("source") == "src2",
            F.concat(head, F.lit('"faithfulness":"high","relevance":0.9,"completeness":0.85}')),
        )
        .when(
            F.col("lang") == "fr",
            F.concat(head, F.lit('"relevance":0.9,"completeness":0.85,"issues":["no score","short"]}')),
        )
        .when(
            F.col("lang") == "de",
            F.concat(head, F.lit('"faithfulness":"'), f, F.lit('","relevance":" 0.9","completeness":1,"issues":[]}')),
        )
        .otherwise(
            F.concat(head, F.lit('"faithfulness":'), f, F.lit(',"relevance":0.9,"completeness":0.85,"issues":["x"]}'))
        )
    )
    answer = F.concat(F.lit('Scores: [{"other":1},'), void, F.lit(","), good, F.lit("] done"))
    answer = F.when(F.col("lang") == "es", F.lit("cannot score")).otherwise(answer)
    return docs.select("doc_id", pid.alias("id"), answer.alias("text"))


def _judged(spark, sf):
    answers = judge_answers(spark, sf)
    scores = judge.score_rows(answers, ["doc_id"])
    built = pairs.build_pair(F.col("id"), F.lit("Q"), F.lit("A"), F.lit("r"), F.lit("d"))
    rows = answers.select("doc_id", built.alias("p")).select("doc_id", "p.*")
    return judge.apply_to_rows(rows, scores, ["doc_id"])


LOWEST = "CASE WHEN f IS NULL THEN NULL ELSE least(f, r, c) END"


@query(
    "judge_scores",
    f"""SELECT id, f AS faithfulness, r AS relevance, c AS completeness, {LOWEST} AS confidence,
          CASE WHEN f IS NULL THEN NULL WHEN lang = 'fr' THEN 'no score; short' WHEN lang = 'en' THEN 'x' ELSE '' END AS issues,
          CASE WHEN f IS NULL THEN NULL WHEN least(f, r, c) >= 0.8 THEN 'approved' ELSE 'needs_review' END AS decision
        FROM ({SCORES_SQL})""",
)
def judge_scores(spark, sf):
    meta = F.col("metadata")
    return _judged(spark, sf).select(
        "id",
        meta["faithfulness_score"].alias("faithfulness"),
        meta["relevance_score"].alias("relevance"),
        meta["completeness_score"].alias("completeness"),
        meta["confidence_score"].alias("confidence"),
        F.array_join(meta["eval_issues"], "; ").alias("issues"),
        meta["suggested_decision"].alias("decision"),
    )


@query(
    "judge_list_scores",
    f"""SELECT id, {LOWEST} AS confidence,
          CASE WHEN f IS NULL THEN NULL WHEN least(f, r, c) >= 0.8 THEN 'approved' ELSE 'needs_review' END AS decision
        FROM ({SCORES_SQL})""",
)
def judge_list_scores(spark, sf):
    """The same scores attached inside the entity row, without a join."""
    answers = judge_answers(spark, sf)
    built = pairs.build_pair(F.col("id"), F.lit("Q"), F.lit("A"), F.lit("r"), F.lit("d"))
    rows = judge.apply_to_list(answers.withColumn("pairs", F.array(built)), "text")
    return rows.select(F.explode_outer("pairs").alias("p")).select(
        "p.id",
        F.col("p.metadata.confidence_score").alias("confidence"),
        F.col("p.metadata.suggested_decision").alias("decision"),
    )


@query(
    "judge_decision",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
         least(1 - l_discount, 1 - l_tax, l_quantity / 50) AS confidence,
         CASE WHEN least(1 - l_discount, 1 - l_tax, l_quantity / 50) >= 0.8 THEN 'approved' ELSE 'needs_review' END AS decision
       FROM lineitem""",
)
def judge_decision(spark, sf):
    lowest = judge.confidence(1 - F.col("l_discount"), 1 - F.col("l_tax"), F.col("l_quantity") / 50)
    rows = table(spark, sf, "lineitem").withColumn("confidence", lowest)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "confidence", judge.decision(F.col("confidence")).alias("decision"),
    )


# ---- inference with deterministic backends -----------------------------------------------------------------------------


@query(
    "infer_stub",
    """SELECT doc_id, CASE WHEN lang <> 'fr' THEN lang || '/64: ' || text END AS text,
         CASE WHEN lang = 'fr' THEN 'ValueError: no French' END AS error FROM documents""",
)
def infer_stub(spark, sf):
    def stub_backend():
        """Echo of the prompt; fails on French ones."""

        def call(system: str, user: str, max_tokens: int) -> str:
            if system == "fr":
                raise ValueError("no French")
            return f"{system}/{max_tokens}: {user}"

        return call

    rows = table(spark, sf, "documents").select(
        "doc_id", F.col("lang").alias("system"), F.col("text").alias("user")
    )
    return infer.generate(rows, stub_backend, ["doc_id"], max_tokens=64)


@query(
    "two_pass_pairs",
    """SELECT 'nsf-awards_' || c_custkey || '_1' AS id, 'What is ' || c_name || '?' AS question,
         'It is ' || c_name || '.' || chr(10) || chr(10) || '<<SRC:nsf-awards:' || c_custkey || '>>' AS answer,
         'mcp://nsf-awards/awards/' || c_custkey AS source_ref, 0.8::double AS confidence, 'approved' AS decision,
         '{"award":{"title":"' || c_name || '","segment":"' || c_mktsegment || '"}}' AS source_data
       FROM customer""",
)
def two_pass_pairs(spark, sf):
    entity = F.struct(F.col("c_name").alias("title"), F.col("c_mktsegment").alias("segment"))
    rows = table(spark, sf, "customer").select(
        F.lit("nsf-awards").alias("domain"),
        text("c_custkey").alias("entity_id"),
        F.col("c_name").alias("entity_name"),
        F.col("c_custkey").alias("ordinal"),
        F.to_json(entity).alias("entity_json"),
        F.to_json(F.struct(entity.alias("award"))).alias("source_data"),
        F.lit("0").alias("source_hash"),
    )
    tasks = spark.sparkContext.defaultParallelism * 2
    made = infer.two_pass(rows, REGISTRY["nsf-awards"], infer.echo_backend, tasks=tasks)
    made = pairs.explode_pairs(infer.judge(made, infer.echo_backend))
    return made.select(
        "id",
        pairs.question_of().alias("question"),
        pairs.answer_of().alias("answer"),
        "source_ref",
        F.col("metadata.confidence_score").alias("confidence"),
        F.col("metadata.suggested_decision").alias("decision"),
        "metadata.source_data",
    )


@query(
    "embed_join",
    """SELECT doc_id, coalesce(len(embedding), 0)::bigint AS width, round(embedding[1]::double, 5) AS first_value
       FROM documents LEFT JOIN embeddings ON vec_id = doc_id""",
)
def embed_join(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    rows = infer.join_vectors(docs, table(spark, sf, "embeddings"), "doc_id", "vec_id")
    return rows.select(
        "doc_id",
        F.coalesce(F.size("vector"), F.lit(0)).cast("bigint").alias("width"),
        F.round(F.get("vector", F.lit(0)).cast("double"), 5).alias("first_value"),
    )


@query(
    "embed_map",
    """SELECT doc_id, length(text)::double AS length, (length(text) - length(replace(text, ' ', '')))::double AS blanks
       FROM documents""",
)
def embed_map(spark, sf):
    def length_encoder():
        return lambda texts: [[len(t), t.count(" ")] for t in texts]

    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = infer.embed(docs, length_encoder, "doc_id", "text")
    return rows.select(
        "doc_id",
        F.col("vector")[0].cast("double").alias("length"),
        F.col("vector")[1].cast("double").alias("blanks"),
    )


# ---- review table -------------------------------------------------------------------------------------------------------
# live records: documents, one source_ref per source and language. Responses: from the labels.
# incoming pairs: the documents labelled toxic, so their source_refs are replaced.

LIVE_SQL = """
  SELECT 'doc_' || d.doc_id AS id, 'documents/' || source || '/' || lang AS source_ref,
    'Document ' || d.doc_id AS question, text AS answer, quality, toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
INCOMING_SQL = f"SELECT id || '_new' AS id, source_ref, question, answer FROM ({LIVE_SQL}) WHERE toxic = 1"
DEPTH_SQL = """CASE WHEN quality = 1 AND toxic = 1 THEN 'has_edits' ELSE 'approved_only' END"""


def _with_labels(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return docs.join(labels, "doc_id", "left").withColumn(
        "source_ref", F.concat_ws("/", F.lit("documents"), F.col("source"), F.col("lang"))
    )


def responses_of_labels():
    """Labelled documents have a review: submitted for quality 1, a draft else; toxic ones an edit."""

    def response(name, value, status):
        return F.struct(
            F.lit(name).alias("question_name"), value.alias("value"), status.alias("status")
        )

    status = F.when(F.col("quality") == 1, "submitted").otherwise("draft")
    edit = F.when(F.col("toxic") == 1, "better text").otherwise("")
    both = F.array(
        response("review_decision", F.lit("approved"), status), response("edited_answer", edit, status)
    )
    return F.when(F.col("quality").isNotNull(), both).otherwise(F.slice(both, 1, 0))


def _document_pairs(rows, suffix=""):
    built = pairs.build_pair(
        F.concat(F.lit("doc_"), text("doc_id"), F.lit(suffix)),
        F.concat(F.lit("Document "), text("doc_id")),
        F.col("text"),
        F.col("source_ref"),
        F.lit("documents"),
    )
    return rows.select(built.alias("p"), responses_of_labels().alias("responses")).select("p.*", "responses")


def live_records(spark, sf):
    rows = _document_pairs(_with_labels(spark, sf))
    plain = review.to_records(rows).drop("responses")
    # keep the table's columns but take the responses of the same row
    return rows.select(
        "id",
        "source_ref",
        pairs.question_of().alias("question"),
        pairs.answer_of().alias("answer"),
        F.lit("").alias("source_data"),
        F.lit("").alias("eval_issues"),
        F.lit(None).cast(plain.schema["metadata"].dataType).alias("metadata"),
        F.lit(None).cast("array<float>").alias("vector"),
        "responses",
    )


def incoming_pairs(spark, sf):
    rows = _with_labels(spark, sf).where("toxic = 1")
    return _document_pairs(rows, "_new").select(*PAIR_FIELDS)


REPLACED_SQL = f"SELECT * FROM ({LIVE_SQL}) WHERE source_ref IN (SELECT source_ref FROM ({INCOMING_SQL}))"


@query(
    "review_replace",
    f"""SELECT id, source_ref, question, answer FROM ({LIVE_SQL})
          WHERE source_ref NOT IN (SELECT source_ref FROM ({INCOMING_SQL}))
        UNION ALL SELECT id, source_ref, question, answer FROM ({INCOMING_SQL})""",
)
def review_replace(spark, sf):
    incoming = incoming_pairs(spark, sf)
    marked = review.mark_replaced(live_records(spark, sf), incoming)
    return review.replace(marked, review.to_records(incoming)).select(
        "id", "source_ref", "question", "answer"
    )


@query(
    "review_archive",
    f"""SELECT source_ref, question, answer, {DEPTH_SQL} AS annotation_depth,
          'source_data_changed' AS replaced_reason, 2::bigint AS responses
        FROM ({REPLACED_SQL}) WHERE quality = 1""",
)
def review_archive(spark, sf):
    marked = review.mark_replaced(live_records(spark, sf), incoming_pairs(spark, sf))
    return review.archive(marked).select(
        "source_ref", "question", "answer", "annotation_depth", "replaced_reason",
        F.size("responses").cast("bigint").alias("responses"),
    )


@query(
    "review_counts",
    f"""SELECT (SELECT count(*) FROM ({INCOMING_SQL})) AS pushed, count(*) AS deleted,
          count(*) FILTER (quality = 1) AS archived,
          (SELECT count(DISTINCT source_ref) FROM ({INCOMING_SQL})) AS refs FROM ({REPLACED_SQL})""",
)
def review_counts(spark, sf):
    incoming = incoming_pairs(spark, sf)
    return review.counts(review.mark_replaced(live_records(spark, sf), incoming), incoming)


@query(
    "review_pairs_per_ref",
    f"SELECT source_ref, count(*) AS pairs FROM ({INCOMING_SQL}) GROUP BY source_ref",
)
def review_pairs_per_ref(spark, sf):
    return review.per_ref(incoming_pairs(spark, sf))


@query(
    "annotation_depth",
    f"SELECT id, {DEPTH_SQL} AS depth, coalesce(quality = 1, false) AS annotated FROM ({LIVE_SQL})",
)
def annotation_depth(spark, sf):
    return live_records(spark, sf).select(
        "id", review.annotation_depth().alias("depth"), review.annotated().alias("annotated")
    )


@query(
    "review_records",
    """SELECT 'order_' || o_orderkey AS id, 'orders/' || o_custkey AS source_ref,
         'What is the state of order ' || o_orderkey || '?' AS question,
         o_orderstatus || CASE WHEN o_orderstatus = 'F' THEN ' <<SRC:orders:' || o_orderkey || '>>' ELSE '' END AS answer,
         CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '```json' || chr(10) || '{' || chr(10) ||
           '  "key": ' || o_orderkey || ',' || chr(10) || '  "priority": "' || o_orderpriority || '"' || chr(10) ||
           '}' || chr(10) || '```' END AS source_data,
         CASE WHEN o_orderstatus = 'P' THEN 'open; late' ELSE '' END AS eval_issues,
         CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS has_citation,
         'mcp_extraction' AS source_type, 'orders' AS domain
       FROM orders""",
)
def review_records(spark, sf):
    key = text("o_orderkey")
    cite = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" <<SRC:orders:"), key, F.lit(">>"))).otherwise("")
    data = F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("priority")))
    built = pairs.build_pair(
        F.concat(F.lit("order_"), key),
        F.concat(F.lit("What is the state of order "), key, F.lit("?")),
        F.concat(F.col("o_orderstatus"), cite),
        F.concat(F.lit("orders/"), text("o_custkey")),
        F.lit("orders"),
        source_data=F.when(F.col("o_orderpriority") != "5-LOW", data),
    )
    issues = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("open"), F.lit("late")))
    built = built.withField("metadata.eval_issues", issues)
    rows = table(spark, sf, "orders").select(built.alias("p")).select("p.*")
    return review.to_records(rows).select(
        "id", "source_ref", "question", "answer", "source_data", "eval_issues",
        "metadata.has_citation", "metadata.source_type", "metadata.domain",
    )


# ---- coverage -----------------------------------------------------------------------------------------------------------

NAMED_SQL = """SELECT s_suppkey, CASE WHEN s_acctbal < 3000 THEN s_name || ' COMING SOON' ELSE s_name END AS name,
  CASE WHEN s_acctbal < 1000 THEN '' ELSE 'text' END AS description FROM supplier"""


@query(
    "coverage_report",
    f"""SELECT 'compute-resources' AS source, 'list-all' AS strategy, (SELECT count(*) FROM supplier) AS fetched,
          count(*) AS unique_entities, (SELECT string_agg(k, ', ' ORDER BY k::bigint) FROM (
            SELECT s_suppkey::varchar AS k FROM ({NAMED_SQL})
            WHERE NOT (contains(name, 'COMING SOON') AND description = '') ORDER BY s_suppkey LIMIT 5)) AS sample_ids
        FROM ({NAMED_SQL}) WHERE NOT (contains(name, 'COMING SOON') AND description = '')
        UNION ALL
        SELECT 'software-discovery', 'list-all', (SELECT count(*) FROM part), count(DISTINCT p_name),
          (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT DISTINCT lower(p_name) AS k FROM part ORDER BY 1 LIMIT 5))
        FROM part
        UNION ALL
        SELECT 'affinity-groups', 'list-all', (SELECT count(*) FROM events), count(DISTINCT user_id),
          (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT DISTINCT user_id::varchar AS k FROM events ORDER BY 1 LIMIT 5))
        FROM events""",
)
def coverage_report(spark, sf):
    s = table(spark, sf, "supplier")
    named = s.select(
        text("s_suppkey").alias("entity_id"),
        F.col("s_suppkey").alias("ordinal"),
        F.when(F.col("s_acctbal") < 3000, F.concat(F.col("s_name"), F.lit(" COMING SOON")))
        .otherwise(F.col("s_name")).alias("name"),
        F.when(F.col("s_acctbal") < 1000, "").otherwise("text").alias("description"),
    )
    software = table(spark, sf, "part").select(F.lower("p_name").alias("entity_id"))
    groups = table(spark, sf, "events").select(text("user_id").alias("entity_id"))
    first = reports.coverage(named, "compute-resources", required=("name",), skip=reports.coming_soon())
    second = reports.coverage(software, "software-discovery", distinct=True)
    third = reports.coverage(groups, "affinity-groups", distinct=True)
    return first.unionByName(second).unionByName(third)
