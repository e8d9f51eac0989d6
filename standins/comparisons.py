"""Comparison pairs over the stand-in catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import compare

from .base import query, quote, slug_sql, table, text

PROGRAM = "catalog"
T = compare.templates(PROGRAM)
SMALL_CHUNK = 7


def flat(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        F.col("group").alias("group_value"),
        "members",
        "question",
        "answer",
        "source_ref",
        "domain",
        "complexity",
        "granularity",
        "has_citation",
        F.array_join("resources", "|").alias("resources"),
        F.coalesce("software", F.lit("")).alias("software"),
    )


# ---- SQL twins -------------------------------------------------------------------------------------


def _text_sql(template: str, label: str = "label", group: str = "grp", count: str = "n") -> str:
    out = quote(template)
    for mark, value in (("{label}", label), ("{group}", group), ("{count}", f"{count}::varchar")):
        out = out.replace(mark, f"' || {value} || '")
    return out


def _columns(t: compare.Template) -> str:
    label = "lower(label)" if t.lower_label else "label"
    pid = f"'{t.id_prefix}_' || {slug_sql('grp')}"
    return f"""
      {pid} AS id, grp AS group_value, n AS members,
      {_text_sql(t.question, label)} AS question, answer,
      'mcp://comparison/' || {pid} AS source_ref, '{t.domain}' AS domain,
      'moderate' AS complexity, 'comparison' AS granularity, true AS has_citation,
      resources, {'grp' if t.software else "''"} AS software"""


def listing_sql(members: str, t: compare.Template) -> str:
    by_name = "name, ordinal, sub, entity_id"
    by_arrival = "ordinal, sub, entity_id" if t.arrival else by_name
    extra = "|| chr(10) || chr(10) || '<<SRC:software-discovery:' || grp || '>>'" if t.software else ""
    return f"""
    WITH m AS ({members}),
    g AS (
      SELECT grp, max(label) AS label, count(*) AS n,
        list(name ORDER BY {by_name}) AS names,
        string_agg(chr(10) || chr(10) || '<<SRC:{t.cited_domain}:' || entity_id || '>>', '' ORDER BY {by_name}) AS cites,
        string_agg(entity_id, '|' ORDER BY {by_arrival}) AS resources
      FROM m GROUP BY grp HAVING count(*) >= {t.minimum}),
    r AS (
      SELECT *,
        {_text_sql(t.lead)} || ' ' ||
        CASE WHEN n = 2 THEN names[1] || ' and ' || names[2]
             ELSE array_to_string(names[1:n-1], ', ') || ', and ' || names[n] END
        || {_text_sql(t.tail)} || cites {extra} AS answer
      FROM g)
    SELECT {_columns(t)} FROM r"""


def sampled_sql(members: str, t: compare.Template) -> str:
    return f"""
    WITH m AS ({members}),
    p AS (
      SELECT *, row_number() OVER (PARTITION BY grp ORDER BY name, ordinal, sub, entity_id) AS pos,
        row_number() OVER (PARTITION BY grp ORDER BY ordinal, sub, entity_id) AS arr FROM m),
    g AS (
      SELECT grp, max(label) AS label, count(*) AS n,
        list(name ORDER BY pos) FILTER (pos <= 5) AS names,
        string_agg(chr(10) || chr(10) || '<<SRC:{t.cited_domain}:' || entity_id || '>>', '' ORDER BY pos)
          FILTER (pos <= 5) AS cites,
        string_agg(entity_id, '|' ORDER BY arr) FILTER (arr <= 5) AS resources
      FROM p GROUP BY grp HAVING count(*) >= {t.minimum}),
    r AS (
      SELECT *,
        {_text_sql(t.lead)} || CASE WHEN n > 5 THEN ', including ' ELSE ': ' END ||
        CASE len(names) WHEN 1 THEN names[1] WHEN 2 THEN names[1] || ' and ' || names[2]
             ELSE array_to_string(names[1:len(names)-1], ', ') || ', and ' || names[len(names)] END
        || '.' || cites AS answer
      FROM g)
    SELECT {_columns(t)} FROM r"""


# ---- stand-in catalogs --------------------------------------------------------------------------------

RESOURCES_SQL = """
  SELECT 'sup' || s_suppkey || '.' || lower(n_name) || '.org' AS entity_id,
    replace(s_name, '#', '-') AS name, s_suppkey AS ordinal, n_name AS organization,
    s_acctbal > 4000 AS has_gpu, s_acctbal, n_regionkey
  FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def resources(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as compute resources."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    gpu = F.array_compact(
        F.array(
            F.when(F.col("s_acctbal") > 8000, F.lit("NVIDIA H100 80GB"))
            .when(F.col("s_acctbal") > 4000, F.lit("nvidia a100-sxm"))
            .when(F.col("s_acctbal") > 2000, F.lit("unknown card")),
            F.when(F.col("s_acctbal") > 6000, F.lit("A100")),
            F.when(F.col("n_regionkey") == 2, F.lit("Quadro RTX 6000 ")),
        )
    )
    features = F.array_compact(
        F.array(
            F.when(F.col("s_acctbal") > 4000, F.lit("GPU Acceleration")),
            F.when(F.col("n_regionkey") < 3, F.lit("Container Support")),
            F.lit("Large Storage"),
            F.when(F.col("n_regionkey") == 4, F.lit("AI/ML Optimized")),
        )
    )
    return rows.select(
        F.concat(F.lit("sup"), text("s_suppkey"), F.lit("."), F.lower("n_name"), F.lit(".org")).alias("entity_id"),
        F.replace("s_name", F.lit("#"), F.lit("-")).alias("name"),
        F.col("s_suppkey").alias("ordinal"),
        F.array("n_name").alias("organizations"),
        (F.col("s_acctbal") > 4000).alias("has_gpu"),
        gpu.alias("gpu_types"),
        features.alias("features"),
    )


def members_sql(source: str, group: str, sub: str = "0", where: str = "true", label: str | None = None) -> str:
    return (
        f"SELECT {group} AS grp, {label or group} AS label, name, ordinal, {sub} AS sub, entity_id "
        f"FROM ({source}) WHERE {where}"
    )


GPU_SQL = f"""
  WITH raw AS (
    SELECT *, unnest(list_filter([
        CASE WHEN s_acctbal > 8000 THEN 'NVIDIA H100 80GB' WHEN s_acctbal > 4000 THEN 'nvidia a100-sxm'
             WHEN s_acctbal > 2000 THEN 'unknown card' END,
        CASE WHEN s_acctbal > 6000 THEN 'A100' END,
        CASE WHEN n_regionkey = 2 THEN 'Quadro RTX 6000 ' END], lambda x: x IS NOT NULL)) AS gpu
    FROM ({RESOURCES_SQL})),
  named AS (SELECT *, 'NVIDIA ' || regexp_extract(upper(trim(gpu)),
      '(A100|V100|H100|A40|A30|A10|RTX\\s*\\d+)', 1) AS model FROM raw)
  SELECT model AS grp, model AS label, name, ordinal, 0 AS sub, entity_id FROM named WHERE model <> 'NVIDIA '"""


@query("cmp_gpu", listing_sql(GPU_SQL, T["gpu"]))
def cmp_gpu(spark, sf):
    return flat(compare.listing(compare.gpu_members(resources(spark, sf)), T["gpu"]))


@query(
    "cmp_gpu_distinct",
    listing_sql(f"SELECT grp, label, name, ordinal, min(sub) AS sub, entity_id FROM ({GPU_SQL}) GROUP BY ALL", T["gpu"]),
)
def cmp_gpu_distinct(spark, sf):
    """Resources that name a model twice count once."""
    members = compare.distinct_members(compare.gpu_members(resources(spark, sf)))
    return flat(compare.listing(members, T["gpu"]))


FEATURE_SQL = f"""
  SELECT feature AS grp, feature AS label, name, ordinal, 0 AS sub, entity_id FROM (
    SELECT *, unnest([CASE WHEN s_acctbal > 4000 THEN 'GPU Acceleration' END,
      CASE WHEN n_regionkey < 3 THEN 'Container Support' END,
      CASE WHEN n_regionkey = 4 THEN 'AI/ML Optimized' END]) AS feature FROM ({RESOURCES_SQL}))
  WHERE feature IS NOT NULL"""


@query("cmp_feature", listing_sql(FEATURE_SQL, T["feature"]))
def cmp_feature(spark, sf):
    return flat(compare.listing(compare.feature_members(resources(spark, sf)), T["feature"]))


@query("cmp_org", listing_sql(members_sql(RESOURCES_SQL, "organization"), T["organization"]))
def cmp_org(spark, sf):
    return flat(compare.listing(compare.by_element(resources(spark, sf), "organizations"), T["organization"]))


# ---- software: parts, installed on the suppliers of their line items ------------------------------------

SHORT_SQL = """
  CASE WHEN l_returnflag = 'A' THEN 'Sup' || l_suppkey
       WHEN l_returnflag = 'N' THEN ' SUPPLIER' || lpad(l_suppkey::varchar, 9, '0')
       WHEN l_linestatus = 'O' THEN 'sup' || l_suppkey || '.n'
       ELSE 'lab-' || l_suppkey || ' east' END"""

# name lookup by the rules: equal key (later resource wins), key without hyphens, id prefix, fall-back
RESOLVE_SQL = f"""
  res AS ({RESOURCES_SQL}),
  keys AS (
    SELECT key, arg_max({{'id': entity_id, 'name': name}}, ordinal * 3 + nth) AS hit FROM (
      SELECT *, unnest([lower(name), lower(split_part(entity_id, '.', 1)),
        CASE WHEN contains(name, '-') THEN replace(lower(name), '-', '') END]) AS key,
        unnest([0, 1, 2]) AS nth FROM res) WHERE key IS NOT NULL GROUP BY key),
  wanted AS (SELECT DISTINCT short, lower(trim(short)) AS s1, replace(lower(trim(short)), '-', '') AS s2 FROM links),
  tried AS (
    SELECT short, s1, coalesce(a.hit, b.hit) AS hit
    FROM wanted LEFT JOIN keys a ON a.key = s1 LEFT JOIN keys b ON b.key = s2),
  pref AS (
    SELECT short, arg_min({{'id': entity_id, 'name': name}}, ordinal) AS hit
    FROM tried JOIN res ON starts_with(lower(entity_id), s1) WHERE hit IS NULL GROUP BY short),
  resolved AS (
    SELECT short, coalesce(tried.hit, pref.hit) AS hit FROM tried LEFT JOIN pref USING (short)),
  named AS (
    SELECT short, coalesce(hit.id, short) AS resource_id, hit IS NOT NULL AS resolved,
      coalesce(hit.name, replace(array_to_string(list_transform(regexp_extract_all(short, '([\\p{{L}}]+|[^\\p{{L}}]+)', 1),
        lambda w: upper(w[1]) || lower(w[2:])), ''), '-', ' ')) AS resource_name
    FROM resolved)"""

LINKS_SQL = f"""
  links AS (
    SELECT l_partkey::varchar AS software, p_name AS display, l_partkey AS ordinal,
      l_orderkey * 8 + l_linenumber AS sub, {SHORT_SQL} AS short
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def short_name():
    flag, key = F.col("l_returnflag"), text("l_suppkey")
    return (
        F.when(flag == "A", F.concat(F.lit("Sup"), key))
        .when(flag == "N", F.concat(F.lit(" SUPPLIER"), F.lpad(key, 9, "0")))
        .when(F.col("l_linestatus") == "O", F.concat(F.lit("sup"), key, F.lit(".n")))
        .otherwise(F.concat(F.lit("lab-"), key, F.lit(" east")))
    )


def links(spark: SparkSession, sf: str) -> DataFrame:
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    rows = li.join(p, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        text("l_partkey").alias("software"),
        F.col("p_name").alias("display"),
        F.col("l_partkey").alias("ordinal"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sub"),
        short_name().alias("short"),
    )


@query(
    "resolve_names",
    f"WITH {LINKS_SQL}, {RESOLVE_SQL} SELECT short, resource_id, resource_name, resolved FROM named",
)
def resolve_names(spark, sf):
    return compare.resolve_names(links(spark, sf), resources(spark, sf))


SOFTWARE_SQL = f"""
  WITH {LINKS_SQL}, {RESOLVE_SQL}
  SELECT software AS grp, display AS label, resource_name AS name, ordinal, sub, resource_id AS entity_id
  FROM links JOIN named USING (short)"""


@query("cmp_software", listing_sql(SOFTWARE_SQL, T["software"]))
def cmp_software(spark, sf):
    return flat(compare.software_listing(links(spark, sf), resources(spark, sf), T["software"]))


# part types stand for software names here, so a sixth of all rows belongs to one software
KIND_SQL = """
  CASE p_type WHEN 'STANDARD' THEN 'pytorch' WHEN 'MEDIUM' THEN 'tensorflow' WHEN 'SMALL' THEN 'jax'
       WHEN 'LARGE' THEN 'cuda' WHEN 'ECONOMY' THEN 'gcc' ELSE 'rapids' END"""

GPU_SOFTWARE_SQL = f"""
  WITH links AS (
    SELECT {KIND_SQL} AS software, l_orderkey * 8 + l_linenumber AS sub, {SHORT_SQL} AS short
    FROM lineitem JOIN part ON l_partkey = p_partkey), {RESOLVE_SQL}
  SELECT DISTINCT software AS grp, upper(software) AS label, res.name, 0 AS ordinal, 0 AS sub, res.entity_id
  FROM links JOIN named USING (short) JOIN res ON res.entity_id = named.resource_id
  WHERE software <> 'gcc' AND resolved AND has_gpu"""


@query("cmp_cross_domain", listing_sql(GPU_SOFTWARE_SQL, T["gpu_software"]))
def cmp_cross_domain(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    kind = F.col("p_type")
    names = {"STANDARD": "pytorch", "MEDIUM": "tensorflow", "SMALL": "jax", "LARGE": "cuda", "ECONOMY": "gcc"}
    software = F.lit("rapids")
    for key, value in names.items():
        software = F.when(kind == key, F.lit(value)).otherwise(software)
    rows = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        software.alias("software"),
        F.upper(software).alias("display"),
        F.lit(0).cast("bigint").alias("ordinal"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("sub"),
        short_name().alias("short"),
    )
    members = compare.gpu_software_members(rows, resources(spark, sf))
    return flat(compare.listing(members, T["gpu_software"]))


# ---- projects: orders ---------------------------------------------------------------------------------------

PROJECTS_SQL = """
  SELECT o_orderkey::varchar AS entity_id, c_name || ' ' || o_orderstatus AS name, o_orderkey AS ordinal,
    o_orderpriority AS fos, c_mktsegment AS institution
  FROM orders JOIN customer ON o_custkey = c_custkey"""


def projects(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        text("o_orderkey").alias("entity_id"),
        F.concat_ws(" ", "c_name", "o_orderstatus").alias("name"),
        F.col("o_orderkey").alias("ordinal"),
        F.col("o_orderpriority").alias("fos"),
        F.col("c_mktsegment").alias("institution"),
    )


@query("cmp_project_field", sampled_sql(members_sql(PROJECTS_SQL, "fos"), T["project_field"]))
def cmp_project_field(spark, sf):
    return flat(compare.sampled(compare.by_field(projects(spark, sf), "fos"), T["project_field"]))


@query(
    "cmp_project_inst",
    sampled_sql(members_sql(PROJECTS_SQL, "institution"), T["project_institution"]),
)
def cmp_project_inst(spark, sf):
    members = compare.by_field(projects(spark, sf), "institution")
    return flat(compare.sampled(members, T["project_institution"]))


PROJECT_RESOURCE_SQL = """
  SELECT s_name AS grp, s_name AS label, 'Order ' || l_orderkey AS name, l_orderkey AS ordinal,
    l_linenumber AS sub, l_orderkey::varchar AS entity_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""


@query("cmp_project_resource", sampled_sql(PROJECT_RESOURCE_SQL, T["project_resource"]))
def cmp_project_resource(spark, sf):
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    members = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("group"),
        F.col("s_name").alias("label"),
        F.concat(F.lit("Order "), text("l_orderkey")).alias("name"),
        F.col("l_orderkey").alias("ordinal"),
        F.col("l_linenumber").alias("sub"),
        text("l_orderkey").alias("entity_id"),
    )
    return flat(compare.sampled(members, T["project_resource"]))


# ---- awards: customers ------------------------------------------------------------------------------------------

AWARDS_SQL = """
  SELECT c_custkey::varchar AS entity_id, c_name AS name, c_custkey AS ordinal,
    c_mktsegment AS program, n_name AS institution
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def awards(spark: SparkSession, sf: str) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        text("c_custkey").alias("entity_id"),
        F.col("c_name").alias("name"),
        F.col("c_custkey").alias("ordinal"),
        F.col("c_mktsegment").alias("fund_program_name"),
        F.col("n_name").alias("institution"),
    )


@query("cmp_award_program", sampled_sql(members_sql(AWARDS_SQL, "program"), T["award_program"]))
def cmp_award_program(spark, sf):
    members = compare.by_field(awards(spark, sf), "fund_program_name")
    return flat(compare.sampled(members, T["award_program"]))


@query("cmp_award_inst", sampled_sql(members_sql(AWARDS_SQL, "institution"), T["award_institution"]))
def cmp_award_inst(spark, sf):
    members = compare.by_field(awards(spark, sf), "institution")
    return flat(compare.sampled(members, T["award_institution"]))


# ---- groups: parts by brand ----------------------------------------------------------------------------------------

GROUPS_SQL = """
  SELECT p_partkey::varchar AS entity_id, p_name AS name, p_partkey AS ordinal, p_brand AS category FROM part"""


def groups(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        text("p_partkey").alias("entity_id"),
        F.col("p_name").alias("name"),
        F.col("p_partkey").alias("ordinal"),
        F.col("p_brand").alias("category"),
    )


@query("cmp_group_category", listing_sql(members_sql(GROUPS_SQL, "category"), T["group_category"]))
def cmp_group_category(spark, sf):
    members = compare.by_field(groups(spark, sf), "category")
    return flat(compare.listing(members, T["group_category"]))


@query("cmp_group_category_chunks", listing_sql(members_sql(GROUPS_SQL, "category"), T["group_category"]))
def cmp_group_category_chunks(spark, sf):
    """The same pairs with the way of large groups, whose text is put together from chunks."""
    members = compare.by_field(groups(spark, sf), "category")
    return flat(compare.listing(members, T["group_category"], chunk=SMALL_CHUNK))


@query("cmp_org_chunks", listing_sql(members_sql(RESOURCES_SQL, "organization"), T["organization"]))
def cmp_org_chunks(spark, sf):
    """Chunks with the resources in arrival order."""
    members = compare.by_element(resources(spark, sf), "organizations")
    return flat(compare.listing(members, T["organization"], chunk=3))


@query(
    "cmp_member_rows",
    f"""
    WITH m AS ({members_sql(GROUPS_SQL, "category")}),
    p AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n,
        row_number() OVER (PARTITION BY grp ORDER BY name, ordinal, sub, entity_id) AS by_name,
        row_number() OVER (PARTITION BY grp ORDER BY ordinal, sub, entity_id) AS by_arrival FROM m)
    SELECT '{T["group_category"].id_prefix}_' || {slug_sql('grp')} AS id, grp AS "group", by_name, by_arrival, name, entity_id,
      chr(10) || chr(10) || '<<SRC:{T["group_category"].cited_domain}:' || entity_id || '>>' AS marker
    FROM p WHERE n >= {T["group_category"].minimum}""",
)
def cmp_member_rows(spark, sf):
    return compare.member_rows(compare.by_field(groups(spark, sf), "category"), T["group_category"])


GENERIC = compare.Template(
    "cmp_sup", "suppliers", "Which suppliers are in {group}?", "There are {count} suppliers in {group}", minimum=3
)


@query("cmp_generic", sampled_sql(members_sql(RESOURCES_SQL, "organization"), GENERIC))
def cmp_generic(spark, sf):
    rows = resources(spark, sf).withColumn("organization", F.get("organizations", F.lit(0)))
    return flat(compare.sampled(compare.by_field(rows, "organization"), GENERIC))
