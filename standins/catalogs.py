"""Landed responses and cleaning of the five catalogs, with items built from tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import domains
from corpusloom.settings import ExtractionConfig
from corpusloom.sources import landed

from .base import query, slug_sql, strip_html_sql, table, text  # noqa: F401

CONFIG = ExtractionConfig()
PAGE = 50
STRIDE = landed.PAGE_STRIDE


def pages_of(rows, page, order, item, body):
    """Item rows to landed pages: PAGE items each, so every page is bounded."""
    packed = rows.groupBy(page.alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(order.alias("_o"), item.alias("i")))).alias("_l")
    )
    items = F.transform("_l", lambda x: x["i"])
    return packed.select("page", body(items).alias("value"))


def scanned(pages, name):
    spec = domains.REGISTRY[name]
    return landed.explode_items(pages, spec.item_type, spec.list_keys)


def cleaned(items, name, details=None, config=CONFIG):
    spec = domains.REGISTRY[name]
    return domains.cleaned(spec, domains.attach_details(domains.pick(spec, items, config), details, spec), config)


# ---- scans -------------------------------------------------------------------------------------------


# the kind of a page goes by part type; LARGE parts are on pages whose text is no JSON
PAGE_KIND = {"STANDARD": 1, "PROMO": 1, "ECONOMY": 1, "MEDIUM": 2, "SMALL": 3, "LARGE": 4}
KIND_SQL = "CASE p_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PAGE_KIND.items()) + " END"
ENVELOPE_PAGE = f"({KIND_SQL} * 100000000 + p_partkey // {PAGE})"


@query(
    "scan_envelope",
    f"""SELECT {ENVELOPE_PAGE} * {STRIDE} + row_number() OVER (PARTITION BY {ENVELOPE_PAGE} ORDER BY p_partkey) - 1
          AS ordinal, p_partkey::varchar AS id, p_name AS name, p_brand AS organization
        FROM part WHERE p_type <> 'LARGE'""",
)
def scan_envelope(spark, sf):
    """Tool-response envelope, plain object, other list key, envelope with text that is no JSON."""
    item = F.struct(
        text("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.array("p_brand").alias("organization_names"),
    )
    kind = F.lit(None)
    for name, number in PAGE_KIND.items():
        kind = F.when(F.col("p_type") == name, F.lit(number)).otherwise(kind)
    page = kind.cast("bigint") * 100_000_000 + F.floor(F.col("p_partkey") / PAGE)

    def body(items):
        plain = F.to_json(F.struct(items.alias("resources")))
        other = F.to_json(F.struct(items.alias("items"), F.size(items).alias("total")))

        def envelope(inner):
            return F.to_json(
                F.struct(F.array(F.struct(F.lit("text").alias("type"), inner.alias("text"))).alias("content"))
            )

        kind = F.floor(F.col("page") / 100_000_000)
        return (
            F.when(kind == 1, envelope(plain))
            .when(kind == 2, plain)
            .when(kind == 3, envelope(other))
            .otherwise(envelope(F.concat(F.lit("error: "), plain)))
        )

    rows = scanned(pages_of(table(spark, sf, "part"), page, F.col("p_partkey"), item, body), "compute-resources")
    return rows.select("ordinal", "id", "name", F.array_join("organization_names", ",").alias("organization"))


ORDER_ITEM_SQL = """
  SELECT o.*, c_name, c_mktsegment FROM orders o JOIN customer ON o_custkey = c_custkey"""


def project_pages(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    resource = F.struct(
        F.when(status != "F", F.concat(F.lit("GPU "), status)).alias("resourceName"),
        F.lit("hours").alias("units"),
        F.floor("o_totalprice").alias("allocation"),
    )
    second = F.struct(F.lit("Disk").alias("resourceName"), F.lit(None).cast("string").alias("units"),
                      F.lit(None).cast("bigint").alias("allocation"))
    item = F.struct(
        F.when(status != "P", F.col("o_orderkey")).alias("projectId"),
        F.concat(F.lit("REQ"), text("o_orderkey")).alias("requestNumber"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("Order of "), F.col("c_name"))).alias("requestTitle"),
        F.col("c_name").alias("pi"),
        F.col("c_mktsegment").alias("piInstitution"),
        F.col("o_orderpriority").alias("fos"),
        F.concat(F.lit("<p>State  <b>"), status, F.lit("</b></p> ")).alias("abstract"),
        F.lit("").alias("beginDate"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("endDate"),
        F.array(resource, second).alias("resources"),
    )
    page = F.floor(F.col("o_orderkey") / PAGE) + 1
    return pages_of(
        rows, page, F.col("o_orderkey"), item,
        lambda items: F.to_json(F.struct(items.alias("projects"), F.lit(9).alias("pages"))),
    )


PROJECT_ORDINAL = f"""(o_orderkey // {PAGE} + 1) * {STRIDE}
  + row_number() OVER (PARTITION BY o_orderkey // {PAGE} ORDER BY o_orderkey) - 1"""


@query(
    "scan_projects",
    f"""SELECT {PROJECT_ORDINAL} AS ordinal,
          CASE WHEN o_orderstatus <> 'P' THEN o_orderkey::varchar END AS project_id,
          'REQ' || o_orderkey AS request_number, c_name AS pi, o_orderpriority AS fos
        FROM ({ORDER_ITEM_SQL})""",
)
def scan_projects(spark, sf):
    return scanned(project_pages(spark, sf), "allocations").select(
        "ordinal", F.col("projectId").alias("project_id"), F.col("requestNumber").alias("request_number"), "pi", "fos"
    )


@query(
    "clean_projects",
    f"""SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey::varchar ELSE 'REQ' || o_orderkey END AS entity_id,
          'Order of ' || c_name AS title, c_mktsegment AS institution, 'State ' || o_orderstatus AS abstract,
          '' AS begin_date, strftime(o_orderdate, '%Y-%m-%d') AS end_date,
          CASE WHEN o_orderstatus <> 'F' THEN 'GPU ' || o_orderstatus || ':hours:' || floor(o_totalprice)::bigint || '|' ELSE '' END
            || 'Disk::""' AS resources,
          2::bigint AS resource_count,
          CASE WHEN o_orderstatus <> 'F' THEN 'GPU ' || o_orderstatus || '|' ELSE '' END || 'Disk' AS resource_names
        FROM ({ORDER_ITEM_SQL}) WHERE o_orderpriority <> '5-LOW'""",
)
def clean_projects(spark, sf):
    rows = cleaned(scanned(project_pages(spark, sf), "allocations"), "allocations")
    entity = F.col("entity")
    listed = F.transform(
        entity["resources"],
        lambda r: F.concat_ws(":", r["name"], r["units"], F.to_json(r["allocation"])),
    )
    return rows.select(
        "entity_id",
        entity["title"].alias("title"),
        entity["institution"].alias("institution"),
        entity["abstract"].alias("abstract"),
        F.coalesce(entity["beginDate"], F.lit("")).alias("begin_date"),
        entity["endDate"].alias("end_date"),
        F.array_join(listed, "|").alias("resources"),
        F.col("record.resource_count").cast("bigint").alias("resource_count"),
        F.array_join("record.resource_names", "|").alias("resource_names"),
    )


# ---- awards: customers ----------------------------------------------------------------------------------

CUSTOMER_SQL = "SELECT c.*, n_name FROM customer c JOIN nation ON c_nationkey = n_nationkey"
AWARD_NUMBER = "(c_custkey // 2)::varchar"


def award_pages(spark, sf):
    """Two customers share an award number, so the later one is a duplicate. Co-PIs and programs come
    as list or as text by market segment."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    segment = F.col("c_mktsegment")
    names = F.concat(F.lit(" Ann "), F.col("n_name"), F.lit(" ; ;Bob B "))
    listed = F.to_json(F.array(F.concat(F.lit("Ann "), F.col("n_name")), F.lit(" "), F.lit("Bob B")))
    amount = text(F.floor(F.col("c_acctbal") * 1000))

    def raw(c):
        return F.concat(F.lit('"'), c, F.lit('"'))

    fields = {
        "id": raw(text(F.floor(F.col("c_custkey") / 2))),
        "title": raw(F.concat(F.lit("Award of "), F.col("c_name"))),
        "piFirstName": raw(F.lit(" Pat ")),
        "piLastName": raw(F.when(segment == "BUILDING", F.lit("")).otherwise(F.lit("Lee "))),
        "coPDPI": F.when(segment == "HOUSEHOLD", listed).when(segment == "BUILDING", F.lit("null")).otherwise(raw(names)),
        "awardeeName": raw(F.col("n_name")),
        "estimatedTotalAmt": raw(amount),
        "fundsObligatedAmt": F.when(segment == "MACHINERY", F.lit('"none yet"')).otherwise(F.lit('""')),
        "startDate": F.lit('"01/01/2024"'),
        "abstractText": raw(F.concat(F.lit("<p>About</p>  "), segment)),
        "fundProgramName": F.when(
            segment == "HOUSEHOLD", F.to_json(F.array(segment, F.lit("EXTRA")))
        ).otherwise(raw(segment)),
        "primaryProgram": F.lit("[]"),
    }
    parts = []
    for key, value in fields.items():
        parts += [F.lit(f'{"," if parts else "{"}"{key}":'), value]
    item = F.concat(*parts, F.lit("}"))
    page = F.floor(F.col("c_custkey") / PAGE) + 1
    return pages_of(
        rows, page, F.col("c_custkey"), item,
        lambda items: F.concat(F.lit('{"response":{"award":['), F.array_join(items, ","), F.lit("]}}")),
    )


AWARD_ORDINAL = f"""(c_custkey // {PAGE} + 1) * {STRIDE}
  + row_number() OVER (PARTITION BY c_custkey // {PAGE} ORDER BY c_custkey) - 1"""


@query(
    "scan_awards",
    f"""SELECT {AWARD_ORDINAL} AS ordinal, {AWARD_NUMBER} AS id, 'Award of ' || c_name AS title FROM ({CUSTOMER_SQL})""",
)
def scan_awards(spark, sf):
    return scanned(award_pages(spark, sf), "nsf-awards").select("ordinal", "id", "title")


MONEY = "'$' || format('{:,}', floor(c_acctbal * 1000)::bigint)"
CO_PIS = "CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE 'Ann ' || n_name || '|Bob B' END"
PI = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Pat' ELSE 'Pat Lee' END"
PROGRAM = "c_mktsegment || CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '; EXTRA' ELSE '' END"
PAID = "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'none yet' ELSE '' END"


@query(
    "normalize_awards",
    f"""SELECT {AWARD_ORDINAL} AS ordinal, {AWARD_NUMBER} AS award_number, n_name AS institution, {PI} AS pi,
          {CO_PIS} AS co_pis, {MONEY} AS intended, {PAID} AS awarded, '' AS end_date,
          '<p>About</p>  ' || c_mktsegment AS abstract, {PROGRAM} AS program, '' AS budget_code FROM ({CUSTOMER_SQL})""",
)
def normalize_awards(spark, sf):
    rows = domains.normalize_awards(scanned(award_pages(spark, sf), "nsf-awards"))
    return rows.select(
        "ordinal",
        F.col("awardNumber").alias("award_number"),
        "institution",
        F.col("principalInvestigator").alias("pi"),
        F.array_join("coPIs", "|").alias("co_pis"),
        F.col("totalIntendedAward").alias("intended"),
        F.col("totalAwardedToDate").alias("awarded"),
        F.col("endDate").alias("end_date"),
        "abstract",
        F.col("fundProgramName").alias("program"),
        F.col("primaryProgramCode").alias("budget_code"),
    )


@query(
    "clean_awards",
    f"""SELECT {AWARD_NUMBER} AS entity_id, 'Award of ' || c_name AS title, {PI} AS pi, {MONEY} AS intended,
          'About ' || c_mktsegment AS abstract, nullif({PAID}, '') AS awarded, nullif({CO_PIS}, '') AS co_pis,
          c_mktsegment <> 'BUILDING' AS has_co_pis
        FROM ({CUSTOMER_SQL}) QUALIFY row_number() OVER (PARTITION BY {AWARD_NUMBER} ORDER BY c_custkey) = 1""",
)
def clean_awards(spark, sf):
    rows = cleaned(scanned(award_pages(spark, sf), "nsf-awards"), "nsf-awards")
    entity = F.col("entity")
    return rows.select(
        "entity_id",
        entity["title"].alias("title"),
        entity["principal_investigator"].alias("pi"),
        entity["total_intended_award"].alias("intended"),
        entity["abstract"].alias("abstract"),
        entity["totalAwardedToDate"].alias("awarded"),
        F.array_join(entity["co_pis"], "|").alias("co_pis"),
        F.col("record.has_co_pis").alias("has_co_pis"),
    )


# ---- resources: suppliers, with hardware details ------------------------------------------------------------

SUPPLIER_SQL = "SELECT s.*, n_name, n_regionkey FROM supplier s JOIN nation ON s_nationkey = n_nationkey"
LONG = "node with two NVIDIA A100 40GB cards and one v100, for "


def resource_items(spark, sf):
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    soon = F.when(F.col("s_acctbal") < 2000, F.concat(F.col("s_name"), F.lit(" - COMING SOON"))).otherwise(F.col("s_name"))
    value = F.to_json(
        F.struct(
            text("s_suppkey").alias("id"),
            soon.alias("name"),
            F.concat(F.lit("<b>In</b>\n\n"), F.col("n_name")).alias("description"),
            F.array("n_name").alias("organization_names"),
            F.array(F.lit("Unknown 12"), F.lit("Container Support"), F.col("n_name")).alias("feature_names"),
            (F.col("s_acctbal") > 5000).alias("hasGpu"),
            F.lit("Compute").alias("resourceType"),
        )
    )
    spec = domains.REGISTRY["compute-resources"]
    return rows.select(F.col("s_suppkey").alias("ordinal"), F.from_json(value, spec.item_type).alias("i")).select(
        "ordinal", "i.*"
    )


def hardware_details(spark, sf):
    """Details of the suppliers above 3000: half inside a ``hardware`` field, half plain."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    rows = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).where("s_acctbal > 3000")

    def entry(name, details):
        return F.struct(name.alias("name"), F.lit("t").alias("type"), details.alias("details"))

    long_text = F.concat(F.lit("<i>" + LONG), F.col("n_name"), F.lit("</i>"))
    hardware = F.to_json(
        F.struct(
            F.array(
                entry(F.concat(F.lit("A100-"), F.col("n_name")), long_text), entry(F.lit("tiny"), F.lit("short"))
            ).alias("gpus"),
            F.array(entry(F.lit("node"), long_text)).alias("compute_nodes"),
            F.array(entry(F.lit("disk"), F.lit("small disk"))).alias("storage"),
        )
    )
    value = F.when(
        F.col("n_regionkey") < 2, F.concat(F.lit('{"hardware":'), hardware, F.lit("}"))
    ).otherwise(hardware)
    pages = rows.select(text("s_suppkey").alias("key"), value.alias("value"))
    return landed.explode_details(pages, domains.HARDWARE_TYPE)


@query(
    "clean_resources",
    f"""SELECT s_suppkey::varchar AS entity_id,
          CASE WHEN s_acctbal < 2000 THEN s_name || ' (coming soon)' ELSE s_name END AS name,
          s_name AS record_name, 'In ' || n_name AS description, 'Container Support|' || n_name AS features,
          s_acctbal > 5000 AS has_gpu, s_acctbal > 3000 AS has_hardware FROM ({SUPPLIER_SQL})""",
)
def clean_resources(spark, sf):
    rows = cleaned(resource_items(spark, sf), "compute-resources", hardware_details(spark, sf))
    entity = F.col("entity")
    return rows.select(
        "entity_id",
        entity["name"].alias("name"),
        F.col("record.name").alias("record_name"),
        entity["description"].alias("description"),
        F.array_join("record.features", "|").alias("features"),
        F.col("record.has_gpu").alias("has_gpu"),
        entity["hardware"].isNotNull().alias("has_hardware"),
    )


@query(
    "clean_hardware",
    f"""SELECT s_suppkey::varchar AS entity_id, 'A100-' || n_name || ':t:{LONG}' || n_name AS gpus,
          'node:t:{LONG}' || n_name AS nodes, false AS has_storage FROM ({SUPPLIER_SQL}) WHERE s_acctbal > 3000""",
)
def clean_hardware(spark, sf):
    rows = hardware_details(spark, sf).withColumn("h", domains.clean_hardware(F.col("detail")))

    def flat(c):
        return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["name"], x["type"], x["details"])), "|")

    return rows.select(
        "entity_id",
        flat(F.col("h.gpus")).alias("gpus"),
        flat(F.col("h.compute_nodes")).alias("nodes"),
        F.col("h.storage").isNotNull().alias("has_storage"),
    )


@query(
    "gpu_types",
    f"""SELECT s_suppkey::varchar AS entity_id, CASE WHEN s_acctbal > 3000 THEN
          'A100-' || n_name || '|A100 40GB|A100|V100' ELSE '' END AS gpu_types FROM ({SUPPLIER_SQL})""",
)
def gpu_types(spark, sf):
    rows = cleaned(resource_items(spark, sf), "compute-resources", hardware_details(spark, sf))
    return rows.select("entity_id", F.array_join("record.gpu_types", "|").alias("gpu_types"))


@query(
    "detail_lookup",
    """SELECT p_partkey, n AS lines, amount FROM part LEFT JOIN (
         SELECT l_partkey, count(*) AS n, sum(l_quantity) AS amount FROM lineitem
         WHERE l_returnflag = 'R' AND l_quantity > 40 GROUP BY l_partkey) ON l_partkey = p_partkey""",
)
def detail_lookup(spark, sf):
    from corpusloom.operators.skew import lookup_join

    lines = table(spark, sf, "lineitem").where("l_returnflag = 'R' AND l_quantity > 40")
    details = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("amount")
    )
    entities = table(spark, sf, "part").select("p_partkey")
    return lookup_join(entities, details, ["p_partkey"], ["p_partkey"])


# ---- groups: parts, with events of their details --------------------------------------------------------------

GROUP_SQL = """SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part"""


def group_items(spark, sf):
    p = table(spark, sf, "part")
    value = F.to_json(
        F.struct(
            F.col("p_partkey").alias("id"),
            F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("name"),
            F.concat(F.lit("<p>"), F.col("p_name"), F.lit("</p>\n<p>"), F.col("p_brand"), F.lit("</p>")).alias("description"),
            F.col("p_brand").alias("category"),
            F.when(F.col("p_type") == "SMALL", "http://chat").otherwise("").alias("slack_link"),
        )
    )
    return p.select(
        F.col("p_partkey").alias("ordinal"), F.from_json(value, domains.GROUP_TYPE).alias("i")
    ).select("ordinal", "i.*")


def group_details(spark, sf):
    """Seven events, the third untitled; the total says whether there are any. No details for LARGE."""
    p = table(spark, sf, "part").where("p_type <> 'LARGE'")
    events = F.transform(
        F.sequence(F.lit(1), F.lit(7)),
        lambda i: F.struct(
            F.when(i == 3, "").otherwise(F.concat(F.lit("Event "), i.cast("string"), F.lit(" of "), F.col("p_name"))).alias("title"),
            F.when(i < 3, "2024-05-01").alias("date"),
        ),
    )
    value = F.to_json(
        F.struct(
            F.struct(
                F.when(F.col("p_size") > 10, 7).otherwise(0).alias("total"), events.alias("items")
            ).alias("events"),
            F.struct(
                F.col("p_size").alias("total"), F.array(F.struct(F.col("p_brand").alias("title"))).alias("items")
            ).alias("knowledge_base"),
        )
    )
    pages = p.select(text("p_partkey").alias("key"), value.alias("value"))
    return landed.explode_details(pages, domains.GROUP_DETAIL)


@query(
    "clean_groups",
    f"""SELECT p_partkey::varchar AS entity_id, p_name AS name, p_name || ' ' || p_brand AS description,
          CASE WHEN p_type = 'SMALL' THEN 'http://chat' END AS slack_link,
          CASE WHEN p_type <> 'LARGE' AND p_size > 10 THEN 'Event 1 of ' || p_name || '@2024-05-01|Event 2 of ' || p_name ||
            '@2024-05-01|Event 4 of ' || p_name || '@|Event 5 of ' || p_name || '@' END AS events,
          CASE WHEN p_type <> 'LARGE' AND p_size > 0 THEN p_brand END AS topics,
          p_type <> 'LARGE' AND p_size > 10 AS has_events, p_type <> 'LARGE' AND p_size > 0 AS has_topics
        FROM ({GROUP_SQL}) WHERE p_type <> 'PROMO'""",
)
def clean_groups(spark, sf):
    rows = cleaned(group_items(spark, sf), "affinity-groups", group_details(spark, sf))
    entity = F.col("entity")
    events = F.transform(entity["upcoming_events"], lambda e: F.concat(e["title"], F.lit("@"), e["date"]))
    return rows.select(
        "entity_id",
        entity["name"].alias("name"),
        entity["description"].alias("description"),
        entity["slack_link"].alias("slack_link"),
        F.array_join(events, "|").alias("events"),
        F.array_join(entity["knowledge_base_topics"], "|").alias("topics"),
        F.col("record.has_events").alias("has_events"),
        F.col("record.has_knowledge_base").alias("has_topics"),
    )


# ---- software: documents ------------------------------------------------------------------------------------------

SOFTWARE_NAME = "lower(regexp_extract(text, '[\\p{L}]+'))"


def software_items(spark, sf):
    """Documents as software: the first word is the name (so names repeat), the text the description."""
    d = table(spark, sf, "documents")
    first = F.regexp_extract("text", r"[\p{L}]+", 0)
    name = F.when(F.col("lang") == "en", F.lower(first)).otherwise(first)
    listed = F.when(
        F.col("lang") == "de",
        F.concat(F.lit('"'), F.col("source"), F.lit('"')),
    ).otherwise(
        F.concat(
            F.lit('[{"resource_id":"id-'), F.col("source"), F.lit('","name":"n"},{"name":"name-'), F.col("source"),
            F.lit('"},"plain",7,""]'),
        )
    )
    versions = F.when(F.col("lang") == "fr", F.lit("[]")).otherwise(F.lit('["1.0","2.0"]'))
    ai = F.to_json(
        F.struct(
            F.array(F.col("lang")).alias("tags"),
            F.lit("").alias("research_area"),
            F.col("source").alias("software_type"),
            F.col("text").alias("example_use"),
        )
    )
    head = F.to_json(F.struct(name.alias("name"), F.col("text").alias("description")))
    value = F.concat(
        F.expr("substring(_h, 1, length(_h) - 1)"), F.lit(',"versions":'), F.col("_v"),
        F.lit(',"available_on_resources":'), F.col("_l"), F.lit(',"ai_metadata":'), F.col("_a"), F.lit("}"),
    )
    rows = d.select(
        F.col("doc_id").alias("ordinal"), head.alias("_h"), versions.alias("_v"), listed.alias("_l"), ai.alias("_a")
    )
    spec = domains.REGISTRY["software-discovery"]
    return rows.select("ordinal", F.from_json(value, spec.item_type).alias("i")).select("ordinal", "i.*")


@query(
    "clean_software",
    f"""WITH d AS (SELECT *, {SOFTWARE_NAME} AS id FROM documents),
        f AS (SELECT * FROM d WHERE id <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY doc_id) = 1)
        SELECT id AS entity_id, doc_id AS ordinal, text AS description,
          CASE WHEN lang <> 'en' THEN regexp_extract(text, '[\\p{{L}}]+') ELSE
            regexp_extract(text, '(?i)(?:^|[^\\p{{L}}\\p{{M}}\\p{{N}}_])(' || id || ')(?:$|[^\\p{{L}}\\p{{M}}\\p{{N}}_])', 1) END AS name,
          lang <> 'fr' AS has_versions, lang AS tags, source AS software_type, false AS has_area,
          CASE WHEN length(text) > 1500 THEN substr(text, 1, 1500) || '...' ELSE text END AS example_use
        FROM f""",
)
def clean_software(spark, sf):
    rows = cleaned(software_items(spark, sf), "software-discovery")
    entity = F.col("entity")
    return rows.select(
        "entity_id",
        "ordinal",
        entity["description"].alias("description"),
        entity["name"].alias("name"),
        entity["versions"].isNotNull().alias("has_versions"),
        F.array_join(entity["tags"], "|").alias("tags"),
        entity["software_type"].alias("software_type"),
        entity["research_area"].isNotNull().alias("has_area"),
        entity["example_use"].alias("example_use"),
    )


@query(
    "software_resources",
    """SELECT doc_id AS ordinal, CASE WHEN lang = 'de' THEN '' ELSE 'id-' || source || '|name-' || source || '|plain|7' END AS resources
       FROM documents""",
)
def software_resources(spark, sf):
    listed = domains.software_resources(F.col("available_on_resources"))
    return software_items(spark, sf).select("ordinal", F.array_join(listed, "|").alias("resources"))


# ---- coverage of landed catalogs -------------------------------------------------------------------------------


@query(
    "coverage_pages",
    f"""SELECT 'allocations' AS source, 'list-all' AS strategy, count(*) * 9 AS fetched, count(*) * 9 AS unique_entities,
          (SELECT string_agg(k, ', ' ORDER BY k::bigint) FROM (SELECT o_orderkey::varchar AS k FROM ({ORDER_ITEM_SQL})
            WHERE o_orderkey < {PAGE} AND o_orderstatus <> 'P' ORDER BY o_orderkey LIMIT 5)) AS sample_ids
        FROM ({ORDER_ITEM_SQL}) WHERE o_orderkey < {PAGE}
        UNION ALL
        SELECT 'nsf-awards', 'list-all', count(*), count(*),
          (SELECT string_agg(k, ', ' ORDER BY n) FROM (SELECT {AWARD_NUMBER} AS k, c_custkey AS n FROM customer ORDER BY n LIMIT 5))
        FROM customer""",
)
def coverage_pages(spark, sf):
    """Projects are estimated from the first page (9 pages announced); awards are counted."""
    from corpusloom.plans.inspect import coverage

    return coverage({"allocations": project_pages(spark, sf), "nsf-awards": award_pages(spark, sf)})


@query(
    "coverage_exact",
    f"""WITH ids AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey::varchar ELSE 'REQ' || o_orderkey END AS id FROM ({ORDER_ITEM_SQL}))
        SELECT 'allocations' AS source, 'list-all' AS strategy, count(*) AS fetched, count(DISTINCT id) AS unique_entities,
          (SELECT string_agg(id, ', ' ORDER BY id) FROM (SELECT DISTINCT id FROM ids ORDER BY id LIMIT 5)) AS sample_ids
        FROM ids""",
)
def coverage_exact(spark, sf):
    """Projects counted on all landed pages."""
    from corpusloom.plans.inspect import coverage

    return coverage({"allocations": project_pages(spark, sf)}, exact=True)
