"""The five catalogs: item types, cleaning, comparison records; new catalogs register here."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import structured as js
from ..functions import text as tx
from ..settings import ExtractionConfig
from . import select
from .skew import lookup_join

EMPTY = ""


def text_or_empty(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(EMPTY))


@dataclass(frozen=True)
class DomainSpec:
    """One catalog. The callables take frames that carry the item's columns (and ``detail``)."""

    name: str
    collection: str
    item_type: str
    list_keys: tuple[str, ...]
    entity_id: Callable[[], Column]
    entity_name: Callable[[], Column]
    clean: Callable[[DataFrame, ExtractionConfig], Column]
    record: Callable[[DataFrame], list[Column]]
    source_data: Callable[[], Column]
    display: str
    entity_type: str
    keywords: list[str] = field(default_factory=lambda: ["how to", "steps", "process", "compare"])
    keep_first: bool = False
    name_required: bool = True
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df
    detail_type: str | None = None
    pre_filter: Callable[[], Column] | None = None
    display_name: Callable[[], Column] = lambda: F.col("entity_name")

    def source_ref(self, entity_id: Column) -> Column:
        return F.concat(F.lit(f"mcp://{self.name}/{self.collection}/"), entity_id)


REGISTRY: dict[str, DomainSpec] = {}


def register(spec: DomainSpec) -> DomainSpec:
    REGISTRY[spec.name] = spec
    return spec


# ---- shared steps ---------------------------------------------------------------------------------


def pick(spec: DomainSpec, items: DataFrame, config: ExtractionConfig) -> DataFrame:
    """Items to the entities of this run: required fields, keep-first, allow-list, then the cap."""
    if spec.pre_filter is not None:
        items = items.where(spec.pre_filter())
    rows = spec.prepare(items)
    rows = rows.withColumn("entity_id", text_or_empty(spec.entity_id())).withColumn(
        "entity_name", text_or_empty(spec.entity_name())
    )
    required = ("entity_id", "entity_name") if spec.name_required else ("entity_id",)
    rows = select.required_fields(rows, *required)
    if spec.keep_first:
        rows = select.keep_first(rows, "entity_id")
    rows = select.allow_list(rows, config.entity_ids)
    return select.first_n(rows, config.max_entities)


def attach_details(entities: DataFrame, details: DataFrame | None, spec: DomainSpec) -> DataFrame:
    """Left join of the landed detail per entity; no detail gives NULL."""
    if spec.detail_type is None:
        return entities
    if details is None:
        return entities.withColumn("detail", F.lit(None).cast(spec.detail_type))
    details = details.select("entity_id", "detail")
    if spec.keep_first:
        return entities.join(details, "entity_id", "left")
    return lookup_join(entities, details, ["entity_id"], ["ordinal"])


def cleaned(spec: DomainSpec, entities: DataFrame, config: ExtractionConfig) -> DataFrame:
    """``domain, entity_id, entity_name, ordinal, entity, source_data`` plus the record columns."""
    rows = entities.withColumn("entity", spec.clean(entities, config))
    return rows.select(
        F.lit(spec.name).alias("domain"),
        "entity_id",
        spec.display_name().alias("entity_name"),
        "ordinal",
        "entity",
        F.to_json(spec.source_data()).alias("source_data"),
        F.struct(*spec.record(rows)).alias("record"),
    )


def records(clean_rows: DataFrame) -> DataFrame:
    """Comparison records: one row per id with the last write's values at the first arrival place."""
    return select.last_write(clean_rows.select("entity_id", "ordinal", "record.*"))


# ---- compute-resources ------------------------------------------------------------------------------

HARDWARE_ITEMS = "array<struct<name:string,type:string,details:string>>"
# ---- fixed values ----
HARDWARE = ["gpus", "compute_nodes", "storage", "memory"]
DETAIL_MINIMUM = 50
UNKNOWN_FEATURE = "Unknown"
USE_WIDTH = 1500
# ----------------------
HARDWARE_FIELDS = ",".join(f"{c}:{HARDWARE_ITEMS}" for c in HARDWARE)
HARDWARE_TYPE = f"struct<hardware:struct<{HARDWARE_FIELDS}>,{HARDWARE_FIELDS}>"


def clean_hardware(detail: Column) -> Column:
    """Per category the items with more than 50 characters of stripped details; NULL when none."""

    def category(name: str) -> Column:
        listed = F.when(detail["hardware"].isNotNull(), detail["hardware"][name]).otherwise(detail[name])
        items = F.transform(
            listed,
            lambda x: F.struct(
                text_or_empty(x["name"]).alias("name"),
                text_or_empty(x["type"]).alias("type"),
                tx.strip_html(text_or_empty(x["details"])).alias("details"),
            ),
        )
        return js.filled_array(F.filter(items, lambda x: F.length(x["details"]) > DETAIL_MINIMUM))

    columns = {name: category(name) for name in HARDWARE}
    any_left = F.lit(False)
    for c in columns.values():
        any_left = any_left | c.isNotNull()
    return F.when(any_left, F.struct(*[c.alias(n) for n, c in columns.items()]))


def clean_features(features: Column) -> Column:
    return F.filter(features, lambda f: ~f.startswith(UNKNOWN_FEATURE))


def gpu_types(hardware: Column) -> Column:
    """Names of the GPU items as they are, then models found in node details that are not yet there."""
    none = F.array().cast("array<string>")
    named = F.coalesce(
        F.filter(F.transform(hardware["gpus"], lambda g: g["name"]), lambda n: n != ""), none
    )

    def mentions(node: Column) -> Column:
        found = [
            F.regexp_extract_all(node["details"], F.lit(p), F.lit(1)) for p in tx.NODE_GPU_PATTERNS
        ]
        models = F.transform(F.concat(*found), lambda m: F.upper(tx.strip(m)))
        return F.filter(models, lambda m: m != "")

    seen = F.coalesce(F.flatten(F.transform(hardware["compute_nodes"], mentions)), none)
    fresh = F.filter(F.array_distinct(seen), lambda m: ~F.array_contains(named, m))
    return F.concat(named, fresh)


RESOURCE_TYPE = (
    "struct<id:string,name:string,description:string,organization_names:array<string>,"
    "feature_names:array<string>,hasGpu:boolean,resourceType:string,accessAllocated:variant>"
)


def _clean_resource() -> list[Column]:
    return [
        F.col("name"),
        tx.strip_html(F.col("description")).alias("description"),
        F.col("organization_names"),
        clean_features(F.col("feature_names")).alias("feature_names"),
        F.col("hasGpu"),
        F.col("resourceType"),
        F.col("accessAllocated"),
    ]


def _resource_entity(df: DataFrame, config: ExtractionConfig) -> Column:
    return F.struct(*_clean_resource(), clean_hardware(F.col("detail")).alias("hardware"))


def _resource_source() -> Column:
    entity = F.col("entity")
    return F.struct(entity.dropFields("hardware").alias("resource"), entity["hardware"].alias("hardware"))


def _resource_record(df: DataFrame) -> list[Column]:
    none = F.array().cast("array<string>")
    entity = F.col("entity")
    return [
        tx.clean_name(F.col("entity_name")).alias("name"),
        F.col("entity_id").alias("resource_id"),
        F.coalesce("organization_names", none).alias("organizations"),
        F.coalesce("hasGpu", F.lit(False)).alias("has_gpu"),
        gpu_types(entity["hardware"]).alias("gpu_types"),
        F.coalesce(entity["feature_names"], none).alias("features"),
        text_or_empty("resourceType").alias("resource_type"),
    ]


RESOURCES = register(
    DomainSpec(
        name="compute-resources",
        collection="resources",
        item_type=RESOURCE_TYPE,
        list_keys=("resources", "items"),
        entity_id=lambda: F.col("id"),
        entity_name=lambda: F.col("name"),
        prepare=lambda df: df.withColumn("name", tx.soften_label(F.col("name"))),
        clean=_resource_entity,
        record=_resource_record,
        source_data=_resource_source,
        keywords=["specifications", "how many", "performance", "compared"],
        detail_type=HARDWARE_TYPE,
        display="compute resources",
        entity_type="HPC system",
    )
)

# ---- software-discovery --------------------------------------------------------------------------------

SOFTWARE_TYPE = (
    "struct<name:string,description:string,versions:variant,documentation:variant,website:variant,"
    "available_on_resources:variant,ai_metadata:struct<tags:array<string>,research_area:string,"
    "research_field:string,software_type:string,core_features:variant,example_use:string>>"
)


def software_resources(listed: Column) -> Column:
    """Resource names from a VARIANT: objects give resource_id, else name; other values their text.
    An object whose resource_id is there but null names nothing. A value that is no list gives an
    empty one."""
    elements = F.when(
        F.schema_of_variant(listed).startswith("ARRAY"), listed.try_cast("array<variant>")
    )

    def one(e: Column) -> Column:
        is_object = F.schema_of_variant(e).startswith("OBJECT")
        has_id = F.coalesce(F.map_contains_key(e.try_cast("map<string,variant>"), "resource_id"), F.lit(False))
        named = F.when(has_id, F.try_variant_get(e, "$.resource_id", "string")).otherwise(
            F.try_variant_get(e, "$.name", "string")
        )
        return F.when(is_object, named).otherwise(F.try_variant_get(e, "$", "string"))

    names = F.transform(elements, one)
    return F.coalesce(
        F.filter(names, lambda n: F.coalesce(n, F.lit(EMPTY)) != ""), F.array().cast("array<string>")
    )


def _software_entity(df: DataFrame, config: ExtractionConfig) -> Column:
    ai = F.col("ai_metadata")
    return F.struct(
        tx.display_name(F.col("name"), F.col("description")).alias("name"),
        js.filled(F.col("description")).alias("description"),
        js.filled_variant(F.col("versions")).alias("versions"),
        js.filled_variant(F.col("available_on_resources")).alias("available_on_resources"),
        js.filled_variant(F.col("documentation")).alias("documentation"),
        js.filled_variant(F.col("website")).alias("website"),
        js.filled_array(ai["tags"]).alias("tags"),
        js.filled(ai["research_area"]).alias("research_area"),
        js.filled(ai["research_field"]).alias("research_field"),
        js.filled(ai["software_type"]).alias("software_type"),
        js.filled_variant(ai["core_features"]).alias("core_features"),
        tx.truncate(js.filled(ai["example_use"]), USE_WIDTH).alias("example_use"),
    )


def _software_record(df: DataFrame) -> list[Column]:
    entity = F.col("entity")
    return [
        F.col("name"),
        F.col("entity_id").alias("software_id"),
        software_resources(F.col("available_on_resources")).alias("resources"),
        F.coalesce(entity["tags"], F.array().cast("array<string>")).alias("tags"),
        entity["research_area"].alias("research_area"),
        entity["software_type"].alias("software_type"),
    ]


SOFTWARE = register(
    DomainSpec(
        name="software-discovery",
        collection="software",
        item_type=SOFTWARE_TYPE,
        list_keys=("items", "software"),
        entity_id=lambda: F.lower("name"),
        entity_name=lambda: F.col("name"),
        keep_first=True,
        clean=_software_entity,
        record=_software_record,
        source_data=lambda: F.col("entity"),
        display_name=lambda: F.col("entity.name"),
        keywords=["how do i", "how to", "example", "versions"],
        display="software catalog",
        entity_type="software package",
    )
)

# ---- allocations --------------------------------------------------------------------------------------------

PROJECT_TYPE = (
    "struct<projectId:string,requestNumber:string,requestTitle:string,pi:string,piInstitution:string,"
    "fos:string,abstract:string,allocationType:string,beginDate:string,endDate:string,"
    "resources:array<struct<resourceName:string,units:string,allocation:variant,resourceId:string>>>"
)


def _named_resources() -> Column:
    return F.filter("resources", lambda r: text_or_empty(r["resourceName"]) != "")


def _project_entity(df: DataFrame, config: ExtractionConfig) -> Column:
    listed = F.transform(
        _named_resources(),
        lambda r: F.struct(
            r["resourceName"].alias("name"),
            text_or_empty(r["units"]).alias("units"),
            F.coalesce(r["allocation"], F.parse_json(F.lit('""'))).alias("allocation"),
        ),
    )
    return F.struct(
        text_or_empty("requestTitle").alias("title"),
        text_or_empty("pi").alias("pi"),
        text_or_empty("piInstitution").alias("institution"),
        text_or_empty("fos").alias("field_of_science"),
        text_or_empty("allocationType").alias("allocation_type"),
        tx.strip_html(js.filled(F.col("abstract"))).alias("abstract"),
        js.filled(F.col("beginDate")).alias("beginDate"),
        js.filled(F.col("endDate")).alias("endDate"),
        F.when(F.size("resources") > 0, listed).alias("resources"),
    )


def _project_record(df: DataFrame) -> list[Column]:
    names = F.transform(_named_resources(), lambda r: r["resourceName"])
    return [
        F.col("entity_name").alias("name"),
        F.col("entity_id").alias("project_id"),
        text_or_empty("pi").alias("pi"),
        text_or_empty("piInstitution").alias("institution"),
        text_or_empty("fos").alias("fos"),
        text_or_empty("allocationType").alias("allocation_type"),
        F.greatest(F.coalesce(F.size("resources"), F.lit(0)), F.lit(0)).alias("resource_count"),
        F.coalesce(names, F.array().cast("array<string>")).alias("resource_names"),
    ]


PROJECTS = register(
    DomainSpec(
        name="allocations",
        collection="projects",
        item_type=PROJECT_TYPE,
        list_keys=("projects",),
        entity_id=lambda: F.coalesce(js.filled(F.col("projectId")), F.col("requestNumber")),
        entity_name=lambda: F.col("requestTitle"),
        clean=_project_entity,
        record=_project_record,
        source_data=lambda: F.struct(F.col("entity").alias("project")),
        display="allocation projects",
        entity_type="allocation project",
    )
)

# ---- nsf-awards -------------------------------------------------------------------------------------------------

AWARD_TYPE = (
    "struct<id:string,title:string,piFirstName:string,piLastName:string,coPDPI:string,"
    "awardeeName:string,estimatedTotalAmt:string,fundsObligatedAmt:string,startDate:string,"
    "expDate:string,abstractText:string,primaryProgram:string,fundProgramName:string,"
    "poName:string,ueiNumber:string>"
)


def text_list(c: Column) -> Column:
    """The elements of a field that is a list (raw JSON text), else NULL."""
    return F.when(c.startswith("["), F.from_json(c, "array<string>"))


def listed_or_split(c: Column) -> Column:
    """List or ``;``-separated text to trimmed non-empty names."""
    names = F.coalesce(text_list(c), F.split(text_or_empty(c), ";"))
    return F.filter(F.transform(names, tx.strip), lambda n: n != "")


def listed_or_text(c: Column) -> Column:
    return F.coalesce(F.array_join(text_list(c), "; "), c, F.lit(EMPTY))


def normalize_awards(items: DataFrame) -> DataFrame:
    """Raw award fields to the 14 normalized ones."""
    first, last = tx.strip(text_or_empty("piFirstName")), tx.strip(text_or_empty("piLastName"))
    keep = [F.col("ordinal")] if "ordinal" in items.columns else []
    return items.select(
        *keep,
        text_or_empty("id").alias("awardNumber"),
        text_or_empty("title").alias("title"),
        text_or_empty("awardeeName").alias("institution"),
        tx.strip(F.concat(first, F.lit(" "), last)).alias("principalInvestigator"),
        listed_or_split(F.col("coPDPI")).alias("coPIs"),
        tx.format_currency(F.col("estimatedTotalAmt")).alias("totalIntendedAward"),
        tx.format_currency(F.col("fundsObligatedAmt")).alias("totalAwardedToDate"),
        text_or_empty("startDate").alias("startDate"),
        text_or_empty("expDate").alias("endDate"),
        text_or_empty("abstractText").alias("abstract"),
        listed_or_text(F.col("fundProgramName")).alias("fundProgramName"),
        listed_or_text(F.col("primaryProgram")).alias("primaryProgramCode"),
        text_or_empty("poName").alias("programOfficer"),
        text_or_empty("ueiNumber").alias("ueiNumber"),
    )


def _award_entity(df: DataFrame, config: ExtractionConfig) -> Column:
    return F.struct(
        F.col("title"),
        F.col("principalInvestigator").alias("principal_investigator"),
        F.col("institution"),
        F.col("totalIntendedAward").alias("total_intended_award"),
        F.col("fundProgramName").alias("fund_program_name"),
        F.col("primaryProgramCode").alias("primary_program_budget_code"),
        tx.strip_html(js.filled(F.col("abstract"))).alias("abstract"),
        js.filled(F.col("startDate")).alias("startDate"),
        js.filled(F.col("endDate")).alias("endDate"),
        js.filled(F.col("totalAwardedToDate")).alias("totalAwardedToDate"),
        js.filled(F.col("programOfficer")).alias("programOfficer"),
        js.filled_array(F.col("coPIs")).alias("co_pis"),
    )


def _award_record(df: DataFrame) -> list[Column]:
    return [
        F.col("entity_name").alias("name"),
        F.col("entity_id").alias("award_number"),
        F.col("principalInvestigator").alias("pi"),
        F.col("institution"),
        F.col("totalIntendedAward").alias("total_award"),
        F.col("fundProgramName").alias("fund_program_name"),
        (F.size("coPIs") > 0).alias("has_co_pis"),
    ]


AWARDS = register(
    DomainSpec(
        name="nsf-awards",
        collection="awards",
        item_type=AWARD_TYPE,
        list_keys=("response.award",),
        entity_id=lambda: F.col("awardNumber"),
        entity_name=lambda: F.col("title"),
        prepare=normalize_awards,
        keep_first=True,
        clean=_award_entity,
        record=_award_record,
        source_data=lambda: F.struct(F.col("entity").alias("award")),
        display="NSF awards",
        entity_type="NSF award",
    )
)

# ---- affinity-groups ------------------------------------------------------------------------------------------------

GROUP_TYPE = (
    "struct<id:string,name:string,description:string,coordinator:string,category:string,"
    "slack_link:string,support_url:string,ask_ci_forum:string>"
)
GROUP_DETAIL = (
    "struct<events:struct<total:bigint,items:array<struct<title:string,date:string>>>,"
    "knowledge_base:struct<total:bigint,items:array<struct<title:string>>>>"
)


def _titled(section: Column, n: int) -> Column:
    """The first ``n`` items, of which the untitled then drop; NULL when the section is empty."""
    first = F.filter(F.slice(section["items"], 1, n), lambda e: text_or_empty(e["title"]) != "")
    return F.when(F.coalesce(section["total"], F.lit(0)) > 0, first)


def _group_entity(df: DataFrame, config: ExtractionConfig) -> Column:
    n = config.max_detail_items
    none = F.array()
    events = F.transform(
        _titled(F.col("detail.events"), n),
        lambda e: F.struct(e["title"].alias("title"), text_or_empty(e["date"]).alias("date")),
    )
    topics = F.transform(_titled(F.col("detail.knowledge_base"), n), lambda e: e["title"])
    has_events = F.coalesce(F.col("detail.events.total"), F.lit(0)) > 0
    has_topics = F.coalesce(F.col("detail.knowledge_base.total"), F.lit(0)) > 0
    return F.struct(
        text_or_empty("name").alias("name"),
        tx.strip_html(text_or_empty("description")).alias("description"),
        text_or_empty("coordinator").alias("coordinator"),
        text_or_empty("category").alias("category"),
        js.filled(F.col("slack_link")).alias("slack_link"),
        js.filled(F.col("support_url")).alias("support_url"),
        js.filled(F.col("ask_ci_forum")).alias("ask_ci_forum"),
        F.when(has_events, F.coalesce(events, none.cast("array<struct<title:string,date:string>>"))).alias(
            "upcoming_events"
        ),
        F.when(has_topics, F.coalesce(topics, none.cast("array<string>"))).alias("knowledge_base_topics"),
    )


def _group_record(df: DataFrame) -> list[Column]:
    return [
        F.col("entity_name").alias("name"),
        F.col("entity_id").alias("group_id"),
        text_or_empty("category").alias("category"),
        text_or_empty("coordinator").alias("coordinator"),
        (F.coalesce(F.col("detail.events.total"), F.lit(0)) != 0).alias("has_events"),
        (F.coalesce(F.col("detail.knowledge_base.total"), F.lit(0)) != 0).alias("has_knowledge_base"),
    ]


GROUPS = register(
    DomainSpec(
        name="affinity-groups",
        collection="groups",
        item_type=GROUP_TYPE,
        list_keys=("items", "groups"),
        entity_id=lambda: F.col("id"),
        entity_name=lambda: F.col("name"),
        keep_first=True,
        clean=_group_entity,
        record=_group_record,
        source_data=lambda: F.struct(F.col("entity").alias("group")),
        detail_type=GROUP_DETAIL,
        display="affinity groups",
        entity_type="community group",
    )
)
