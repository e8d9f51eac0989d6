"""Cross-entity comparison pairs: group entities on a shared value, write question and answer.

Inputs are long: one row per (group value, entity) with columns ``group, label, name, ordinal,
sub, entity_id``. ``ordinal`` is the arrival position of the entity and ``sub`` the position of
the value inside the entity; together they give arrival order within a group. ``label`` is the
text shown for the group and depends on the group alone, so both can be grouped on (a text as an
aggregate would force a sort before the partial aggregate).

Two shapes of answer exist, one pair per group at every size. *Listings* name every member; the text
of a large group is put together from chunks of ranked members, so that only the finished answer is in
one row. *Samples* give the count and the first five names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as tx
from ..settings import written
from .skew import lookup_join, positions

# ---- fixed values: thresholds, word lists, text formats --------------------------------------
SMALL_MINIMUM = 2
LARGE_MINIMUM = 3
SAMPLE = 5
FEATURES = [
    "GPU Acceleration",
    "GPU Computing",
    "Container Support",
    "Virtual Machine Support",
    "Cloud Computing Platform",
    "Interactive Computing",
    "AI/ML Optimized",
]
ML_SOFTWARE = ["pytorch", "tensorflow", "jax", "cuda", "cupy", "rapids"]
COMPARISON_TYPE = "availability"
COMPARISON_REF = "mcp://comparison/"
# -----------------------------------------------------------------------------------------------

MEMBER = ["group", "label", "name", "ordinal", "sub", "entity_id"]
# Members that one task puts into text at a time. Groups above it are ranked and rendered in chunks; the
# pairs are the same either way.
CHUNK = 10_000
# a group's answer and its list must fit a cell; beyond, the member rows (``member_rows``) have everything
LONGEST_ANSWER = 2_000_000_000


@dataclass(frozen=True)
class Template:
    """Texts of one comparison. ``{label}``, ``{group}`` and ``{count}`` stand for row values."""

    id_prefix: str
    domain: str
    question: str
    lead: str
    minimum: int = SMALL_MINIMUM
    tail: str = "."
    cite: str | None = None
    software: bool = False
    lower_label: bool = False
    arrival: bool = True

    @property
    def cited_domain(self) -> str:
        return self.cite or self.domain


def fill(template: str, label: Column, count: Column) -> Column:
    """Template text to a column; only the marks listed above are replaced."""
    parts, rest = [], template
    marks = {"{label}": label, "{group}": label, "{count}": count.cast("string")}
    while rest:
        at, mark = min(((rest.find(m), m) for m in marks if m in rest), default=(-1, ""))
        if at < 0:
            parts.append(F.lit(rest))
            break
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(marks[mark])
        rest = rest[at + len(mark) :]
    return F.concat(*parts) if parts else F.lit("")


def _marker(template: Template, entity_id: Column) -> Column:
    return F.concat(F.lit("\n\n"), tx.citation(F.lit(template.cited_domain), entity_id))


def _software_marker(template: Template) -> Column:
    if not template.software:
        return F.lit("")
    return F.concat(F.lit("\n\n"), tx.citation(F.lit("software-discovery"), F.col("group")))


def _finish(rows: DataFrame, template: Template) -> DataFrame:
    """Common columns of a comparison pair; expects group, label, members, answer, resources."""
    asked = F.lower("label") if template.lower_label else F.col("label")
    pair_id = F.concat(F.lit(f"{template.id_prefix}_"), tx.slugify(F.col("group")))
    software = F.col("group") if template.software else F.lit(None).cast("string")
    return rows.select(
        pair_id.alias("id"),
        F.col("group"),
        "members",
        fill(template.question, asked, F.col("members")).alias("question"),
        "answer",
        F.concat(F.lit(COMPARISON_REF), pair_id).alias("source_ref"),
        F.lit(template.domain).alias("domain"),
        F.lit("moderate").alias("complexity"),
        F.lit("comparison").alias("granularity"),
        F.lit(True).alias("has_citation"),
        "resources",
        software.alias("software"),
    )


def _whole_listing(members: DataFrame, template: Template) -> DataFrame:
    """Groups of at most CHUNK members: one bounded list per group."""
    grouped = (
        members.groupBy("group", "label")
        .agg(
            F.count(F.lit(1)).alias("members"),
            F.sort_array(F.collect_list(F.struct("name", "ordinal", "sub", "entity_id"))).alias("_m"),
        )
        .where(F.col("members") >= template.minimum)
    )
    by_arrival = F.sort_array(
        F.transform("_m", lambda m: F.struct(m["ordinal"], m["sub"], m["entity_id"].alias("entity_id")))
    )
    listed = by_arrival if template.arrival else F.col("_m")
    answer = F.concat(
        fill(template.lead, F.col("label"), F.col("members")),
        F.lit(" "),
        tx.name_list(F.transform("_m", lambda m: m["name"])),
        fill(template.tail, F.col("label"), F.col("members")),
        F.array_join(F.transform("_m", lambda m: _marker(template, m["entity_id"])), ""),
        _software_marker(template),
    )
    return grouped.select(
        "group",
        "label",
        "members",
        answer.alias("answer"),
        F.transform(listed, lambda m: m["entity_id"]).alias("resources"),
    )


def _glue(pos: Column, n: Column) -> Column:
    """What stands before the name at a position of the list."""
    return (
        F.when(pos == 1, F.lit(" "))
        .when((pos == n) & (n == 2), F.lit(" and "))
        .when(pos == n, F.lit(", and "))
        .otherwise(F.lit(", "))
    )


def member_rows(members: DataFrame, template: Template) -> DataFrame:
    """The members of every pair, one row each, without any limit on a group's size: pair id, place by
    name, place by arrival, name, entity and marker."""
    keys = ["group", "name", "ordinal", "sub", "entity_id"]
    by_name = positions(members.select(*MEMBER), ["group"], ["name", "ordinal", "sub", "entity_id"])
    by_name = by_name.where(F.col("members") >= template.minimum).withColumnRenamed("position", "by_name")
    by_arrival = positions(by_name.drop("members"), ["group"], ["ordinal", "sub", "entity_id", "by_name"])
    return by_arrival.select(
        F.concat(F.lit(f"{template.id_prefix}_"), tx.slugify(F.col("group"))).alias("id"),
        *keys[:1],
        "by_name",
        F.col("position").alias("by_arrival"),
        "name",
        "entity_id",
        _marker(template, F.col("entity_id")).alias("marker"),
    )


def _large_listing(members: DataFrame, template: Template, chunk: int) -> DataFrame:
    """Groups of any size: exact positions first, then one text per (group, chunk) and kind of text,
    and at last the few chunks of a group in order."""
    ranked = positions(members, ["group"], ["name", "ordinal", "sub", "entity_id"])
    ranked = written(ranked.where(F.col("members") >= template.minimum))
    pos, n = F.col("position"), F.col("members")
    at = F.floor((pos - 1) / chunk).alias("chunk")
    named = F.struct(pos, F.concat(_glue(pos, n), "name").alias("piece"), _marker(template, F.col("entity_id")).alias("marker"))
    texts = ranked.groupBy("group", "label", "members", at).agg(F.sort_array(F.collect_list(named)).alias("_p"))
    texts = texts.select(
        "group", "label", "members", "chunk",
        F.array_join("_p.piece", "").alias("names"), F.array_join("_p.marker", "").alias("markers"),
    )
    whole = texts.groupBy("group", "label", "members").agg(
        F.sum(F.octet_length("names").cast("bigint") + F.octet_length("markers")).alias("_bytes"),
        F.sort_array(F.collect_list(F.struct("chunk", "names", "markers"))).alias("_c"),
    )
    fits = F.when(
        F.col("_bytes") > LONGEST_ANSWER,
        F.raise_error(F.concat(F.lit("answer too long for one row, see member_rows: "), "group")).cast("string"),
    ).otherwise(F.lit(""))
    answer = F.concat(
        fits,
        fill(template.lead, F.col("label"), n),
        F.array_join("_c.names", ""),
        fill(template.tail, F.col("label"), n),
        F.array_join("_c.markers", ""),
        _software_marker(template),
    )
    whole = whole.select("group", "label", "members", answer.alias("answer"))
    if template.arrival:
        ranked = positions(ranked.select(*MEMBER), ["group"], ["ordinal", "sub", "entity_id", "name"])
    lists = ranked.groupBy("group", at).agg(F.sort_array(F.collect_list(F.struct(pos, "entity_id"))).alias("_r"))
    lists = lists.select("group", "chunk", F.col("_r.entity_id").alias("ids"))
    lists = lists.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("_l"))
    return whole.join(lists.select("group", F.flatten("_l.ids").alias("resources")), "group")


def listing(
    members: DataFrame,
    template: Template,
    chunk: int = CHUNK,
    keys: DataFrame | None = None,
) -> DataFrame:
    """One pair per group that names all members.

    Group sizes are counted first (combined before the shuffle), on ``keys`` when the caller has a
    cheaper frame with one ``group`` per member. The sizes only decide how a group's text is put
    together: the usual small groups need a single aggregate.
    """
    members = members.select(*MEMBER)
    sizes = (members if keys is None else keys).groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    large = written(sizes.where(F.col("_n") > chunk).select("group"))
    if large.isEmpty():
        rows = _whole_listing(members, template)
    else:
        rows = _whole_listing(members.join(large, "group", "left_anti"), template).unionByName(
            _large_listing(members.join(large, "group", "left_semi"), template, chunk)
        )
    return _finish(rows, template)


#: Rows that a task combines at a time.
COMBINE = 1 << 17
#: Rows of states that a task holds when it has whole groups.
HELD = 1 << 18


def _bounded(rows: pa.Table) -> pa.Table:
    """Of every group the rows that can be among its first SAMPLE by name or by arrival; the group's
    count stands on one of them."""
    if not rows.num_rows:
        return rows
    group = rows.column("group").combine_chunks().dictionary_encode().indices.to_numpy()
    keep = np.zeros(len(group), bool)
    plain = rows.append_column("_g", pa.array(group))
    for order in (["name", "ordinal", "sub", "entity_id"], ["ordinal", "sub", "entity_id"]):
        at = pc.sort_indices(plain, [(c, "ascending") for c in ["_g", *order]], null_placement="at_start").to_numpy()
        sorted_ = group[at]
        first = np.flatnonzero(np.diff(sorted_, prepend=-1))
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        keep[at[place < SAMPLE]] = True
    kept = np.flatnonzero(keep)
    total = np.zeros(int(group.max()) + 1, np.int64)
    np.add.at(total, group, rows.column("members").to_numpy())
    _, one = np.unique(group[kept], return_index=True)
    members = np.zeros(len(kept), np.int64)
    members[one] = total[group[kept][one]]
    out = rows.take(pa.array(kept))
    at = out.schema.get_field_index("members")
    return out.set_column(at, out.schema.field(at), pa.array(members))


def _combined(members: DataFrame, most: int = COMBINE // 2) -> DataFrame:
    """``members`` with a count column, each task's part reduced to a bounded state per group (see
    ``_bounded``); states merge by the same rule. States of more than ``most`` rows are passed on."""
    if "members" not in members.columns:
        members = members.withColumn("members", F.lit(1).cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, full = 0, COMBINE
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= full:
                state = _bounded(pa.Table.from_batches(held).combine_chunks())
                # many small groups: nothing to gain by holding them
                if state.num_rows > most:
                    yield from state.to_batches()
                    held, count = [], 0
                else:
                    held, count = state.to_batches(), state.num_rows
                full = max(COMBINE, 2 * count)
        if held:
            yield from _bounded(pa.Table.from_batches(held).combine_chunks()).to_batches()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in members.schema.fields)
    return members.mapInArrow(run, fields)


def sampled(members: DataFrame, template: Template) -> DataFrame:
    """One pair per group with the member count and the first five names.

    The input is read once: tasks reduce it to a count and at most ten rows per group. Where groups are so many
    that a task sees little of each, the rows of a group are brought together and reduced again, so that
    nothing but states is ever sorted.
    """
    state = _combined(_combined(members.select(*MEMBER)).repartition("group"), HELD)
    whole = W.partitionBy("group", "label")
    placed = state.select(
        *MEMBER,
        F.sum("members").over(whole).alias("members"),
        F.row_number().over(whole.orderBy("name", "ordinal", "sub", "entity_id")).alias("_by_name"),
        F.row_number().over(whole.orderBy("ordinal", "sub", "entity_id")).alias("_by_arrival"),
    ).where((F.col("_by_name") <= SAMPLE) | (F.col("_by_arrival") <= SAMPLE))

    def first(place: str) -> Column:
        row = F.struct(F.col(place).alias("_n"), "name", "entity_id")
        return F.sort_array(F.collect_list(F.when(F.col(place) <= SAMPLE, row)))

    joined = (
        placed.where(F.col("members") >= template.minimum)
        .groupBy("group", "label")
        .agg(F.max("members").alias("members"), first("_by_name").alias("_names"), first("_by_arrival").alias("_first"))
    )
    glue = F.when(F.col("members") > SAMPLE, F.lit(", including ")).otherwise(F.lit(": "))
    answer = F.concat(
        fill(template.lead, F.col("label"), F.col("members")),
        glue,
        tx.name_list(F.transform("_names", lambda m: m["name"])),
        F.lit(template.tail),
        F.array_join(F.transform("_names", lambda m: _marker(template, m["entity_id"])), ""),
    )
    rows = joined.select(
        "group",
        "label",
        "members",
        answer.alias("answer"),
        F.transform("_first", lambda m: m["entity_id"]).alias("resources"),
    )
    return _finish(rows, template)


# ---- members of the single comparisons ---------------------------------------------------------


def by_field(records: DataFrame, field: str) -> DataFrame:
    """Entities grouped on one of their own columns; empty values drop out."""
    return records.where(F.coalesce(F.col(field), F.lit("")) != "").select(
        F.col(field).alias("group"),
        F.col(field).alias("label"),
        F.coalesce("name", F.lit("")).alias("name"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
        F.lit(0).alias("sub"),
        F.col("entity_id").cast("string").alias("entity_id"),
    )


def by_element(records: DataFrame, field: str) -> DataFrame:
    """Entities grouped on every element of a list column; a value listed twice counts twice."""
    exploded = records.select("*", F.posexplode(field).alias("sub", "_value"))
    return exploded.where(F.coalesce("_value", F.lit("")) != "").select(
        F.col("_value").alias("group"),
        F.col("_value").alias("label"),
        F.coalesce("name", F.lit("")).alias("name"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
        "sub",
        F.col("entity_id").cast("string").alias("entity_id"),
    )


def gpu_members(resources: DataFrame) -> DataFrame:
    members = by_element(resources, "gpu_types")
    model = tx.normalize_gpu(F.col("group"))
    return members.withColumn("group", model).withColumn("label", F.col("group")).where("group <> ''")


def feature_members(resources: DataFrame) -> DataFrame:
    return by_element(resources, "features").where(F.col("group").isin(FEATURES))


def distinct_members(members: DataFrame) -> DataFrame:
    """Every entity once per group, at its first place. By default a repeat counts: one that lists two spellings
    of a value is two members. One row per entity leaves a task, so repeats do not reach the shuffle."""
    first = W.partitionBy("group", "entity_id").orderBy("ordinal", "sub")
    return members.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


# ---- short resource names ------------------------------------------------------------------------


def name_targets(resources: DataFrame) -> DataFrame:
    """Everything a short name can match: (kind, key) -> resource, one row per key.

    Keys of kind ``key`` are the lower-case name, the first dotted part of the id and the name
    without hyphens; a later resource takes over an equal key. Kind ``prefix`` has every prefix of
    the lower-case id and belongs to the first resource that has it. With the prefixes as keys the
    "starts with" search is an equality join.
    """
    base = resources.select(
        F.col("entity_id").cast("string").alias("entity_id"),
        F.coalesce("name", F.lit("")).alias("name"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
    )
    lowered = F.lower("name")
    keys = F.array_compact(
        F.array(
            lowered,
            F.lower(F.substring_index("entity_id", ".", 1)),
            F.when(lowered.contains("-"), F.replace(lowered, F.lit("-"), F.lit(""))),
        )
    )
    target = F.struct("entity_id", "name")
    named = (
        base.select("entity_id", "name", "ordinal", F.posexplode(keys).alias("_at", "key"))
        .groupBy("key")
        .agg(F.max_by(target, F.struct("ordinal", "_at")).alias("target"))
        .select(F.lit("key").alias("kind"), "key", "target")
    )
    lower_id = F.lower("entity_id")
    prefixes = F.transform(
        F.sequence(F.lit(0), F.length(lower_id)), lambda k: F.substring(lower_id, F.lit(1), k)
    )
    prefixed = (
        base.select("entity_id", "name", "ordinal", F.explode_outer(prefixes).alias("key"))
        .groupBy("key")
        .agg(F.min_by(target, F.col("ordinal")).alias("target"))
        .select(F.lit("prefix").alias("kind"), "key", "target")
    )
    return named.unionByName(prefixed)


def resolve_names(shorts: DataFrame, resources: DataFrame) -> DataFrame:
    """Distinct ``short`` names to ``resource_id, resource_name, resolved``.

    Order of preference: equal key, equal key without hyphens, id prefix, and last the name itself
    in title case with the short name as id.
    """
    distinct = shorts.select("short").distinct()
    wanted = tx.strip(F.lower("short"))
    tries = F.array(
        F.struct(F.lit(0).alias("rank"), F.lit("key").alias("kind"), wanted.alias("key")),
        F.struct(
            F.lit(1).alias("rank"),
            F.lit("key").alias("kind"),
            F.replace(wanted, F.lit("-"), F.lit("")).alias("key"),
        ),
        F.struct(F.lit(2).alias("rank"), F.lit("prefix").alias("kind"), wanted.alias("key")),
    )
    hits = (
        distinct.select("short", F.inline(tries))
        .join(name_targets(resources), ["kind", "key"])
        .groupBy("short")
        .agg(F.min_by("target", "rank").alias("target"))
    )
    fallback = F.replace(tx.title_case(F.col("short")), F.lit("-"), F.lit(" "))
    return distinct.join(hits, "short", "left").select(
        "short",
        F.coalesce(F.col("target.entity_id"), F.col("short")).alias("resource_id"),
        F.coalesce(F.col("target.name"), fallback).alias("resource_name"),
        F.col("target").isNotNull().alias("resolved"),
    )


def installed(software: DataFrame) -> DataFrame:
    """Software records to one row per (software, listed resource): software, display, ordinal, sub, short."""
    listed = software.select(
        F.col("entity_id").cast("string").alias("software"),
        F.coalesce("name", F.col("entity_id")).alias("display"),
        F.col("ordinal").cast("bigint").alias("ordinal"),
        F.posexplode("resources").alias("sub", "short"),
    )
    return listed


def software_members(links: DataFrame, resources: DataFrame) -> DataFrame:
    """Resolved (software, resource) rows as members; every listed name counts, also a repeated one.

    Short names are resolved once each; the way back to the rows is a lookup that stays balanced
    when one resource is listed by most of the software.
    """
    resolved = resolve_names(links, resources)
    rows = lookup_join(links, resolved, ["short"], ["software", "sub"], how="inner")
    return rows.select(
        F.col("software").alias("group"),
        F.col("display").alias("label"),
        F.col("resource_name").alias("name"),
        F.col("ordinal"),
        F.col("sub"),
        F.col("resource_id").alias("entity_id"),
        "resolved",
    )


def software_listing(
    links: DataFrame, resources: DataFrame, template: Template, chunk: int = CHUNK
) -> DataFrame:
    """Availability per software. Every link gives one member, so the links have the group sizes."""
    keys = links.select(F.col("software").alias("group"))
    return listing(software_members(links, resources), template, chunk, keys)


def gpu_software_members(links: DataFrame, resources: DataFrame) -> DataFrame:
    """Machine-learning software on GPU resources, each (software, resource) once."""
    wanted = links.where(F.lower("software").isin(ML_SOFTWARE))
    rows = software_members(wanted, resources).where("resolved")
    distinct = rows.groupBy("group", "label", "entity_id", "name").agg(
        F.min("ordinal").alias("ordinal")
    )
    gpu = resources.where(F.coalesce("has_gpu", F.lit(False))).select(
        F.col("entity_id").cast("string").alias("entity_id")
    )
    # an id occurs at most once per listed software here, so it cannot be a hot key
    kept = distinct.join(gpu.distinct(), "entity_id", "left_semi")
    # few rows after two joins and an aggregate; they are counted first and then listed
    return written(kept.withColumn("sub", F.lit(0)))


# ---- the comparisons -------------------------------------------------------------------------------


def templates(program: str) -> dict[str, Template]:
    """All comparison texts, with the catalog owner's name filled in. Fixed values."""
    return {
        "gpu": Template(
            "cmp_gpu", "compute-resources",
            f"Which {program} resources have {{label}} GPUs?",
            "{label} GPUs are available on",
        ),
        "feature": Template(
            "cmp_feat", "compute-resources",
            f"Which {program} resources support {{label}}?",
            "{label} is supported on",
            lower_label=True,
        ),
        "organization": Template(
            "cmp_org", "compute-resources",
            f"What {program} resources does {{label}} operate?",
            "{label} operates",
        ),
        "software": Template(
            "cmp_sw", "software-discovery",
            f"Which {program} resources have {{label}} installed?",
            "{label} is available on",
            cite="compute-resources",
            software=True,
        ),
        "gpu_software": Template(
            "cmp_gpu_sw", "comparison",
            f"Which GPU-enabled {program} resources have {{label}} installed?",
            f"{{label}} is available on GPU-enabled {program} resources including",
            tail=". These systems provide GPU acceleration for {label} workloads.",
            cite="compute-resources",
            software=True,
            arrival=False,
        ),
        "project_field": Template(
            "cmp_alloc_fos", "allocations",
            f"What {program} allocation projects study {{group}}?",
            "There are {count} allocation projects in {group}",
            minimum=LARGE_MINIMUM,
        ),
        "project_institution": Template(
            "cmp_alloc_inst", "allocations",
            f"What {program} allocation projects are led by researchers at {{group}}?",
            "There are {count} allocation projects at {group}",
            minimum=LARGE_MINIMUM,
        ),
        "project_resource": Template(
            "cmp_alloc_res", "allocations",
            "What allocation projects use {group}?",
            "There are {count} allocation projects using {group}",
            minimum=LARGE_MINIMUM,
        ),
        "award_program": Template(
            "cmp_nsf_prog", "nsf-awards",
            "What NSF awards are funded by the {group} program?",
            "There are {count} NSF awards funded by {group}",
            minimum=LARGE_MINIMUM,
        ),
        "award_institution": Template(
            "cmp_nsf_inst", "nsf-awards",
            "What NSF awards are at {group}?",
            "There are {count} NSF awards at {group}",
            minimum=LARGE_MINIMUM,
        ),
        "group_category": Template(
            "cmp_ag_cat", "affinity-groups",
            f"What {program} affinity groups are in the {{group}} category?",
            "The {group} affinity groups include",
            arrival=False,
        ),
    }


def generate(
    resources: DataFrame | None = None,
    software: DataFrame | None = None,
    projects: DataFrame | None = None,
    awards: DataFrame | None = None,
    groups: DataFrame | None = None,
    program: str = "catalog",
    chunk: int = CHUNK,
    distinct: bool = False,
) -> DataFrame | None:
    """All comparisons over the records of the given domains; a domain left out is skipped. With ``distinct``
    an entity counts and is listed once per group."""
    t = templates(program)
    once = distinct_members if distinct else lambda members: members
    out = []
    if resources is not None:
        out.append(listing(once(gpu_members(resources)), t["gpu"], chunk))
        out.append(listing(once(feature_members(resources)), t["feature"], chunk))
        out.append(listing(once(by_element(resources, "organizations")), t["organization"], chunk))
    if software is not None:
        if resources is None:
            empty = "entity_id string, name string, ordinal bigint, has_gpu boolean"
            resources = software.sparkSession.createDataFrame([], empty)
        links = installed(software)
        several = installed(software.where(F.size("resources") >= SMALL_MINIMUM))
        if distinct:
            out.append(listing(once(software_members(several, resources)), t["software"], chunk))
        else:
            out.append(software_listing(several, resources, t["software"], chunk))
        out.append(listing(gpu_software_members(links, resources), t["gpu_software"], chunk))
    if projects is not None:
        out.append(sampled(once(by_field(projects, "fos")), t["project_field"]))
        out.append(sampled(once(by_field(projects, "institution")), t["project_institution"]))
        out.append(sampled(once(by_element(projects, "resource_names")), t["project_resource"]))
    if awards is not None:
        out.append(sampled(once(by_field(awards, "fund_program_name")), t["award_program"]))
        out.append(sampled(once(by_field(awards, "institution")), t["award_institution"]))
    if groups is not None:
        out.append(listing(once(by_field(groups, "category")), t["group_category"], chunk))
    if not out:
        return None
    result = out[0]
    for frame in out[1:]:
        result = result.unionByName(frame)
    return result


def duplicate_ids(comparisons: DataFrame) -> DataFrame:
    """Pair ids that several groups share because the slug is cut; they also share a source_ref."""
    return (
        comparisons.groupBy("id")
        .agg(F.count(F.lit(1)).alias("groups"))
        .where("groups > 1")
    )
