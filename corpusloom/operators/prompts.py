"""Prompt columns: field-group pass, discovery pass, user message, judge message.

The wording of the instructions is this project's own. The record formats inside them (numbered
pair list, pair block, user message, answer format, citation marker) are fixed values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from .domains import REGISTRY

# ---- fixed values: data fields of the field groups, formats -----------------------------------
# domain -> (data fields, topic, when it applies)
FIELD_GROUPS: dict[str, list[tuple[str, str, str | None]]] = {
    "compute-resources": [
        ("name, description, resourceType", "Overview of the system and its purpose", None),
        ("organization_names", "Operating organization", None),
        ("hardware.gpus", "GPU models, numbers and memory", "hasGpu is true and hardware.gpus is filled"),
        ("hardware.compute_nodes", "CPU and compute nodes", "hardware.compute_nodes is filled"),
        ("hardware.storage", "Storage systems and sizes", "hardware.storage is filled"),
        ("feature_names", "Supported features", None),
        ("accessAllocated", "Ways to get access", None),
    ],
    "software-discovery": [
        ("name, description, software_type", "Overview and kind of tool", None),
        ("available_on_resources", "Systems that have it installed", None),
        ("versions", "Available versions", None),
        ("example_use", "Loading and using it", "example_use is filled"),
        ("research_area, research_field, tags", "Disciplines that use it", None),
        ("core_features", "Key capabilities", "core_features is filled"),
    ],
    "allocations": [
        ("title, abstract, allocation_type", "Overview of the project", None),
        ("pi, institution", "Lead researcher and institution", None),
        ("resources", "Allocated resources with names, units and amounts", None),
        ("field_of_science", "Discipline", None),
        ("beginDate, endDate", "Start and end", None),
    ],
    "nsf-awards": [
        ("title, abstract", "Overview of the award", None),
        ("principal_investigator, institution, co_pis", "Investigators and institution", "co_pis only where given"),
        ("total_intended_award, totalAwardedToDate", "Amounts awarded", None),
        ("fund_program_name", "Funding program", None),
        ("startDate, endDate", "Start and end", None),
    ],
    "affinity-groups": [
        ("name, description, category", "Overview and community served", None),
        ("coordinator", "Coordinator", None),
        ("slack_link, support_url, ask_ci_forum", "Ways to join or make contact", None),
        ("upcoming_events", "Events of the group", "upcoming_events is filled"),
        ("knowledge_base_topics", "Articles and resources kept by the group", "knowledge_base_topics is filled"),
    ],
}
DATA_NOTES: dict[str, list[str]] = {
    "nsf-awards": [
        "`primary_program_budget_code` is an internal budget code; name the program by `fund_program_name`.",
    ],
    "affinity-groups": [
        "Write obfuscated e-mail addresses ([at], [dot]) in their normal form.",
        "Listed events may be over already: do not call them upcoming or scheduled.",
    ],
}
ANSWER_FORMAT = '[{"question": "...", "answer": "...\\n\\n<<SRC:domain:id>>"}]'
ANSWER_PREVIEW = 150
NO_PAIRS = "(none)"
JUDGE_FORMAT = (
    '[{"pair_id": "...", "faithfulness": 0.0, "relevance": 0.0, "completeness": 0.0, "issues": []}]'
)
# ------------------------------------------------------------------------------------------------

SHARED_RULES = [
    'Answer with a JSON array whose objects have the two fields "question" and "answer".',
    "Use facts from the given data only; where a field is thin, look for more in the free text.",
    "Ask the way a researcher types into a search box; answer briefly, with names, numbers and dates.",
    "Close every answer with the citation marker of the user message.",
    "Call the entity by its given name, never \"this project\" or the like; put a long lower-case "
    "title in quotation marks.",
]

JUDGE_SYSTEM = "\n".join(
    [
        "You grade question/answer pairs against the source data they were written from.",
        "Give each pair three scores from 0.0 to 1.0:",
        "- faithfulness: the data supports every claim (be strict)",
        "- relevance: the answer addresses the question",
        "- completeness: the answer has the main facts (be lenient)",
        "List problems found as short texts in issues, or leave the list empty.",
        "Answer with a JSON array, one object per pair:",
        JUDGE_FORMAT,
    ]
)


def guidance_table(spark: SparkSession) -> DataFrame:
    """The field groups of all registered domains as rows ``domain, pos, fields, topic, condition``."""
    rows = [
        (domain, pos, *group)
        for domain, groups in FIELD_GROUPS.items()
        for pos, group in enumerate(groups, start=1)
    ]
    return spark.createDataFrame(
        rows, "domain string, pos int, fields string, topic string, condition string"
    )


def _notes_block(domain: str) -> str:
    notes = DATA_NOTES.get(domain, [])
    return "\n\nNotes on the data:\n" + "\n".join(f"- {n}" for n in notes) if notes else ""


def _rules_block(extra: list[str]) -> str:
    rules = SHARED_RULES + extra
    return "Rules:\n" + "\n".join(f"{i}. {rule}" for i, rule in enumerate(rules, start=1))


def guidance_block(domain: str) -> str:
    lines = []
    for n, (fields, topic, condition) in enumerate(FIELD_GROUPS.get(domain, []), start=1):
        note = f" (skip unless: {condition})" if condition else ""
        lines.append(f"{n}. {topic}{note}\n   Data fields: `{fields}`")
    return "\n".join(lines)


def _owned(display: str, program: str) -> str:
    """A catalog by its owner's name; nothing is said of the owner without one."""
    return f"{program} {display}" if program else display


def battery_system(domain: str, program: str = "") -> str:
    """First pass: exactly one pair per field group. ``program`` is the catalog owner's name."""
    spec = REGISTRY[domain]
    return "\n\n".join(
        [
            f"You write question/answer pairs about {_owned(spec.display, program)}. You get the data of one "
            f"{spec.entity_type}. Write exactly one pair for each field group below; leave a group "
            "out only when the data has nothing for it.",
            f"Field groups:\n{guidance_block(domain)}",
            _rules_block(["One pair per field group, no more and no fewer."]) + _notes_block(domain),
            f"Answer format:\n{ANSWER_FORMAT}",
        ]
    )


def discovery_parts(domain: str, program: str = "") -> tuple[str, str]:
    """Second pass: the text before and after the list of pairs that exist already."""
    spec = REGISTRY[domain]
    before = (
        f"You write question/answer pairs about {_owned(spec.display, program)}. You get the data of one "
        f"{spec.entity_type} and the pairs written for it so far. Find what they miss.\n\n"
        "Pairs so far:\n\n"
    )
    after = "\n\n" + "\n\n".join(
        [
            "Look for partnerships, technologies and methods, unusual uses, specific figures, and "
            "whatever else sets this entity apart. Answer `[]` when nothing is left to add.",
            _rules_block(["Do not repeat a topic the pairs so far cover."]) + _notes_block(domain),
            f"Answer format:\n{ANSWER_FORMAT}",
        ]
    )
    return before, after


def by_domain(domain: Column, texts: dict[str, str]) -> Column:
    """Constant per domain; an unregistered domain gives NULL."""
    return reduce(
        lambda acc, item: F.when(domain == item[0], F.lit(item[1])).otherwise(acc),
        texts.items(),
        F.lit(None).cast("string"),
    )


def battery_prompt(domain: Column, program: str = "") -> Column:
    return by_domain(domain, {d: battery_system(d, program) for d in REGISTRY})


def existing_block(items: Column) -> Column:
    """Numbered list of the pairs so far, with a preview of each answer."""
    lines = F.transform(
        items,
        lambda x, i: F.concat(
            (i + 1).cast("string"),
            F.lit(". **Q:** "),
            x["question"],
            F.lit("\n   **A:** "),
            tx.truncate(x["answer"], ANSWER_PREVIEW),
        ),
    )
    return F.when(F.size(items) > 0, F.array_join(lines, "\n")).otherwise(F.lit(NO_PAIRS))


def discovery_prompt(domain: Column, items: Column, program: str = "") -> Column:
    parts = {d: discovery_parts(d, program) for d in REGISTRY}
    before = by_domain(domain, {d: p[0] for d, p in parts.items()})
    after = by_domain(domain, {d: p[1] for d, p in parts.items()})
    return F.concat(before, existing_block(items), after)


def user_prompt(domain: Column, entity_id: Column, entity_json: Column, entity_name: Column) -> Column:
    name = F.coalesce(F.nullif(entity_name, F.lit("")), entity_id)
    return F.concat(
        F.lit("Entity ID: "),
        entity_id,
        F.lit("\nEntity name: "),
        name,
        F.lit("\nCitation marker: "),
        tx.citation(domain, entity_id),
        F.lit("\n\nData:\n"),
        entity_json,
    )


def pair_block(pair_id: Column, question: Column, answer: Column) -> Column:
    return F.concat(
        F.lit("### "), pair_id, F.lit("\n**Q:** "), question, F.lit("\n**A:** "), answer, F.lit("\n")
    )


def judge_user(source_json: Column, block: Column) -> Column:
    return F.concat(
        F.lit("## Source data\n\n"), source_json, F.lit("\n\n## Q&A pairs to evaluate\n\n"), block
    )


def judge_block(pairs: Column) -> Column:
    """Block of all pairs of the list in one row."""
    return F.array_join(
        F.transform(
            pairs,
            lambda p: pair_block(
                p["id"], p["messages"][0]["content"], p["messages"][1]["content"]
            ),
        ),
        "\n",
    )


def judge_batches(
    pairs: DataFrame, key: list[str], seq: str, batch: int = 1000
) -> DataFrame:
    """Pair rows (``seq`` counts from 1 per key) to judge blocks of at most ``batch`` pairs.

    One entity normally is one block. The block number comes from the sequence number, so a key
    with very many pairs is cut into bounded blocks without ranking it.
    """
    numbered = pairs.withColumn("block", F.floor((F.col(seq) - 1) / batch).cast("int"))
    return (
        numbered.groupBy(*key, "block")
        .agg(
            F.count(F.lit(1)).alias("pairs"),
            F.sort_array(
                F.collect_list(F.struct(F.col(seq).alias("seq"), "id", "question", "answer"))
            ).alias("_p"),
        )
        .select(
            *key,
            "block",
            "pairs",
            F.array_join(
                F.transform("_p", lambda p: pair_block(p["id"], p["question"], p["answer"])), "\n"
            ).alias("pairs_block"),
        )
    )
