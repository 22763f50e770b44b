"""Form intake: replay-safe ingestion with a ledger. Everything is checked before a new state is returned; a failure changes nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.functions.text import form_key, hash_text, is_iso_date
from tessella.operators.keys import DataError, assert_empty, assert_key, one_of_each

# Columns of the intake's tables, and those that are blank where nothing was filed.
OUTCOME_COLUMNS = [
    "filing_outcome", "not_filed_reason", "filing_date", "registration_number", "fee_paid_inr", "payment_mode", "payment_reference", "evidence_url", "screen_recording_url", "filed_by", "due_date", "notes",
]
EVENT_COLUMNS = ["event_id", "application_id", "event_type", "event_date", "medium", "direction", "actor_authority", "document_url", "recorded_by", "recorded_at", "notes", "source_row_id"]
LEDGER_COLUMNS = ["source_row_id", "form", "application_id", "timestamp", "payload_sha256"]
UNFILED_BLANKS = ["filing_date", "registration_number", "payment_reference", "due_date", "fee_paid_inr", "payment_mode"]


@dataclass
class Intake:
    """The intake's three tables."""

    applications: DataFrame
    events: DataFrame
    submissions: DataFrame


STATE_KEYS = {"applications": ["application_id"], "events": ["event_id"], "submissions": ["source_row_id"]}  # by which a state's changes are told


def blank_table(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))


def new_intake(assignments: DataFrame) -> Intake:
    """An intake without submissions; outcome columns that assignments lack are blank."""
    assert_key(assignments, "application_id", "assignments")
    spark = assignments.sparkSession
    missing = [c for c in OUTCOME_COLUMNS if c not in assignments.columns]
    return Intake(assignments.withColumns({c: F.lit("") for c in missing}) if missing else assignments, blank_table(spark, EVENT_COLUMNS), blank_table(spark, LEDGER_COLUMNS))


def heading_key(heading: str) -> str:
    """form_key for a heading known when the plan is made."""
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in heading.lower()).split())


def read_form(rows: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Form columns by their aliases in order of priority, and by nothing else; absent fields are blank, ids upper case, pos the row's place if given.

    Headings that compare equal fail, whether a field wants them or not.
    """
    by_key: dict[str, list[str]] = {}
    for c in rows.columns:
        by_key.setdefault(heading_key(c), []).append(c)
    if twice := next((c for c in by_key.values() if len(c) > 1), None):
        raise DataError(f"ambiguous headings: {twice}")
    picked: list[Column] = []
    for field, names in aliases.items():
        found = next((by_key[heading_key(n)] for n in names if heading_key(n) in by_key), None)
        value = F.trim(F.coalesce(F.col(f"`{found[0]}`").cast("string"), F.lit(""))) if found else F.lit("")
        picked.append((F.upper(value) if field == "application_id" else value).alias(field))
    return rows.select(*picked, *(["pos"] if "pos" in rows.columns and "pos" not in aliases else []))


def choice_map(values: list[str], labels: dict[str, str], extra: dict[str, str] | None = None) -> dict[str, str]:
    """Lookup of form keys: allowed values first, then labels, then extras; the first entry of a key counts."""
    found: dict[str, str] = {}
    for label, value in [*((v, v) for v in values), *labels.items(), *(extra or {}).items()]:
        found.setdefault(heading_key(label), value)
    return found


def coerce_choice(value: Column | str, lookup: dict[str, str]) -> Column:
    """The controlled value; an empty text stays empty, anything unknown (signs alone as well) becomes null."""
    text = F.coalesce((F.col(value) if isinstance(value, str) else value).cast("string"), F.lit(""))
    table = F.create_map(*[F.lit(x) for pair in lookup.items() for x in pair])
    return F.when(text == "", F.lit("")).otherwise(F.element_at(table, form_key(text)))


def source_row_id(form: Column | str) -> Column:
    return hash_text(F.concat_ws("|", F.lit(form) if isinstance(form, str) else form, "timestamp", "application_id"))


def payload_hash(fields: list[str]) -> Column:
    """Digest of a submission's fields in order of name."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(fields)])), 256)


def mark_submissions(rows: DataFrame, form: str) -> DataFrame:
    """rows with source_row_id and payload_sha256."""
    fields = [c for c in rows.columns if c != "pos"]
    return rows.withColumn("payload_sha256", payload_hash(fields)).withColumn("source_row_id", source_row_id(form))


def ledger_conflicts(marked: DataFrame, submissions: DataFrame) -> DataFrame:
    """Ids with more than one payload in the ledger and the export together."""
    both = marked.select("source_row_id", "payload_sha256").unionByName(submissions.select("source_row_id", "payload_sha256"))
    return both.groupBy("source_row_id").agg(F.countDistinct("payload_sha256").alias("payloads")).filter("payloads > 1")


def new_submissions(marked: DataFrame, submissions: DataFrame) -> DataFrame:
    """Rows not in the ledger; of repeats in the export the first."""
    fresh = marked.join(submissions.select("source_row_id"), "source_row_id", "left_anti")
    return one_of_each(fresh, ["source_row_id"], "pos")


def latest_per_application(rows: DataFrame) -> DataFrame:
    """The last new submission of each application in file order."""
    return one_of_each(rows, ["application_id"], "pos", last=True)


def overlay(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """target with all shared columns of matched rows replaced, blanks included."""
    shared = [c for c in updates.columns if c in target.columns and c != key]
    renamed = updates.select(F.col(key), F.lit(True).alias("__hit"), *[F.col(c).alias(f"__{c}") for c in shared])
    joined = target.join(renamed, key, "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in shared else F.col(c) for c in target.columns])


def due_date(filing_date: Column, days: Column) -> Column:
    return F.date_format(F.date_add(F.try_to_date(filing_date, "yyyy-MM-dd"), days.cast("int")), "yyyy-MM-dd")


def apply_form(state: Intake, rows: DataFrame, form: str, rules: DataFrame, vocabulary: dict[str, dict[str, str]], outbound: list[str] = ()) -> Intake:
    """The state after an export of one form. rules holds (state, statutory_days) with the row _default; rows have pos, their place in the export."""
    if form not in ("filing", "update"):
        raise DataError(f"unknown form {form}")
    if not {"application_id", "timestamp"} <= set(rows.columns):
        raise DataError("application_id and timestamp are needed")
    assert_key(state.applications, "application_id", "applications")
    assert_empty(rows.filter("trim(application_id) = '' or trim(timestamp) = ''").select("pos"), "blank application_id or timestamp")
    assert_empty(rows.join(state.applications.select("application_id"), "application_id", "left_anti").select("application_id"), "unknown application")
    marked = mark_submissions(rows, form)
    assert_empty(ledger_conflicts(marked, state.submissions), "a submission of the ledger has changed")
    fresh = new_submissions(marked, state.submissions)
    ledger = fresh.select("source_row_id", F.lit(form).alias("form"), "application_id", "timestamp", "payload_sha256")
    submissions = state.submissions.unionByName(ledger)
    if form == "filing":
        filed = _filings(state, fresh, rules, vocabulary)
        return Intake(overlay(state.applications, latest_per_application(filed).drop("pos", "source_row_id", "payload_sha256", "timestamp"), "application_id"), state.events, submissions)
    return Intake(state.applications, state.events.unionByName(_events(state, fresh, vocabulary, list(outbound))), submissions)


def _filings(state: Intake, fresh: DataFrame, rules: DataFrame, vocabulary: dict[str, dict[str, str]]) -> DataFrame:
    chosen = fresh
    for name in ("filing_outcome", "not_filed_reason", "payment_mode"):
        chosen = chosen.withColumn(name, coerce_choice(name, vocabulary[name]))
    unknown = " or ".join(f"{c} is null" for c in ("filing_outcome", "not_filed_reason", "payment_mode"))
    filed = F.col("filing_outcome") == "filed"
    days = rules.filter("state != '_default'").select("state", F.col("statutory_days").alias("__days"))
    default = rules.filter("state = '_default'").select(F.col("statutory_days").alias("__default"))
    # A row for each state, and one default.
    chosen = chosen.join(state.applications.select("application_id", "state"), "application_id").join(days, "state", "left").join(F.broadcast(default.limit(1)), F.lit(True), "left")
    problems = chosen.select(
        "application_id",
        F.when(F.expr(unknown), "unknown choice").when(F.col("filing_outcome") == "", "outcome is blank")
        .when(filed & ~is_iso_date("filing_date", required=True), "invalid filing date").when(filed & F.coalesce("__days", "__default").isNull(), "no response period for the state").when(~filed & (F.col("not_filed_reason") == ""), "reason is blank").alias("problem"),
    )
    assert_empty(problems.filter("problem is not null"), "filing form")
    due = F.coalesce(due_date(F.col("filing_date"), F.coalesce("__days", "__default")), F.lit(""))
    named = chosen.withColumn("due_date", F.when(filed, due).otherwise("")).withColumn("not_filed_reason", F.when(filed, "").otherwise(F.col("not_filed_reason")))
    for c in UNFILED_BLANKS:
        if c in named.columns and c != "due_date":
            named = named.withColumn(c, F.when(filed, F.col(c)).otherwise(""))
    return named.drop("state", "__days", "__default")


def _events(state: Intake, fresh: DataFrame, vocabulary: dict[str, dict[str, str]], outbound: list[str]) -> DataFrame:
    chosen = fresh.withColumn("event_type", coerce_choice("event_type", vocabulary["event_type"])).withColumn("medium", coerce_choice("medium", vocabulary["medium"]))
    problem = F.when(F.col("event_type").isNull() | F.col("medium").isNull(), "unknown choice").when(F.col("event_type") == "", "event type is blank").when(~is_iso_date("event_date"), "invalid date")
    assert_empty(chosen.select("application_id", problem.alias("problem")).filter("problem is not null"), "update form")
    start = state.events.count()
    # One export's new rows are numbered in file order: ranges of pos, then places in them, so that no window holds the whole export.
    numbered = number_rows(chosen, "pos", start)
    direction = F.when(F.col("event_type").isin(outbound), "outbound").otherwise("inbound") if outbound else F.lit("inbound")
    full = numbered.withColumn("direction", direction).withColumn("recorded_at", F.col("timestamp")).withColumn("event_id", F.col("__number").cast("string"))
    return full.select(*[F.col(c) if c in full.columns else F.lit("").alias(c) for c in EVENT_COLUMNS])


def number_rows(rows: DataFrame, order: str, start: int = 0) -> DataFrame:
    """rows with __number, start + 1 onwards in the order of a long column: counts of ranges of 4096 values, then places within them."""
    ranged = rows.withColumn("__range", F.floor(F.col(order) / 4096))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").agg(F.count("*").alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    place = F.row_number().over(Window.partitionBy("__range").orderBy(order))
    return ranged.withColumn("__place", place).join(starts, "__range").withColumn("__number", F.col("__start") + F.col("__place") + start).drop("__range", "__place", "__start")


def sync_intake(state: Intake, issued: DataFrame) -> Intake:
    """state with newly issued applications added; applications that are not registered fail."""
    assert_empty(state.applications.join(issued.select("application_id"), "application_id", "left_anti").select("application_id"), "unregistered application")
    added = issued.join(state.applications.select("application_id"), "application_id", "left_anti")
    merged = state.applications.unionByName(added, allowMissingColumns=True).fillna("")
    return Intake(merged, state.events, state.submissions)
