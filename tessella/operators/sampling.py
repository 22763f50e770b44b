"""Seeded sampling and randomisation by hashes: the same rows at any partitioning and in any input order."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.functions.text import application_id
from tessella.operators.allocate import apportion, apportion_once, apportion_table
from tessella.operators.keys import DataError, assert_empty, assert_key, next_sequence
from tessella.sources.shared import local_table, written


def draw_hash(seed: int, stage: str, key: Column | str) -> Column:
    """A row's place in the shuffle of one stage."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(stage), (F.col(key) if isinstance(key, str) else key).cast("string")), 256)


RANKED = 100_000  # rows that one window ranks at most
DIGITS = 3  # hexadecimal digits by which a histogram gets finer in a pass: 4096 bins


def sample_rows(rows: DataFrame, n: int, seed: int, key: str, stage: str = "select") -> DataFrame:
    """Exactly n rows without replacement; fails where there are fewer. The n smallest hashes are told by a histogram, so no task sorts them all."""
    if n < 0 or rows.count() < n:
        raise DataError("sample larger than the frame")
    quota = local_table(rows.sparkSession, [(0, n)], T.StructType([T.StructField("__all", T.IntegerType()), T.StructField("allocated", T.LongType())]))
    return sample_per_group(rows.withColumn("__all", F.lit(0)), quota, "__all", seed, key, stage).select(rows.columns)


def sample_per_group(rows: DataFrame, quotas: DataFrame, group: str | list[str], seed: int, key: str, stage: str = "select") -> DataFrame:
    """Simple random samples within groups; quotas holds the group's columns and `allocated`.

    A group's sample are the rows of smallest hashes. No task ranks a whole group: rows are counted by group and hash prefix, running counts tell the prefix at which the
    quota is met, rows of smaller prefixes are taken unseen and only those of that prefix are ranked, at most RANKED (unless one key repeats more often). Groups of so few
    rows are ranked as they are.
    """
    by = [group] if isinstance(group, str) else group
    hashed = rows.withColumn("__hash", draw_hash(seed, stage, key))
    sized = rows.groupBy(*by).agg(F.count("*").alias("__size")).join(quotas.select(*by, F.col("allocated").cast("long").alias("__left")), by).filter("__left > 0")
    # __prefix: where the quota is met (at first the whole group); __left: how many rows of that prefix belong to the sample.
    cuts, digits = written(sized.select(*by, F.lit("").alias("__prefix"), "__size", "__left"), "cuts"), 0
    facts = cuts.agg(F.max("__size"), F.max("__left")).first()
    while (facts[0] or 0) > RANKED and digits < 64:
        digits += DIGITS
        cuts = written(_finer(hashed, cuts, by, digits), "cuts")
        facts = cuts.agg(F.max("__size"), F.max("__left")).first()
    prefix = F.expr("substring(__hash, 1, length(__prefix))")
    joined = hashed.join(cuts.drop("__size"), by)
    place = F.row_number().over(Window.partitionBy(*by).orderBy("__hash", key))
    # The constant bound lets map tasks pass on no more rows of a group than the largest quota.
    ranked = joined.filter(prefix == F.col("__prefix")).withColumn("__place", place).filter(F.col("__place") <= (facts[1] or 0)).filter("__place <= __left").select(rows.columns)
    return ranked if not digits else ranked.union(joined.filter(prefix < F.col("__prefix")).select(rows.columns))


def _finer(hashed: DataFrame, cuts: DataFrame, by: list[str], digits: int) -> DataFrame:
    """cuts with prefixes of so many digits where a prefix has over RANKED rows: a histogram of those rows only, of at most 16 ** DIGITS bins a group."""
    wide = cuts.filter(F.col("__size") > RANKED)
    inside = hashed.join(wide.select(*by, "__prefix", "__left"), by).filter(F.expr("substring(__hash, 1, length(__prefix))") == F.col("__prefix"))
    bins = inside.groupBy(*by, F.substring("__hash", 1, digits).alias("__bin")).agg(F.count("*").alias("__rows"), F.max("__left").alias("__left"))
    upto = F.sum("__rows").over(Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0))
    met = bins.withColumn("__upto", upto).filter("__upto >= __left and __upto - __rows < __left")
    finer = met.select(*by, F.col("__bin").alias("__prefix"), F.col("__rows").alias("__size"), (F.col("__left") - F.col("__upto") + F.col("__rows")).alias("__left"))
    # A quota beyond the group takes all of it: a prefix after every digit.
    whole = bins.groupBy(*by).agg(F.sum("__rows").alias("__rows"), F.max("__left").alias("__left")).filter("__rows < __left")
    none = F.lit(0).cast("long")
    return cuts.filter(F.col("__size") <= RANKED).unionByName(finer).unionByName(whole.select(*by, F.lit("g").alias("__prefix"), none.alias("__size"), none.alias("__left")))


def stratum(blocks: list[str]) -> Column:
    """The randomisation stratum: block values joined, or one stratum for all."""
    return F.concat_ws(" | ", *[F.col(b).cast("string") for b in blocks]) if blocks else F.lit("batch")


def assign_treatments(rows: DataFrame, n_treated: int, blocks: list[str], seed: int, key: str) -> DataFrame:
    """Exactly n_treated rows in the treated arm, apportioned over strata by their sizes; more than there are rows fails. key is unique."""
    marked = rows.withColumn("randomization_stratum", stratum(blocks))
    sizes = marked.groupBy("randomization_stratum").agg(F.count("*").alias("__size"))
    quotas = apportion_once(sizes, n_treated, "randomization_stratum", "__size")
    treated = sample_per_group(marked.select("randomization_stratum", key), quotas, "randomization_stratum", seed, key, "treat")
    joined = marked.join(treated.select(key, F.lit(True).alias("__treated")), key, "left")
    return joined.withColumn("treatment", F.when(F.col("__treated"), "legal_salience").otherwise("plain")).drop("__treated")


def assign_assistants(rows: DataFrame, assistants: list[str], seed: int, key: str) -> DataFrame:
    """Round robin with one cursor over all cells of arm and stratum, so that loads differ by at most one.

    Places are counted within sections of a cell's shuffle (by the first three digits of the hash); the sections' starts are running sums over
    the small table of sections, so no window holds a whole cell.
    """
    if not assistants or len(set(assistants)) != len(assistants) or not all(assistants):
        raise DataError("assistants must be distinct and not empty")
    section = ["treatment", "randomization_stratum", "__section"]
    hashed = rows.withColumn("__hash", draw_hash(seed, "assist", key)).withColumn("__section", F.substring("__hash", 1, 3))
    sizes = hashed.groupBy(*section).agg(F.count("*").alias("__n"))
    before = Window.orderBy(*section).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    place = F.row_number().over(Window.partitionBy(*section).orderBy("__hash", key))
    names = F.array(*map(F.lit, assistants))
    dealt = hashed.withColumn("__place", place).join(starts, section)
    chosen = F.element_at(names, ((F.col("__start") + F.col("__place") - 1) % len(assistants)).cast("int") + 1)
    return dealt.withColumn("assigned_ra", chosen).drop("__place", "__start", "__hash", "__section")


@dataclass(frozen=True)
class Design:
    """What a batch draws."""

    n: int
    strategy: str = "proportional"
    group: str = "dept_group"
    cap: int | None = None
    minimum: int = 0
    tier: str = "tier"
    tier_quotas: dict[str, int] = field(default_factory=dict)
    certainty_tiers: tuple[str, ...] = ("Department",)
    refill_tier: str = "Sub Office"


def select_offices(frame: DataFrame, design: Design, seed: int, key: str = "authority_id") -> DataFrame:
    """The selected rows of a frame under a design."""
    if design.strategy == "proportional":
        sizes = frame.groupBy(design.group).agg(F.count("*").alias("__size"))
        cap = F.least(F.col("__size"), F.lit(design.cap)) if design.cap is not None else F.col("__size")
        sizes = sizes.withColumn("__cap", cap).withColumn("__min", F.least("__cap", F.lit(design.minimum)))
        return sample_per_group(frame, apportion_table(sizes, design.n, design.group, "__size", "__cap", "__min"), design.group, seed, key)
    if design.strategy == "department_tier_quotas":
        return _by_tiers(frame, design, seed, key)
    raise DataError(f"unknown strategy {design.strategy}")


def _by_tiers(frame: DataFrame, design: Design, seed: int, key: str) -> DataFrame:
    spark, group, tier = frame.sparkSession, design.group, design.tier
    if unknown := [t for t in design.certainty_tiers if t not in design.tier_quotas]:
        raise DataError(f"certainty tier without quota: {unknown[0]}")
    quotas = spark.createDataFrame(list(design.tier_quotas.items()), f"{tier} string, __quota int")
    # One aggregate over the frame serves all checks; the quotas are a design's few tiers.
    cells = written(frame.groupBy(group, tier).agg(F.count("*").alias("__n")).join(F.broadcast(quotas), tier, "left"), "tier-cells")
    assert_empty(cells.filter("__quota is null").select(tier), "tier without quota")
    certain = [t for t in design.tier_quotas if t in design.certainty_tiers]
    full = F.array(*[F.struct(F.lit(t).alias("tier"), F.lit(design.tier_quotas[t]).cast("long").alias("n")) for t in certain])
    held = cells.groupBy(group).agg(F.map_from_entries(F.collect_list(F.struct(F.col(tier), "__n"))).alias("held"))  # one entry a tier
    if certain:
        short = F.filter(full, lambda c: F.coalesce(F.element_at("held", c["tier"]), F.lit(0)) != c["n"])
        assert_empty(held.select(group, F.explode(short).alias("expected")), "certainty tier")
    allocated = cells.select(group, tier, F.least("__n", F.col("__quota").cast("long")).alias("allocated"))
    more = design.n - (allocated.agg(F.sum("allocated")).first()[0] or 0)
    if more < 0:
        raise DataError("quotas exceed the target")
    chosen = written(sample_per_group(frame, allocated, [group, tier], seed, key), "tier-chosen")
    if not more:
        return chosen
    pool = frame.filter(F.col(tier) == design.refill_tier).join(chosen.select(key), key, "left_anti").select(frame.columns)
    return chosen.union(sample_rows(pool, more, seed, key, "refill"))


STAMPED = ("template_version", "language", "channel")


def draw_batch(
    frame: DataFrame, issued: DataFrame, design: Design, seed: int, batch_id: str, n_treated: int, blocks: list[str], assistants: list[str], stamp: dict[str, str], state_codes: list[str]
) -> tuple[DataFrame, dict]:
    """Assignments of a new batch and its provenance: select among the wanted states' offices not issued yet, treat, assign, number by state, stamp."""
    assert_key(frame, "authority_id", "frame")
    if not state_codes or seed is None or not batch_id:
        raise DataError("a batch needs state codes, a seed and an id")
    if missing := [c for c in STAMPED if not stamp.get(c)]:
        raise DataError(f"a batch needs {missing[0]}")
    free = frame.filter(F.col("state_code").isin(list(state_codes))).join(issued.select("authority_id"), "authority_id", "left_anti")
    chosen = written(select_offices(free, design, seed), "batch-chosen")
    assigned = written(assign_assistants(assign_treatments(chosen, n_treated, blocks, seed, "authority_id"), assistants, seed, "authority_id"), "batch")
    counted = assigned.groupBy("state_code").agg(F.count("*").alias("__n"))
    before = Window.orderBy("state_code").rowsBetween(Window.unboundedPreceding, -1)  # a row for each state
    states = counted.select(F.col("state_code").alias("code"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    first = next_sequence(issued, states.select("code")).join(states, "code").withColumnRenamed("code", "state_code")
    ranked = with_rank(assigned, ["state_code", design.group, "office_name", "authority_id"], "__rank")
    number = F.col("next_number") + F.col("__rank") - F.col("__before")
    numbered = ranked.join(first, "state_code").withColumn("application_id", application_id(F.col("state_code"), number)).drop("__rank", "__before", "next_number")
    for name, value in {**stamp, "batch_id": batch_id}.items():
        numbered = numbered.withColumn(name, F.lit(value))
    assert_key(numbered, "application_id", "assignments")
    meta = {
        "engine": "tessella-hash-v1", "seed": seed, "batch_id": batch_id, "n": design.n, "state_codes": list(state_codes), "frame_sha256": table_digest(frame), "issued_sha256": table_digest(issued),
    }
    return numbered, meta


def with_rank(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with their place (from 0) in an order: ranges of rows are sorted apart, and a range's start is the count of those before it."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    placed = written(placed, "ranks")  # a recomputed range exchange could cut elsewhere
    part, local = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    starts = counts.select("__part", F.coalesce(F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__first"))
    joined = placed.withColumn("__part", part).join(F.broadcast(starts), "__part")  # a row for each shuffle partition
    return joined.withColumn(name, F.col("__first") + local).drop("__id", "__part", "__first")


def table_digest(rows: DataFrame) -> str:
    """SHA-256 of a table's content in any order of rows.

    Every row is hashed over its name-sorted columns with nulls told from texts; equal rows are counted; the sorted row hashes are hashed in 4096 sections
    by their first digits, and the sections' hashes together. One hash a section reaches the driver.
    """
    columns = sorted(rows.columns)
    values = F.array(*[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns])
    row = F.sha2(F.concat_ws("|", F.transform(values, lambda v: F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))), 256)
    counted = rows.select(row.alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    sections = counted.groupBy(F.substring("h", 1, 3).alias("s")).agg(F.sum("n").alias("rows"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(F.concat_ws(":", "h", F.col("n").cast("string"))))), 256).alias("h"))
    found = sorted(map(tuple, sections.collect()))
    head = "|".join(f"{len(c)}:{c}" for c in columns)
    return hashlib.sha256("\n".join([head, *(f"{s} {n} {h}" for s, n, h in found)]).encode()).hexdigest()


def batch_margins(assignments: DataFrame, tier: str = "tier") -> DataFrame:
    """Counts by tier, arm, assistant, assistant by arm, and in all: one pass over grouping sets."""
    view = assignments.select(F.col(tier).alias("tier"), "treatment", "assigned_ra")
    grouped = view.groupingSets([["tier"], ["treatment"], ["assigned_ra"], ["assigned_ra", "treatment"], []], "tier", "treatment", "assigned_ra")
    return grouped.agg(F.grouping_id().alias("level"), F.count("*").alias("n"))


def contingency(rows: DataFrame, first: str, first_levels: list[str], second: str, second_levels: list[str]) -> DataFrame:
    """Counts for every pair of declared levels, zeros included."""
    cells = rows.sparkSession.createDataFrame(list(product(first_levels, second_levels)), f"{first} string, {second} string")
    counted = rows.groupBy(first, second).agg(F.count("*").alias("n"))
    return cells.join(counted, [first, second], "left").withColumn("n", F.coalesce("n", F.lit(0)))


__all__ = ["Design", "apportion", "assign_assistants", "assign_treatments", "batch_margins", "contingency", "draw_batch", "draw_hash", "sample_per_group", "sample_rows", "select_offices", "table_digest", "with_rank"]
