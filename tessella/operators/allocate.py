"""Integer apportionment by largest remainders, with floors and caps.

A design's groups are few: a table of at most DRIVER_GROUPS groups is apportioned on the driver, in one job. A larger one goes through rounds of
aggregated sums and distributed ranks, each written.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.operators.keys import DataError, assert_empty, key_violations
from tessella.sources.shared import local_table, written

DRIVER_GROUPS = 10_000


def _byte_order(group):
    return group.encode() if isinstance(group, str) else group


def apportion(weights: dict[str, float], total: int, capacity: dict[str, float] | None = None, minimum: dict[str, float] | None = None) -> dict[str, int]:
    """Driver-side form for a design's few groups."""
    caps, floors = capacity if capacity is not None else dict(weights), minimum if minimum is not None else dict.fromkeys(weights, 0)
    if set(caps) != set(weights) or set(floors) != set(weights):
        raise DataError("weights, capacity and minimum name different groups")
    numbers = [total, *weights.values(), *caps.values(), *floors.values()]
    if any(x is None or not math.isfinite(x) or x < 0 for x in numbers):
        raise DataError("allocation values must be finite and not negative")
    if any(x != int(x) for x in [total, *caps.values(), *floors.values()]) or any(floors[g] > caps[g] for g in weights):
        raise DataError("an allocation needs whole numbers with minimum at most capacity")
    if not sum(floors.values()) <= total <= sum(caps.values()):
        raise DataError(f"allocation of {total} cannot be met")
    given = {g: int(floors[g]) for g in weights}
    while (left := total - sum(given.values())) > 0:
        live = [g for g in weights if weights[g] > 0 and given[g] < caps[g]]
        if not live:
            raise DataError("no open group with positive weight")
        mass = sum(weights[g] for g in live)
        share = {g: weights[g] / mass * left for g in live}
        for g in live:
            given[g] += int(min(math.floor(share[g]), caps[g] - given[g]))
        left = total - sum(given.values())
        by_fraction = sorted((g for g in live if given[g] < caps[g]), key=lambda g: (-(share[g] - math.floor(share[g])), _byte_order(g)))
        for g in by_fraction[:left]:
            given[g] += 1
    return given


def apportion_once(groups: DataFrame, total: int, group: str, weight: str) -> DataFrame:
    """groups with `allocated`, where every cap is the weight and every floor 0."""
    return apportion_table(groups, total, group, weight, weight)


def apportion_table(groups: DataFrame, total: int, group: str, weight: str, cap: str, floor: str | None = None) -> DataFrame:
    """groups with `allocated`; blank and repeated groups, and totals outside floors and caps, fail."""
    few = groups.limit(DRIVER_GROUPS + 1).collect()
    if len(few) > DRIVER_GROUPS:
        return _apportion_rounds(groups, total, group, weight, cap, floor)
    names = [r[group] for r in few]
    if len(set(names)) < len(names) or any(n is None or n == "" for n in names):
        raise DataError(f"groups: duplicate key or blank {group}")
    column = lambda c: {r[group]: r[c] for r in few}
    given = apportion(column(weight), total, column(cap), column(floor) if floor else None)
    schema = T.StructType([*groups.schema.fields, T.StructField("allocated", T.LongType())])
    return local_table(groups.sparkSession, [(*r, given[r[group]]) for r in few], schema)


def _apportion_rounds(groups: DataFrame, total: int, group: str, weight: str, cap: str, floor: str | None) -> DataFrame:
    from tessella.operators.sampling import with_rank

    rows = written(groups.withColumn("allocated", (F.col(floor) if floor else F.lit(0)).cast("long")), "groups")
    assert_empty(key_violations(rows, group), "groups: duplicate key")
    wrong = F.col(weight).isNull() | (F.col(weight) < 0) | (F.col("allocated") < 0) | (F.col("allocated") > F.col(cap)) | (F.col(cap) != F.floor(F.col(cap)))
    facts = rows.agg(F.sum("allocated").alias("low"), F.sum(cap).alias("high"), F.count_if(wrong).alias("bad")).first()
    if facts["bad"]:
        raise DataError("an allocation needs whole numbers with minimum at most capacity")
    if not (facts["low"] or 0) <= total <= (facts["high"] or 0):
        raise DataError(f"allocation of {total} cannot be met")
    # Every round but the last fills at least one group.
    while True:
        live = (F.col("allocated") < F.col(cap)) & (F.col(weight) > 0)
        state = rows.agg(F.sum("allocated").alias("given"), F.count_if(live).alias("live"), F.sum(F.when(live, F.col(weight))).alias("mass")).first()
        left = total - (state["given"] or 0)
        if left <= 0:
            return rows
        if not state["live"]:
            raise DataError("no open group with positive weight")
        step = rows.withColumn("__q", F.when(live, F.col(weight) / F.lit(state["mass"]) * F.lit(left)))
        step = step.withColumn("allocated", F.col("allocated") + F.when(live, F.least(F.floor("__q"), F.col(cap) - F.col("allocated"))).otherwise(0).cast("long"))
        step = step.withColumn("__full", F.col("__q").isNull() | (F.col("allocated") >= F.col(cap))).withColumn("__back", F.floor("__q") - F.col("__q")).drop("__q")
        rest = total - step.agg(F.sum("allocated")).first()[0]
        # The largest fractions take what is left; places come from ranges of groups, so no task sees them all.
        ranked = with_rank(step, ["__full", "__back", group], "__place")
        one = F.when(~F.col("__full") & (F.col("__place") < rest), 1).otherwise(0)
        rows = written(ranked.withColumn("allocated", (F.col("allocated") + one).cast("long")).drop("__full", "__back", "__place"), "groups")
