"""Analyses over the event log and the frame: status, delays, survival, weights, shrinkage, effects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def current_status(events: DataFrame, key: str, kind: str, at: str, tie: str) -> DataFrame:
    """The latest event of each key."""
    return events.groupBy(key).agg(F.max_by(kind, F.struct(at, tie)).alias("status"), F.max(at).alias("status_at"))


def days_to_event(starts: DataFrame, events: DataFrame, key: str, start: str, kind: str, at: str, kinds: list[str]) -> DataFrame:
    """Days from the start to the first event of each kind, null where there is none."""
    first = events.groupBy(key).agg(*[F.min(F.when(F.col(kind) == k, F.col(at))).alias(f"__{k}") for k in kinds])
    joined = starts.join(first, key, "left")
    return joined.select(key, *[F.date_diff(F.to_date(f"__{k}"), F.to_date(start)).cast("long").alias(f"days_to_{k}") for k in kinds])


def kaplan_meier(rows: DataFrame, time: str, event: str) -> DataFrame:
    """(time, at_risk, events, survival) at every event time; the table of times is small beside the rows."""
    by_time = rows.groupBy(time).agg(F.count("*").alias("left"), F.count_if(F.col(event)).alias("events"))
    later = Window.orderBy(F.desc(time)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    risk = by_time.withColumn("at_risk", F.sum("left").over(later)).filter("events > 0")
    before = Window.orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = F.max(F.when(F.col("events") == F.col("at_risk"), 1).otherwise(0)).over(before)
    kept = F.exp(F.sum(F.when(F.col("events") < F.col("at_risk"), F.log(1 - F.col("events") / F.col("at_risk"))).otherwise(0.0)).over(before))
    return risk.select(F.col(time).alias("time"), "at_risk", "events", F.when(ended == 1, 0.0).otherwise(kept).alias("survival"))


def answered_within(delays: DataFrame, days: str, limit: int, censor: int) -> DataFrame:
    """Flags: answered within the limit, and the delay cut off at the censoring time."""
    return delays.withColumn("answered", F.coalesce(F.col(days) <= limit, F.lit(False))).withColumn("follow_up", F.coalesce(F.least(F.col(days), F.lit(censor)), F.lit(censor)))


def inclusion_weights(frame: DataFrame, drawn: DataFrame, stratum: list[str]) -> DataFrame:
    """Inverse inclusion probability N / n of each stratum with drawn rows."""
    return frame.groupBy(*stratum).agg(F.count("*").alias("frame_n")).join(drawn.groupBy(*stratum).agg(F.count("*").alias("drawn_n")), stratum).withColumn("weight", F.col("frame_n") / F.col("drawn_n"))


def shrunken_rates(rows: DataFrame, group: str, outcome: str) -> DataFrame:
    """Group rates drawn towards the grand mean by a normal prior whose variance is estimated by moments."""
    groups = rows.groupBy(group).agg(F.count("*").alias("n"), F.avg(F.col(outcome).cast("double")).alias("rate"))
    grand = groups.agg((F.sum(F.col("n") * F.col("rate")) / F.sum("n")).alias("mean"), F.var_pop("rate").alias("spread"), F.avg(1 / F.col("n")).alias("inverse"))
    joined = groups.crossJoin(F.broadcast(grand))  # one row
    noise = F.col("mean") * (1 - F.col("mean"))
    prior = F.greatest(F.col("spread") - noise * F.col("inverse"), F.lit(1e-9))
    b = prior / (prior + noise / F.col("n"))
    return joined.select(group, "n", "rate", (b * F.col("rate") + (1 - b) * F.col("mean")).alias("shrunken"))


def within_effect(rows: DataFrame, outcome: str, treated: str, stratum: str, cluster: str) -> DataFrame:
    """Linear probability effect of treatment with stratum effects and cluster-robust standard error, by demeaned sums."""
    y, d = F.col(outcome).cast("double"), F.col(treated).cast("double")
    means = rows.groupBy(stratum).agg(F.avg(y).alias("__y"), F.avg(d).alias("__d"))
    r = rows.join(means, stratum).withColumn("__y", y - F.col("__y")).withColumn("__d", d - F.col("__d"))
    beta = r.agg((F.sum(F.col("__d") * F.col("__y")) / F.sum(F.col("__d") * F.col("__d"))).alias("effect"), F.sum(F.col("__d") * F.col("__d")).alias("ss"))
    scores = r.crossJoin(F.broadcast(beta)).groupBy(cluster, "effect", "ss").agg(F.sum(F.col("__d") * (F.col("__y") - F.col("effect") * F.col("__d"))).alias("s"))
    return scores.groupBy("effect").agg((F.sqrt(F.sum(F.col("s") * F.col("s"))) / F.first("ss")).alias("std_error"), F.count("*").alias("clusters"))


def appeal_subsample(rows: DataFrame, key: str, seed: int, percent: int = 50) -> DataFrame:
    """A fixed hash sample."""
    return rows.filter(hash_percent(seed, key) < percent)


def hash_percent(seed: int, key: str) -> Column:
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100


# Codes of the granularity supplied, from the finest.
GRANULARITY = ("format_a_application_level", "format_b_monthly", "format_c_period_totals", "narrative_only", "none")


def granularity(register_rows: Column, category_counts: Column, totals: Column, text: Column) -> Column:
    """Code of the finest data that a response holds: rows of a register, counts by category, totals of the period, prose alone, or nothing."""
    some = lambda c: F.coalesce(c, F.lit(0)) > 0
    a, b, c, narrative, none = map(F.lit, GRANULARITY)
    return F.when(some(register_rows), a).when(some(category_counts), b).when(some(totals), c).when(F.trim(F.coalesce(text, F.lit(""))) != "", narrative).otherwise(none)


def paired_difference(reported: DataFrame, measured: DataFrame, key: str, value: str) -> DataFrame:
    """Reported minus measured for keys that have both."""
    return reported.select(key, F.col(value).alias("reported")).join(measured.select(key, F.col(value).alias("measured")), key).withColumn("difference", F.col("reported") - F.col("measured"))
