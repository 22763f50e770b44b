"""Streaming intake: exports that arrive as files go through the same ledger, and conflicting payloads are told as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tessella.operators.intake import STATE_KEYS, Intake, apply_form
from tessella.operators.sampling import with_rank
from tessella.sources.state import VersionedState
from tessella.sources.shared import written

CONFLICTS = "source_row_id string, first_payload string, payload string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ledger_stream(submissions: DataFrame, at: str | None = None, late: str = "30 days") -> DataFrame:
    """The first submission of every source_row_id; duplicates are dropped across batches by state.

    With an event-time column `at`, ids are forgotten after `late`, which bounds the state; without it all ids are remembered.
    """
    if at is None:
        return submissions.dropDuplicates(["source_row_id"])
    return submissions.withWatermark(at, late).dropDuplicatesWithinWatermark(["source_row_id"])


def intake_batches(spark: SparkSession, root: str, form: str, rules: DataFrame, vocabulary: dict[str, dict[str, str]], outbound: list[str] = ()) -> Callable[[DataFrame, int], None]:
    """For run_available: every batch of read form rows goes through apply_form into the next version of the state in root, which holds only the rows that changed.

    A batch that is played again, whole or in part, finds its submissions in the ledger and changes nothing; a batch that fails leaves the state as it was.
    Rows without pos are numbered in the order of timestamp and application_id.
    """
    store = VersionedState(spark, root)

    def apply(rows: DataFrame, batch: int) -> None:
        if "pos" not in rows.columns:
            rows = with_rank(rows, ["timestamp", "application_id", *[c for c in rows.columns if c not in ("timestamp", "application_id")]], "pos")
        else:
            rows = written(rows, "intake-batch")
        now = Intake(**store.load())
        done = apply_form(now, rows, form, rules, vocabulary, outbound)
        store.save({"applications": done.applications, "events": done.events, "submissions": done.submissions}, STATE_KEYS)

    return apply


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """For run_available: a folder for each batch, overwritten when the batch is played again."""
    return lambda rows, batch: rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


class _Conflicts(StatefulProcessor):
    """The first payload of an id as value state; with a horizon a timer on event time ends it."""

    def __init__(self, at: str | None, horizon_ms: int):
        self.at, self.horizon_ms = at, horizon_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", "payload string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        frame = pd.concat(frames).sort_values([c for c in (self.at, "payload_sha256") if c], kind="stable")
        known = self.first.get()[0] if self.first.exists() else None
        if known is None:
            known = frame["payload_sha256"].iloc[0]
            self.first.update((known,))
            if self.at:
                self.handle.registerTimer(int(frame[self.at].iloc[0].timestamp() * 1000) + self.horizon_ms)
        other = frame.loc[frame["payload_sha256"] != known, "payload_sha256"]
        if len(other):
            yield pd.DataFrame({"source_row_id": key[0], "first_payload": known, "payload": other.to_numpy()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.first.clear()
        return iter(())

    def close(self) -> None:
        return None


def conflict_stream(submissions: DataFrame, at: str | None = None, horizon: timedelta = timedelta(days=30)) -> DataFrame:
    """Submissions whose payload differs from the first one of their id (source_row_id, payload_sha256).

    With an event-time column `at`, an id's first payload is forgotten once the watermark is `horizon` past its time, which bounds the state; a later submission then is a
    first one again. Without it all ids are remembered. Rows of one batch are taken in the order of time and payload. The state is kept in RocksDB.
    """
    submissions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = submissions.select("source_row_id", "payload_sha256", *([at] if at else []))
    rows = rows.withWatermark(at, "0 seconds") if at else rows
    processor = _Conflicts(at, int(horizon.total_seconds() * 1000))
    return rows.groupBy("source_row_id").transformWithStateInPandas(processor, CONFLICTS, "Append", "EventTime" if at else "None")


def payload_conflicts(submissions: DataFrame, order: list[str]) -> DataFrame:
    """The batch form of conflict_stream: one aggregate tells the first payload of every id, by the columns of order."""
    first = submissions.groupBy("source_row_id").agg(F.min_by("payload_sha256", F.struct(*order)).alias("first_payload"))
    return submissions.join(first, "source_row_id").filter("payload_sha256 != first_payload").select("source_row_id", "first_payload", F.col("payload_sha256").alias("payload"))


def run_available(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Put everything that has arrived through apply, batch by batch, and stop; a restart goes on after the last batch."""
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def arrivals_per_window(events: DataFrame, at: str = "ts", late: str = "2 hours", width: str = "1 day") -> DataFrame:
    """Counts by window of event time; events later than the watermark are left out."""
    return events.withWatermark(at, late).groupBy(F.window(at, width)).agg(F.count("*").alias("n"))
