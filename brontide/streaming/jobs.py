"""Structured Streaming forms: merges by micro-batch, due slots by timers, sessions of rain."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from brontide.sources.partitions import PartitionedTable
from brontide.sources.tables import VersionedTable, dated_events

FINAL = "expected_slot_id string, collection_state string, event_at timestamp"
RUNS = "source_id string, dag_run_id string, status string, is_publishable boolean, event_at timestamp"


def with_state_store(spark: SparkSession) -> None:
    """Typed state and timers need the store that keeps several states of a key."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def merge_batches(stream: DataFrame, table: VersionedTable | PartitionedTable, key: list[str], transform: Callable[[DataFrame], DataFrame], checkpoint: str, partition: str | None = None):
    """Upserts each micro-batch's transformed rows. A batch that is run again gives the same
    table, as the upsert is keyed."""

    def merge(batch: DataFrame, _: int) -> None:
        rows = transform(batch)
        if not rows.isEmpty():
            table.upsert(rows, key, partition)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: How long a finished slot is remembered, so that late outcomes do not finish it again.
KEEP_MS = 7 * 24 * 3600 * 1000


class _DueSlot(StatefulProcessor):
    """A slot's deadline and end. Its one timer stands at the deadline, then at the end of its memory."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.deadline = handle.getValueState("deadline", "ms long")
        self.ended = handle.getValueState("ended", "ended boolean")

    def _timer(self, at: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        deadline = self.deadline.get()[0] if self.deadline.exists() else 0
        ended, latest = self.ended.exists(), 0
        for r in rows:
            latest = max(latest, int(r.event_at.timestamp() * 1000))
            if r.kind == "declared":
                deadline = max(deadline, int(r.deadline_at.timestamp() * 1000))
            elif not ended:
                ended = True
                self.ended.update((True,))
                yield Row(expected_slot_id=key[0], collection_state=r.collection_state, event_at=r.event_at)
        self.deadline.update((deadline,))
        now = timerValues.getCurrentWatermarkInMs()
        if ended:
            self._timer(max(deadline, now, latest) + KEEP_MS)
        elif deadline:
            self._timer(max(deadline, now + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.ended.exists():
            self.ended.clear()
            self.deadline.clear()
            return
        self.ended.update((True,))
        self._timer(timerValues.getCurrentWatermarkInMs() + KEEP_MS)
        yield Row(expected_slot_id=key[0], collection_state="missing_unknown", event_at=datetime.fromtimestamp(self.deadline.get()[0] / 1000))

    def close(self) -> None:
        pass


def due_slots(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """One final row for each slot: its first outcome, or missing_unknown once the watermark
    passes its deadline. stream: expected_slot_id, kind (declared or outcome), deadline_at,
    collection_state, event_at."""
    with_state_store(stream.sparkSession)
    rows = stream.withWatermark("event_at", late)
    return rows.groupBy("expected_slot_id").transformWithState(_DueSlot(), FINAL, "append", "EventTime")


def _run(source: str, run: str, newest: bool, micros: int) -> Row:
    return Row(source_id=source, dag_run_id=run, status="SUCCESS" if newest else "COALESCED", is_publishable=newest, event_at=datetime.fromtimestamp(micros / 1e6))


class _NewestRun(StatefulProcessor):
    """The newest run of a source, by (event_at, dag_run_id). It is dropped when nothing came for a while."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "micros long, dag_run_id string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = tuple(self.newest.get()) if self.newest.exists() else None
        events = sorted({(round(r.event_at.timestamp() * 1e6), r.dag_run_id) for r in rows})
        if not events:
            return
        for at, run in events:
            if before is not None and (at, run) < before:
                yield _run(key[0], run, False, at)
                continue
            if before is not None and before[1] != run:
                yield _run(key[0], before[1], False, before[0])
            before = (at, run)
        if events[-1] == before:
            yield _run(key[0], before[1], True, before[0])
        self.newest.update(before)
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        # Until a batch has passed there is no watermark, so the event's own time counts too.
        self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs(), before[0] // 1000) + KEEP_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


def coalesced_runs(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Of a burst of publishable events of a source the newest run is a success and the others are
    merged away, as rows to be upserted by (source_id, dag_run_id): a run may first be a
    success and later COALESCED. Events whose load_date is not their local day are left out
    (dated_events gives them), and an event that is told again within the watermark counts once."""
    with_state_store(stream.sparkSession)
    good, _ = dated_events(stream)
    rows = good.withWatermark("event_at", late).dropDuplicatesWithinWatermark(["source_id", "dag_run_id", "event_at"])
    return rows.groupBy("source_id").transformWithState(_NewestRun(), RUNS, "append", "EventTime")


def precipitation_sessions(stream: DataFrame, key: str = "place_id", at: str = "forecast_at", late: str = "1 hour") -> DataFrame:
    """Runs of hourly precipitation as sessions. Sessions that touch merge, so a gap of one hour
    joins consecutive hours and splits where an hour is dry."""
    wet = stream.where("is_precipitating").withWatermark(at, late)
    found = wet.groupBy(key, F.session_window(at, "1 hour")).agg(F.count("*").alias("precipitation_hour_count"), F.max("precip_prob_pct").alias("precip_prob_max_pct"))
    end = F.col("session_window.end") - F.expr("INTERVAL 1 HOUR")
    return found.select(key, F.col("session_window.start").alias("window_start_at"), end.alias("window_end_at"), "precipitation_hour_count", "precip_prob_max_pct")
