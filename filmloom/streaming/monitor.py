"""Crawl monitoring, in batch and as a stream: the same functions serve both."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

#: Limits of the mean response time in seconds, the error rate and the duplicate rate.
LIMITS = {"response_time": 2.0, "error_rate": 0.1, "duplicate_rate": 0.05}


def metrics(time: str, failed: Column, repeated: Column) -> list[Column]:
    rate = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return [F.count("*").alias("n"), F.avg(time).alias("response_time"), rate(failed).alias("error_rate"), rate(repeated).alias("duplicate_rate")]


def health_plan(rows: DataFrame, concurrency: int = 40, least: int = 1) -> DataFrame:
    """reasons and actions where a limit is passed: fewer requests at once, retries, a Bloom filter."""
    over = {k: F.col(k) > v for k, v in LIMITS.items()}
    names = {"response_time": "reduce", "error_rate": "retry", "duplicate_rate": "bloom"}
    reasons = F.array_compact(F.array(*[F.when(c, k) for k, c in over.items()]))
    actions = F.array_compact(F.array(*[F.when(c, names[k]) for k, c in over.items()]))
    fewer = F.when(over["response_time"], F.lit(max(least, int(concurrency * 0.8)))).otherwise(F.lit(concurrency))
    return rows.withColumns({"reasons": reasons, "actions": actions, "concurrency": fewer})


def health_by_window(events: DataFrame, time: str, columns: list[Column], length: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    frame = events.withWatermark(time, late) if events.isStreaming else events
    rows = frame.groupBy(F.window(time, length, slide or length).alias("w")).agg(*columns)
    return rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in rows.columns if c != "w"])


def dedup_within(events: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Events without later ones of the same key, as far back as the watermark."""
    if events.isStreaming:
        return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])


def sessions(events: DataFrame, key: str, time: str, gap: str = "30 minutes") -> DataFrame:
    frame = events.withWatermark(time, gap) if events.isStreaming else events
    rows = frame.groupBy(key, F.session_window(time, gap).alias("s")).agg(F.count("*").alias("n"))
    return rows.select(key, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")


def follow_log(spark: SparkSession, path: str, schema: object, files_per_trigger: int = 10) -> DataFrame:
    """The landed log as a stream of files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


class ProgressCallback(StreamingQueryListener):
    """Calls on_progress(batch id, rows) after each batch of any stream of the session; add it with spark.streams.addListener."""

    def __init__(self, on_progress: Callable[[int, int], None]):
        self._on_progress = on_progress

    def onQueryStarted(self, event: object) -> None:
        pass

    def onQueryProgress(self, event: object) -> None:
        self._on_progress(event.progress.batchId, event.progress.numInputRows)

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        pass


def upsert_stream(events: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Each micro-batch is merged into keyed tables by `apply(batch, batch_id)`, once per batch id."""
    return events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def export_stream(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """What is new since the last run, exactly once: the checkpoint is the watermark of the export."""
    return events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(events: DataFrame, time: str, late: str, length: str, base: str, checkpoint: str) -> StreamingQuery:
    """A second sink: rows whose window was closed before they came, to base/late; run it beside health_by_window.

    A batch's rows are late when their window of this length ended at or before the latest time of earlier batches, less
    the lateness: those that the windows drop. Each batch writes a folder of its own, and its latest time to base/marks,
    so a batch that is run again finds what it found before.
    """
    spark = events.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            marks = spark.read.schema("batch long, latest timestamp").option("recursiveFileLookup", True)
            # the first batch has none before it
            before = marks.parquet(f"{base}/marks").where(F.col("batch") < batch_id).agg(F.max("latest")).first()[0] if batch_id else None
            closed = F.lit(False) if before is None else F.window(time, length).end <= F.lit(before) - F.expr(f"interval {late}")
            batch.where(closed).write.mode("overwrite").parquet(f"{base}/late/{batch_id}")
            latest = batch.agg(F.max(time).alias("latest")).select(F.lit(batch_id).cast("long").alias("batch"), "latest")
            latest.write.mode("overwrite").parquet(f"{base}/marks/{batch_id}")
        finally:
            batch.unpersist()

    return events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep their state in RocksDB, on the executors' disks and in the checkpoint; others as before."""
    key, provider = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(key, None)
    spark.conf.set(key, provider)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


#: Outcomes of so many microseconds of a key's time are one entry of its state.
STRETCH = 15 * 60 * 10**6
_SETTLED = -1


class _Failures(StatefulProcessor):
    """Of one key: its failures since the last success, those up to the watermark as a number, those behind it by stretches of time.

    A failure before a success that is known can't count any more, so what is kept is the last success, as long as
    something may still come before it, and the failures after it.
    """

    def __init__(self, key: str, k: int):
        self._key, self._k = key, k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # the entry _SETTLED has the number and the last success, the others have failures: a batch writes the stretches that it touches
        self._state = handle.getMapState("outcomes", "stretch long", "failures long, places array<struct<at: long, tie: long, bad: boolean>>")

    def _fold(self, watermark: int, new: list[tuple[int, int, bool]]) -> int:
        """Outcomes up to the watermark, which nothing can come before, become the number. The failures in a row so far."""
        held = {k[0]: (v[0], [tuple(x) for x in v[1]]) for k, v in self._state.iterator()}
        before = held.pop(_SETTLED, (0, []))
        settled, latest = before[0], before[1][0][:2] if before[1] else None
        success = max((x[:2] for x in new if not x[2]), default=None)
        if success is not None and (latest is None or success > latest):
            settled, latest = 0, success
        stretches, self._open = {k: v[1] for k, v in held.items()}, None
        for x in new:
            if x[2] and (latest is None or x[:2] > latest):
                stretches[x[0] // STRETCH] = [*stretches.get(x[0] // STRETCH, []), x]
        count = settled
        for k, places in stretches.items():
            places = [x for x in places if latest is None or x[:2] > latest]
            count += len(places)
            left = [x for x in places if x[0] > watermark]
            settled += len(places) - len(left)
            self._open = max([x[0] for x in left] + ([] if self._open is None else [self._open]), default=None)
            if not left and k in held:
                self._state.removeKey((k,))
            elif left and left != held.get(k, (0, []))[1]:
                self._state.updateValue((k,), (0, left))
        after = (settled, [(*latest, False)] if latest is not None and latest[0] > watermark else [])
        if after == (0, []) != before:
            self._state.removeKey((_SETTLED,))
        elif after != before:
            self._state.updateValue((_SETTLED,), after)
        return count

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        new: list[tuple[int, int, bool]] = []
        for frame in rows:
            new += zip(frame["at_us"].tolist(), frame["tie_no"].tolist(), frame["bad"].tolist(), strict=True)
        count = self._fold(timerValues.getCurrentWatermarkInMs() * 1000, new)
        # the failures of a key that falls silent are settled when the watermark has passed them; one success may stay
        if self._open is not None:
            self._handle.registerTimer(self._open // 1000 + 1)
        yield pd.DataFrame({self._key: [key[0]], "failures": [count], "stop": [count >= self._k]})

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._fold(timerValues.getCurrentWatermarkInMs() * 1000, [])
        return iter([])

    def close(self) -> None:
        pass


def consecutive_failures(events: DataFrame, key: str, time: str, tie: str, failed: str, k: int, late: str = "1 hour") -> DataFrame:
    """key, failures and stop: the failures in a row at the end of each key's events so far, in order of time and a number
    that breaks ties, whatever the order in which they arrive within the lateness.

    The state of a key is a number, its last success and the failures after that and the watermark; timers settle what
    it has passed. A failure at the very place of a success, tie included, doesn't count. Start the
    stream within rocksdb_state, so that state is on disk. Rows that come later than the lateness are dropped.
    """
    kind = dict(events.dtypes)[key]
    # names that begin with an underscore don't reach a stateful processor
    rows = events.withWatermark(time, late).select(key, time, F.unix_micros(time).alias("at_us"), F.col(tie).cast("long").alias("tie_no"), F.col(failed).alias("bad"))
    return rows.groupBy(key).transformWithStateInPandas(_Failures(key, k), f"{key} {kind}, failures long, stop boolean", "update", "eventtime")
