"""Streams whose watermark closes windows and evicts state, with rows that come late."""

import datetime
import json
import random

from pyspark.sql import functions as F

from filmloom.streaming import monitor

START = datetime.datetime(2024, 1, 1)
SCHEMA = "id long, g string, ts timestamp, bad boolean"


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def state(query):
    """Rows in state and rows dropped, over the batches of a run."""
    progress = [json.loads(p.json) if hasattr(p, "json") and not isinstance(p, dict) else p for p in query.recentProgress]
    operators = [o for p in progress for o in p["stateOperators"]]
    return [o["numRowsTotal"] for o in operators], sum(o["numRowsDroppedByWatermark"] for o in operators)


def land(spark, path, number, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{path}/in/{number}")
    return monitor.follow_log(spark, f"{path}/in/*", spark.createDataFrame([], SCHEMA).schema, 1000)


def test_windows_close_and_late_rows_have_a_sink(spark, tmp_path):
    base = f"file://{tmp_path}"
    parts = [
        [(1, "a", at(5), False), (2, "a", at(65), False)],
        [(3, "a", at(125), False), (4, "a", at(185), False)],
        # the windows of 0 and 60 minutes are closed; that of 180 isn't
        [(5, "late", at(30), False), (6, "late", at(70), False), (7, "a", at(190), False), (8, "a", at(305), False)],
    ]
    dropped, sizes = 0, []
    for i, part in enumerate(parts):
        rows = land(spark, base, i, part)
        closed = monitor.health_by_window(rows, "ts", [F.count("*").alias("n")])
        query = monitor.export_stream(closed, f"{base}/windows", f"{base}/mark")
        query.awaitTermination()
        total, lost = state(query)
        dropped, sizes = dropped + lost, [*sizes, total[-1]]
        monitor.late_rows(rows, "ts", "10 minutes", "1 hour", base, f"{base}/late_mark").awaitTermination()
    windows = {r.window_start: r.n for r in spark.read.parquet(f"{base}/windows").collect()}
    assert windows == {at(0): 1, at(60): 1, at(120): 1, at(180): 2}
    late = spark.read.option("recursiveFileLookup", True).schema(SCHEMA).parquet(f"{base}/late")
    assert sorted(r.id for r in late.collect()) == [5, 6] and dropped == 2
    # a state row per open window: what is closed is gone
    assert sizes == [2, 2, 1]


def test_a_late_batch_again(spark, tmp_path):
    """A batch that is run a second time, with its checkpoint lost, writes the same late rows once."""
    base = f"file://{tmp_path}"
    for i, part in enumerate([[(1, "a", at(600), False)], [(2, "a", at(1), False)]]):
        rows = land(spark, base, i, part)
        monitor.late_rows(rows, "ts", "10 minutes", "1 hour", base, f"{base}/mark").awaitTermination()
    before = spark.read.option("recursiveFileLookup", True).schema(SCHEMA).parquet(f"{base}/late").count()
    (tmp_path / "mark" / "commits" / "1").unlink()
    (tmp_path / "mark" / "commits" / ".1.crc").unlink(missing_ok=True)
    monitor.late_rows(rows, "ts", "10 minutes", "1 hour", base, f"{base}/mark").awaitTermination()
    assert before == 1 == spark.read.option("recursiveFileLookup", True).schema(SCHEMA).parquet(f"{base}/late").count()


def test_ids_are_forgotten(spark, tmp_path):
    base = f"file://{tmp_path}"
    sizes, dropped = [], 0
    for i in range(4):
        part = [(i * 100 + j, "a", at(i * 100 + j), False) for j in range(100)]
        part += [(i * 100 - 3, "again", at(i * 100 - 3), False)] if i else []  # within the lateness: a repeat
        part += [(-i, "late", at(0), False)] if i == 3 else []  # behind the watermark: dropped
        query = monitor.export_stream(monitor.dedup_within(land(spark, base, i, part), "id", "ts", "30 minutes"), f"{base}/out", f"{base}/mark")
        query.awaitTermination()
        total, lost = state(query)
        sizes.append(total[-1])
        dropped += lost
    out = spark.read.parquet(f"{base}/out")
    assert sorted(r.id for r in out.collect()) == list(range(400)) and dropped == 1
    # an id stays for the lateness behind the watermark: an hour of ids, not all that came
    assert max(sizes) <= 100 and sizes[-1] <= 65


def brute(rows):
    out = {}
    for i, g, _, bad in sorted(rows, key=lambda r: (r[2], r[0])):
        out[g] = out.get(g, 0) + 1 if bad else 0
    return out


def test_failures_in_a_row_with_bounded_state(spark, tmp_path):
    """Any order within the lateness, ties, silent keys, and a key that only fails: its state doesn't grow."""
    base, rng = f"file://{tmp_path}", random.Random(4)
    rows = [(j, rng.choice("ab"), at(j // 3), rng.random() < 0.7) for j in range(1200)]
    rows += [(5000 + j, "fails", at(j / 10), True) for j in range(4000)] + [(9000, "silent", at(1), True), (9001, "silent", at(2), True)]
    arrival = sorted(rows, key=lambda r: r[2] + datetime.timedelta(minutes=rng.random() * 20))
    seen, entries, bytes_ = {}, [], []

    def apply(batch, batch_id):
        seen.update({r.g: (r.failures, r.stop) for r in batch.collect()})

    with monitor.rocksdb_state(spark):
        for i in range(3):
            frame = land(spark, base, i, arrival[i * len(arrival) // 3 : (i + 1) * len(arrival) // 3])
            out = monitor.consecutive_failures(frame, "g", "ts", "id", "bad", 2, "30 minutes")
            query = out.writeStream.outputMode("update").foreachBatch(apply).option("checkpointLocation", f"{base}/mark").trigger(availableNow=True).start()
            query.awaitTermination()
            total, lost = state(query)
            entries.append(total[-1])
            assert lost == 0
    assert {g: n for g, (n, _) in seen.items()} == brute(rows)
    assert all(stop == (n >= 2) for n, stop in seen.values()) and seen["fails"] == (4000, True)
    # per key the number, the stretches behind the watermark and timers, whatever went before
    assert max(entries) <= 40 and entries[-1] <= entries[0]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_open_outcomes_are_bounded_by_the_lateness():
    """The processor itself: a million failures, then one success that comes late, behind what is settled and before it."""

    class Map(dict):
        iterator = dict.items
        removeKey = dict.pop
        updateValue = dict.__setitem__

    held = Map()
    processor = monitor._Failures("g", 2)
    processor._state = held
    count = 0
    for i in range(1000):
        now = i * 10**9
        count = processor._fold(now - 3 * 10**9, [(now + j, j, True) for j in range(1000)])
        assert len(held) <= 6 and sum(len(v[1]) for v in held.values()) <= 4001
    assert count == 10**6
    assert processor._fold(now - 3 * 10**9, [(now - 2 * 10**9, -1, False)]) == 3000


def test_timers_are_asked_for():
    class Handle:
        timers = []

        def registerTimer(self, ms):
            self.timers.append(ms)

    class Times:
        @staticmethod
        def getCurrentWatermarkInMs():
            return 0

    import pandas as pd

    class Map(dict):
        iterator = dict.items
        removeKey = dict.pop
        updateValue = dict.__setitem__

    p = monitor._Failures("g", 1)
    p._handle, p._state = Handle(), Map()
    frame = pd.DataFrame({"at_us": [5_000_000, 9_000_000], "tie_no": [1, 2], "bad": [False, True]})
    assert list(p.handleInputRows(("x",), iter([frame]), Times))[0].to_dict("records") == [{"g": "x", "failures": 1, "stop": True}]
    assert Handle.timers == [9001] and list(p.handleExpiredTimer(("x",), Times, None)) == []


def test_state_calls_are_few():
    """A key whose outcomes are mostly successes costs a few calls of its state in a batch, however many stretches they fall in."""

    class Map(dict):
        calls = 0
        iterator = dict.items

        def removeKey(self, k):
            self.calls += 1
            del self[k]

        def updateValue(self, k, v):
            self.calls += 1
            self[k] = v

    rng, hour = random.Random(1), 3600 * 10**6
    p = monitor._Failures("g", 2)
    p._state = Map()
    seen, watermark = [], -1
    for batch in range(4):
        new = [(batch * 500 * hour + rng.randrange(500) * hour, i, rng.random() < 0.3) for i in range(300)]
        seen += new
        count = p._fold(watermark, new)
        watermark = max(new)[0] - hour
        last = max((x[:2] for x in seen if not x[2]))
        assert count == sum(x[2] and x[:2] > last for x in seen)
    assert p._state.calls <= 40
    # a success at a failure's own place ends it, as one after it does
    assert p._fold(watermark, [(3000 * hour, 1, True), (3000 * hour, 1, False), (3000 * hour, 2, True)]) == 1
