"""Versions of a table, merges on buckets, and what merges do with null keys, ties and several details."""

import os
import re
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from filmloom.operators import extract, table, window
from filmloom.sources.snapshots import Conflict, Snapshots


@pytest.fixture
def rows(spark):
    def make(values, kind="k long, a string, b long"):
        return spark.createDataFrame(values, kind)

    return make


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_versions_in_turn(spark, rows, tmp_path):
    kept = Snapshots(spark, f"file://{tmp_path}/t")
    assert kept.version() == 0 and kept.versions() == []
    with pytest.raises(ValueError, match="nothing was published"):
        kept.read()
    assert kept.commit(rows([(1, "x", 1), (None, "y", 2)]), 0) == 1
    assert kept.merge(lambda now: table.upsert(now, rows([(1, "z", 3), (2, "w", 4)]), ["k"], ["b"])) == 2
    assert plain(kept.read()) == [(1, "z", 3), (2, "w", 4), (None, "y", 2)] and plain(kept.read(1)) == [(1, "x", 1), (None, "y", 2)]
    assert [kept.described(v)["rows"] for v in kept.versions()] == [2, 3] and kept.described(2)["parent"] == 1


def test_a_merge_that_fails_leaves_the_table(spark, rows, tmp_path):
    kept = Snapshots(spark, f"file://{tmp_path}/t")
    kept.commit(rows([(i, "x", i) for i in range(50)]).repartition(8), 0)
    before = plain(kept.read())
    with pytest.raises(PySparkException):
        kept.merge(lambda now: now.withColumn("b", F.when(F.col("b") == 33, F.raise_error(F.lit("gone")).cast("long")).otherwise(F.col("b") + 1)))
    assert kept.versions() == [1] and plain(kept.read()) == before
    # what it left is unnamed and goes with the next vacuum
    kept.commit(rows([(1, "new", 1)]), 1)
    assert kept.vacuum(keep=1, older_than=-1) >= 1 and kept.versions() == [2] and plain(kept.read()) == [(1, "new", 1)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_second_writer_is_refused(spark, rows, tmp_path):
    path = f"file://{tmp_path}/t"
    one, two = Snapshots(spark, path), Snapshots(spark, path)
    one.commit(rows([(1, "x", 1)]), 0)
    seen = two.version()
    one.commit(rows([(1, "one", 2)]), 1)
    with pytest.raises(Conflict):
        two.commit(rows([(1, "two", 2)]), seen)
    assert plain(two.read()) == [(1, "one", 2)]


def test_writer_that_loses_while_it_writes(spark, rows, tmp_path, monkeypatch):
    """Both start from version 1; the rival publishes between the slow writer's check and its rename."""
    path = f"file://{tmp_path}/t"
    slow, rival = Snapshots(spark, path), Snapshots(spark, path)
    slow.commit(rows([(1, "x", 1)]), 0)
    publish, calls = slow._publish, []

    def late(version, writer, commit):
        if not calls:
            calls.append(version)
            rival.commit(rows([(1, "rival", 5)]), 1)
        publish(version, writer, commit)

    monkeypatch.setattr(slow, "_publish", late)
    with pytest.raises(Conflict):
        slow.commit(rows([(1, "slow", 9)]), 1)
    assert plain(slow.read()) == [(1, "rival", 5)] and slow.versions() == [1, 2]
    # merge tries again on what the rival published
    calls.clear()
    monkeypatch.setattr(slow, "_publish", lambda *a: (calls or (calls.append(1), rival.commit(rival.read().withColumn("b", F.col("b") * 2), 2))) and publish(*a))
    assert slow.merge(lambda now: now.withColumn("b", F.col("b") + 1)) == 4
    assert plain(slow.read()) == [(1, "rival", 11)]


def moved_scans(df):
    """Scans of files that stand below an exchange of the physical plan."""
    found, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [x for x in above if x < depth]
        if re.match(r"[\s:+-]*(\*\(\d+\) )?Exchange ", line):
            above.append(depth)
        elif "FileScan" in line and above:
            found.append(line)
    return found


@pytest.mark.parametrize("merge", ["upsert", "insert_ignore", "replace_rows"])
def test_target_is_not_shuffled(spark, rows, tmp_path, merge):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        kept = Snapshots(spark, f"file://{tmp_path}/t", ("k",), 6)
        start = rows([(i, f"t{i}", i) for i in range(300)])
        kept.commit(start, 0)
        source = rows([(5, "s", 1), (5, "s2", 2), (500, "n", 3), (None, "null", 4)])
        step = {"upsert": lambda t: table.upsert(t, source, ["k"], ["b"]), "insert_ignore": lambda t: table.insert_ignore(t, source, ["k"], "b"), "replace_rows": lambda t: table.replace_rows(t, source, ["k"], "b")}[merge]
        assert not moved_scans(step(kept.read()))
        # the same merge moves a target without buckets
        start.write.parquet(f"file://{tmp_path}/plain")
        assert moved_scans(step(spark.read.parquet(f"file://{tmp_path}/plain")))
        kept.merge(step)
        assert plain(kept.read()) == plain(step(start))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_are_known_to_another_session(spark, rows, tmp_path):
    kept = Snapshots(spark, f"file://{tmp_path}/t", ("k", "a"), 3)
    kept.commit(rows([(i, "x", i) for i in range(20)] + [(None, "x", 7)]), 0)
    spark.sql(f"drop table {kept.described(1)['table']}")  # as a session that didn't write it
    found = Snapshots(spark, f"file://{tmp_path}/t").read()
    assert found.count() == 21 and "Bucketed: " in found.groupBy("k", "a").count()._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="buckets need keys"):
        Snapshots(spark, "x", ("k",))


def test_a_file_for_each_bucket(spark, rows, tmp_path):
    """A first load of many tasks, and a merge, write as many files as buckets; nothing is dealt twice."""
    kept = Snapshots(spark, f"file://{tmp_path}/t", ("k",), 4)
    kept.commit(rows([(i, "x", i) for i in range(200)]).repartition(16), 0)
    kept.merge(lambda now: table.upsert(now, rows([(i, "y", i) for i in range(190, 210)]), ["k"], ["b"]))
    for v in (1, 2):
        folder = kept.described(v)["folder"].removeprefix("file://")
        assert len([x for x in os.listdir(folder) if x.endswith(".parquet")]) == 4
    assert kept.read().count() == 210


def test_empty_version(spark, rows, tmp_path):
    for name, how in (("a", ((), 0)), ("b", (("k",), 2))):
        kept = Snapshots(spark, f"file://{tmp_path}/{name}", *how)
        kept.commit(rows([]), 0)
        assert kept.read().count() == 0 and kept.read().columns == ["k", "a", "b"]


# null keys, ties, details

T = [(1, "t1", 1), (None, "t0", 1), (None, "t0", 1), (3, "t3", 1)]
S = [(None, "s0", 5), (None, "s0", 5), (None, "s9", 4), (1, "s1", 5), (2, "s2", 5), (2, "older", 4)]


def test_null_keys_stand_apart(rows):
    t, s = rows(T), rows(S)
    nulls = [(None, "s0", 5)] * 2 + [(None, "s9", 4)]
    assert Counter(map(tuple, table.upsert(t, s, ["k"], ["b"]).collect())) == Counter([*T[1:], (1, "s1", 5), (2, "s2", 5), *nulls])
    assert Counter(map(tuple, table.insert_ignore(t, s, ["k"], "b").collect())) == Counter([*T, (2, "older", 4), *nulls])
    assert Counter(map(tuple, table.replace_rows(t, s, ["k"], "b").collect())) == Counter([*T[1:], (1, "s1", 5), (2, "s2", 5), *nulls])


def test_null_in_one_of_two_keys(rows):
    t, s = rows([(1, None, 1), (1, "a", 1)]), rows([(1, None, 2), (1, "a", 2), (None, "a", 3)])
    assert Counter(map(tuple, table.upsert(t, s, ["k", "a"], ["b"]).collect())) == Counter([(1, None, 1), (1, None, 2), (1, "a", 2), (None, "a", 3)])


def test_rows_of_nulls_alone_are_rows(rows):
    t, s = rows([(1, "x", 1)]), rows([(1, None, None), (2, None, None)])
    assert plain(table.upsert(t, s, ["k"], [])) == [(1, None, None), (2, None, None)]


@pytest.mark.parametrize("seed", range(4))
def test_ties_are_settled(rows, seed):
    values = [(1, "b", 1), (1, "a", 1), (1, "c", 1), (2, None, 1), (2, "x", 1)]
    frame = rows(values).repartition(4, F.rand(seed))
    assert plain(window.last_per_key(frame, ["k"], "b")) == [(1, "c", 1), (2, "x", 1)]
    assert plain(window.first_per_key(frame, ["k"], F.col("b"))) == [(1, "a", 1), (2, None, 1)]


def test_columns_without_an_order(spark):
    frame = spark.sql("select 1 as k, map('a', 1) as m, 2 as n union all select 1, map('b', 2), 3")
    assert window.last_per_key(frame, ["k"], "n").first().m == {"b": 2} and window.tie_breakers(frame, "k") == ["n"]


def test_details_are_one_row(rows):
    """(z, a) and (b, y): never (z, y)."""
    details = rows([(1, "z", 1), (1, "b", 9)])
    target = rows([(1, None, None), (2, "own", 7)])
    assert plain(table.fill_missing(target, details, "k", ["a", "b"])) == [(1, "z", 1, True), (2, "own", 7, False)]
    assert plain(extract.merge_detail(target, details, "k", ["a", "b"])) == [(1, "z", 1), (2, "own", 7)]
    ordered = details.withColumn("at", F.when(F.col("a") == "b", 2).otherwise(1))
    assert plain(table.fill_missing(target, ordered, "k", ["a", "b"], "at"))[0] == (1, "b", 9, True)
    assert plain(extract.merge_detail(target, ordered, "k", ["a", "b"], "at"))[0] == (1, "b", 9)


def test_details_with_gaps_are_applied_in_turn(rows):
    """What the last detail leaves open comes from the one before it."""
    details = rows([(1, "first", 1), (1, "", 2)]).withColumn("at", F.col("b"))
    assert plain(table.fill_missing(rows([(1, "old", 0)]), details, "k", ["a", "b"], "at")) == [(1, "first", 2, True)]
