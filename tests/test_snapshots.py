import itertools
import os

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import publish, snapshots, storage
from shelfwise.streaming import incremental

SCHEMA = "id long, v string, _version long, _deleted boolean"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plain(spark, root, name, n):
    path = storage.join(publish.new_staging(spark, root), name)
    publish.write_table(spark.range(n), path)
    return path


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_interleaved_publishers_lose_nothing(spark, scratch, scheme):
    root = scheme + os.path.join(scratch, "snap")
    publish.publish(spark, root, {"a": plain(spark, root, "a", 1), "b": plain(spark, root, "b", 1)})
    first, second = snapshots.read(spark, root), snapshots.read(spark, root)  # both start from version 1
    publish.publish(spark, root, {"a": plain(spark, root, "a", 2)}, first)
    publish.publish(spark, root, {"b": plain(spark, root, "b", 3)}, second)
    live = publish.read_snapshot(spark, root)
    assert (live["a"].count(), live["b"].count(), snapshots.read(spark, root).version) == (2, 3, 3)
    with pytest.raises(snapshots.Conflict):
        publish.publish(spark, root, {"a": plain(spark, root, "a", 9)}, second)
    assert publish.read_snapshot(spark, root)["a"].count() == 2
    assert publish.read_snapshot(spark, root, version=1)["b"].count() == 1  # older versions stay readable


def test_the_same_number_is_taken_once(spark, scratch):
    path = os.path.join(scratch, "log", "1.json")
    storage.make_dirs(spark, os.path.dirname(path))
    assert storage.create_text(spark, path, "one") and not storage.create_text(spark, path, "two")
    assert storage.read_text(spark, path) == "one" and storage.list_names(spark, os.path.dirname(path)) == ["1.json"]


DELTAS = [
    [(1, "one 2", 2, False), (5, "five 2", 2, False), (5, "five 2b", 2, False)],
    [(1, "one 3", 3, False), (2, None, 4, True)],
    [(2, "two 3", 3, False), (90, "new", 1, False)],
    [(3, None, 2, True), (5, None, 2, True), (7, None, 9, True)],
    [(3, "three 5", 5, False), (7, "seven 8", 8, False), (None, "no key", 1, False)],
]
FINAL = [(1, "one 3"), (3, "three 5"), (4, "four"), (90, "new")]


def test_versions_win_in_any_order(spark):
    start = spark.createDataFrame([(i, w, 1, False) for i, w in enumerate(["one", "two", "three", "four", "five"], 1)], SCHEMA)
    for order in list(itertools.permutations(range(4)))[::5]:
        table = start
        for i in [*order, order[0], 4, order[-1]]:  # some twice
            table = snapshots.merge_versions(table, spark.createDataFrame(DELTAS[i], SCHEMA), "id")
        assert [r for r in rows(snapshots.live_rows(table).filter("id is not null"))] == FINAL


def test_a_delta_rewrites_only_its_ranges(spark, scratch):
    root = os.path.join(scratch, "snap")
    start = spark.range(1000).select("id", F.lit("old").alias("v"), F.lit(1).cast("long").alias("_version"), F.lit(False).alias("_deleted"))
    before = snapshots.create_ranged(spark, root, "t", start, "id", rows_per_range=50).tables["t"]
    assert len(before["ranges"]) == 20
    delta = snapshots.versioned(spark.range(120, 130).select("id", F.lit("new").alias("v")), F.lit(2).cast("long"),
                                spark.createDataFrame([(125, 3), (5000, 3)], "id long, _version long"))
    after = snapshots.merge_ranged(spark, root, "t", delta).tables["t"]
    assert {r for r in after["ranges"] if after["ranges"][r] != before["ranges"].get(r)} == {"2", "100"}
    wanted = sorted((i, "new" if 120 <= i < 130 else "old") for i in range(1000) if i != 125)
    assert rows(publish.read_snapshot(spark, root)["t"]) == wanted
    rebuilt = snapshots.merge_versions(start, delta, "id")
    assert rows(snapshots.live_rows(rebuilt)) == wanted
    again = snapshots.merge_ranged(spark, root, "t", delta)
    assert rows(snapshots.table(spark, again.tables["t"])) == wanted
    late = snapshots.versioned(spark.createDataFrame([(125, "late"), (126, "late")], "id long, v string"), F.lit(1).cast("long"))
    assert rows(snapshots.table(spark, snapshots.merge_ranged(spark, root, "t", late).tables["t"])) == wanted


def test_merges_of_other_ranges_do_not_conflict(spark, scratch, monkeypatch):
    root = os.path.join(scratch, "snap")
    start = snapshots.versioned(spark.range(100).select("id", F.lit("old").alias("v")), F.lit(1).cast("long"))
    snapshots.create_ranged(spark, root, "t", start, "id", rows_per_range=10)
    delta = lambda i, v, n: spark.createDataFrame([(i, v, n, False)], SCHEMA)
    real, between = snapshots._write_ranges, [delta(55, "other range", 2), delta(7, "same range, newer", 9)]

    def slow(*args):
        out = real(*args)
        if between:  # another publisher commits while this one still writes
            snapshots.merge_ranged(spark, root, "t", between.pop(0))
        return out

    monkeypatch.setattr(snapshots, "_write_ranges", slow)
    snapshots.merge_ranged(spark, root, "t", delta(7, "mine", 5))
    got = dict(rows(publish.read_snapshot(spark, root)["t"]))
    assert got[55] == "other range" and got[7] == "same range, newer" and len(got) == 100


def test_expiry_keeps_what_is_referred_to(spark, scratch):
    root = os.path.join(scratch, "snap")
    a = plain(spark, root, "a", 1)
    publish.publish(spark, root, {"a": a})
    for n in (2, 3, 4):
        publish.publish(spark, root, {"b": plain(spark, root, "b", n)}, snapshots.read(spark, root))
    gone = snapshots.expire(spark, root, keep=2)
    assert len(gone) == 1 and snapshots.versions(spark, root) == [3, 4]
    assert publish.read_snapshot(spark, root, version=3)["b"].count() == 3
    assert publish.read_snapshot(spark, root)["a"].count() == 1


def test_stream_ignores_a_late_version(spark, scratch):
    root, landing = os.path.join(scratch, "snap"), os.path.join(scratch, "landing")
    for n, rows_ in enumerate([[(1, "new", 5)], [(1, "late", 3), (2, "two", 1)]]):
        spark.createDataFrame(rows_, "id long, v string, ts long").write.parquet(os.path.join(landing, str(n)))
        incremental.start_upsert_stream(spark, landing + "/*", "id long, v string, ts long", root, "t", "id",
                                        os.path.join(scratch, "ckpt"), order_col="ts").awaitTermination()
    assert rows(publish.read_snapshot(spark, root)["t"]) == [(1, "new", 5), (2, "two", 1)]
