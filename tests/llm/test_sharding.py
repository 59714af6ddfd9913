import bisect
import hashlib
import random
import zlib

import pytest

from shelfwise.llm import sharding

SCHEMA = "doc_id long, text string, size string, key string"


def smallest(sizes, shards):
    """The least capacity, by trying all of them in a plain binary search over whole lists."""
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        c = (low + high) // 2
        used, room = 1, c
        for s in sizes:
            if s > room:
                used, room = used + 1, c
            room -= s
        low, high = (low, c) if used <= shards else (c + 1, high)
    return low


class Line:
    """A line of groups that answers the doubts of ``Ends`` from a list."""

    def __init__(self, sizes, bins):
        self.ends, self.bins, self.jobs, t = [], bins, 0, 0
        for s in sizes:
            t += s
            self.ends.append(t)

    def ask(self, ends):
        self.jobs += 1
        windows, width = ends.windows(self.bins)
        assert windows and len(windows) < 100 and self.jobs < 200
        slices = {}
        for e in self.ends:
            for i, (a, b) in enumerate(windows):
                if a < e < b:
                    slices.setdefault((i, e // width), []).append(e)
        ends.learn(windows, [(min(v), max(v), len(v)) for v in slices.values()])


@pytest.mark.parametrize("seed", range(60))
def test_capacity_and_cuts_equal_brute_force(seed):
    rnd = random.Random(seed)
    n = rnd.choice([1, 2, 10, 50, 400, 3000])
    sizes = [rnd.choice([1, 1, 2, rnd.randint(1, 5000), 10 ** rnd.randint(1, 6) if rnd.random() < 0.05 else 3]) for _ in range(n)]
    if rnd.random() < 0.3:
        sizes[rnd.randrange(n)] = sum(sizes) // 2 + 1
    shards, line = rnd.choice([1, 2, 5, 16]), Line(sizes, rnd.choice([8, 64, 1000]))
    ends = sharding.Ends(line.ends[-1], n)
    capacity = sharding.smallest_capacity(ends, max(sizes), shards, line.ask)
    assert capacity == smallest(sizes, shards)
    cuts = sharding.even_cuts(ends, capacity, shards, line.ask)
    assert len(cuts) == shards and cuts[-1] == line.ends[-1] and set(cuts) <= {0, *line.ends}
    assert all(0 <= b - a <= capacity for a, b in zip([0, *cuts], cuts))


@pytest.mark.parametrize("hot", [None, 0, 40_000, 99_999])
def test_few_jobs_on_a_long_line(hot):
    sizes = [random.Random(i).randint(1, 2000) for i in range(100_000)]
    if hot is not None:
        sizes[hot] = sum(sizes) // 2
    line = Line(sizes, 500)
    ends = sharding.Ends(line.ends[-1], len(sizes))
    sharding.even_cuts(ends, sharding.smallest_capacity(ends, max(sizes), 16, line.ask), 16, line.ask)
    assert line.jobs <= 20 and len(ends.at) < 20 * 1500, (line.jobs, len(ends.at))


def check(rows, got, shards):
    """Groups whole, sizes minimax over the order of the texts' MD5, slots gapless in that order."""
    assert sorted(r["doc_id"] or -1 for r in got) == sorted(i or -1 for i, *_ in rows)
    groups = {}
    for i, text, *_ in rows:
        groups.setdefault(text or "", []).append(i)
    order = sorted(groups, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    size = {t: len(t.encode()) + 1 for t in order}
    shard_of = {}
    by_crc = {zlib.crc32(t.encode()): t for t in order}
    for r in got:
        t = by_crc[r["text_crc32"]]
        assert r["size"] == size[t] and shard_of.setdefault(t, r["shard"]) == r["shard"]
    assert [shard_of[t] for t in order] == sorted(shard_of.values())
    total = [sum(size[t] * len(groups[t]) for t in order if shard_of[t] == k) for k in range(shards)]
    assert max(total) == smallest([size[t] * len(groups[t]) for t in order], shards)
    for k in range(shards):
        wanted = [i for t in order if shard_of[t] == k
                  for i in sorted(groups[t], key=lambda i: hashlib.md5(str("" if i is None else i).encode()).hexdigest())]
        placed = sorted((r["slot"], r["doc_id"]) for r in got if r["shard"] == k)
        assert placed == list(enumerate(wanted))


@pytest.mark.parametrize("cell_rows,bins", [(5000, 1 << 14), (7, 9)])
def test_assign(spark, frame, monkeypatch, cell_rows, bins):
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    rnd = random.Random(3)
    rows = [(i, "ä" * rnd.randint(0, 90) + str(rnd.randint(0, 250)), "x", "y") for i in range(600)]
    rows += [(1000 + i, "the hot text", None, None) for i in range(300)]
    rows += [(2000, None, "x", "y"), (2001, "", "x", "y"), (2002, "long " * 3000, "x", "y")]
    got = sharding.assign(frame(rows, SCHEMA), 5, bins=bins)
    assert got.columns == ["doc_id", "key", "size", "text_crc32", "shard", "slot"]  # ``size`` gives way to the result
    got = got.collect()
    check(rows, got, 5)
    assert sorted(map(tuple, got)) == sorted(map(tuple, sharding.assign(frame(rows[::-1], SCHEMA, 5), 5).collect()))


def test_repeats_nulls_and_little(spark, frame):
    schema = "doc_id long, text string"
    assert sharding.assign(frame([], schema)).collect() == []
    one = sharding.assign(frame([(None, None)], schema)).collect()
    assert [tuple(r) for r in one] == [(None, 1, 0, one[0]["shard"], 0)]
    twice = sharding.assign(frame([(7, "a"), (7, "a"), (None, "b")], schema), 2).collect()
    assert sorted((r["doc_id"] or 0, r["slot"]) for r in twice) == [(0, 0), (7, 0), (7, 1)]


def test_written_shards(spark, frame, scratch):
    rows = [(i, "t" * (i % 40), i % 3) for i in range(200)]
    path = f"{scratch}/shards"
    sharding.write_shards(frame(rows, "doc_id long, text string, k int"), path, 4)
    back = spark.read.parquet(path).collect()
    assert sorted((r["doc_id"], r["text"], r["k"]) for r in back) == rows
    for k in range(4):
        slots = sorted(r["slot"] for r in back if r["shard"] == k)
        assert slots == list(range(len(slots)))
