import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import common, linededup, mixing, ngramjoin
from tests.llm.conftest import rows_of

DOCS = "doc_id long, text string, source string, keys string, id long, kept long, nth int, component long, size string, key string"
ROWS = [(i, f"a line that is long enough to count\nline {i % 7} of the text", f"s{i % 2}", "k", i, i, 1, i, "x", "y") for i in range(40)]


def test_columns_of_any_name_stay(spark, frame):
    rows = frame(ROWS, DOCS)
    kept = linededup.drop_lines(rows)
    assert kept.columns == [*rows.columns, "n_lines", "n_dropped"]
    assert rows_of(kept, "doc_id", "keys", "id") == sorted(((r[0], "k", r[0]) for r in ROWS), key=repr)
    one = ngramjoin.representatives(rows)
    assert one.columns == rows.columns and rows_of(one, "doc_id", "id") == [(i, i) for i in range(7)]
    mixed = mixing.mix(rows)
    assert mixed.columns == rows.columns and {r["id"] for r in mixed.collect()} <= set(range(40))


class Far:
    """A session of a cluster without a checkpoint folder."""

    class conf:  # noqa: N801
        get = staticmethod(lambda key, default: default)

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"


def test_no_scratch_of_one_machine_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.scratch_root(Far)
    Far.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.scratch_root(Far)


def test_scratch_is_the_named_folder(spark):
    assert common.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert common.checkpointed(spark.range(3).select(F.col("id"))).count() == 3


def test_words_end_at_spaces_and_text_ends():
    texts = ["", "a b", "b", None, " \tc  dd\n", "e", "éf G", "   "]
    words = common.Words(pa.array(texts))
    got, start = [], 0
    for end in words.ends.tolist():
        got.append([words.vocab[c].decode() for c in words.codes[start:end].tolist()])
        start = end
    assert got == [[], ["a", "b"], ["b"], [], ["c", "dd"], ["e"], ["éf", "g"], []]
    assert len(common.Words(pa.array(["", "  "])).codes) == 0


def test_the_shingles_of_a_block_take_little_memory():
    """The working arrays of a block of texts stay small beside its sets, however many texts it holds."""
    texts = pa.array([" ".join(f"w{i * 7919 % 9973}" for i in range(k, k + 3000)) for k in range(0, 1_200_000, 1500)])

    def peak(f):
        tracemalloc.start()
        try:
            return f(), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    sets, most = peak(lambda: ngramjoin.shingle_sets(texts, 5))
    size = sum(s.nbytes for s in sets)
    assert most < size + (40 << 20)
    keys, most = peak(lambda: ngramjoin.part_keys(sets, (4, 5), np.zeros(ngramjoin.CELLS, bool)))
    assert most < 3 * sum(k.nbytes for k in keys) + (40 << 20)


def test_sets_and_parts_do_not_depend_on_what_is_held_at_once(monkeypatch):
    texts = pa.array([None, "", "one", "a b"] + [" ".join(f"w{i * k % 97}" for i in range(k)) for k in range(3, 90)])
    common_cells = np.zeros(ngramjoin.CELLS, bool)

    def found():
        sets = ngramjoin.shingle_sets(texts, 3)
        keys, places = ngramjoin.part_keys(sets, (9, 10), common_cells)
        return [s.tolist() for s in sets], sorted(zip(keys.tolist(), places.tolist()))

    whole = found()
    monkeypatch.setattr(ngramjoin, "AT_ONCE", 100)
    monkeypatch.setattr(ngramjoin, "SHINGLES_AT_ONCE", 50)
    assert found() == whole


def test_a_task_gives_back_what_it_freed(monkeypatch):
    told = []
    monkeypatch.setattr(common, "give_back", lambda: told.append("given back"))

    def run(batches):
        for b in batches:
            told.append(len(b))
            yield b
        told.append("end")

    batches = [pa.RecordBatch.from_pydict({"x": list(range(n))}) for n in (3, 0, 2)]
    assert list(common.tidy(run)(iter(batches))) == batches
    assert told == [3, 0, 2, "end", "given back"]
