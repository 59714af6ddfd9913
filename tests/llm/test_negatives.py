import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import negatives
from tests.llm.conftest import rows_of
from tests.llm.test_topk_polytope import ODD, SCHEMA, usable, vectors

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(rows):
    """By comparing every anchor with every row."""
    live = {}
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v and usable(v):
            live[i] = min(live.get(i, (label, v)), (label, v))
    live = {i: (label, [math.floor(256.0 * x) for x in v]) for i, (label, v) in live.items()}
    out = []
    for a, (label, x) in live.items():
        if a % 20:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (other, y) in live.items() if i != a and len(x) == len(y))
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            fit = [(i, -t) for t, i, other in scored if other != label and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(a, p, n + 1, i, -s, t) for n, (i, t) in enumerate(fit)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(2048, 8, 2048, 256, 8), (16, 2, 4, 3, 5)])
def test_equals_brute_force(spark, frame, monkeypatch, sizes):
    for name, value in zip(("ROWS", "BLOCKS", "ANCHORS", "AT_ONCE", "LISTS"), sizes):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(400) + ODD
    rows += [(i + 3000, v, (y + 1) % 3, "copy") for i, v, y, _ in rows[:60] if v]  # equal scores in other labels
    rows += [(20, [0.5] * 12, 2, "again"), (40, rows[40][1], rows[40][2], "twice")]
    got = rows_of(negatives.mine(frame(rows, SCHEMA), F.expr("id % 20 = 0")), *COLUMNS)
    assert got == mined(rows) and len(got) > 100


def test_huge_few_and_none(spark, frame):
    rows = [(0, [3e6, -3e6], 0, ""), (1, [3e6, 3e6], 0, ""), (2, [2e6, -1.0], 0, ""), (3, [1.9e6, -2.0], 1, ""),
            (4, [1.8e6, 1.0], 1, ""), (20, [1.0, 0.0], 5, ""), (40, [0.0, 0.0], 0, ""), (60, [-1.0, 0.0], 1, "")]
    assert rows_of(negatives.mine(frame(rows, SCHEMA), F.expr("id % 20 = 0")), *COLUMNS) == mined(rows)
    assert negatives.mine(frame([], SCHEMA), F.expr("id % 20 = 0")).collect() == []


def test_index_leaves_out_only_what_cannot_reach():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(500, 24)) * 40 / np.arange(1, 25))
    a = x[:50] + 1
    index = negatives.Index(np.arange(500), np.zeros(500, int), x)
    everything = a @ x.T
    for t in (-1e6, 0.0, 800.0, float(np.sort(everything.ravel())[-200])):
        got = {(i, j): s for q, r, score in index.join(a, np.full(50, t)) for i, j, s in zip(q, r, score)}
        wanted = {(i, j): everything[i, j] for i, j in zip(*np.nonzero(everything >= t))}
        assert wanted.items() <= got.items()


def test_clashing_columns(spark, frame):
    rows = [(i, v, y, "x") for i, v, y, _ in vectors(100)]
    plain = negatives.mine(frame(rows, SCHEMA), F.expr("id % 20 = 0"))
    names = ["id", "own", "dim", "v", "block", "unit", "part", "score", "tag"]
    wide = frame(rows, SCHEMA).select("*", *[F.lit("y").alias(c) for c in names if c not in ("label",)])
    assert rows_of(negatives.mine(wide, F.expr("id % 20 = 0")), *COLUMNS) == rows_of(plain, *COLUMNS)
