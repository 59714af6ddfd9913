import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import polytope, topk
from tests.llm.conftest import rows_of

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def vectors(n=240, dim=12, seed=5):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i % 3 and out:
            base = np.array(out[rng.integers(len(out))][1])
            v = base + rng.normal(size=dim) * rng.choice([0, 0.02, 0.1, 0.3]) * np.abs(base).max()
        else:
            v = rng.normal(size=dim)
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3)), "x"))
    return out


ODD = [(1000, None, 1, "x"), (1100, [1.0, None] + [0.0] * 10, 1, "x"), (1200, [math.nan] * 12, 1, "x"),
       (1300, [math.inf] * 12, 1, "x"), (1400, [0.0] * 12, 1, "x"), (1500, [1.0, 2.0], 1, "x"), (None, [1.0] * 12, 1, "x"),
       (1600, [1.0] * 12, None, "x"), (1700, [], 1, "x")]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def exact_top(rows, k):
    live = {i: [math.floor(1024.0 * x) for x in v] for i, v, *_ in rows if i is not None and usable(v)}
    out = []
    for q, a in live.items():
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in live.items() if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("blocks", [(4096, 2048), (16, 2)])
def test_top_k_is_exact(spark, frame, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rows = vectors() + ODD + [(100, vectors()[100][1], 0, "again"), (200, vectors()[3][1], 1, "tie"), (300, vectors()[3][1], 1, "tie")]
    once = {}
    for i, v, *_ in rows:  # the least vector of an id counts
        if usable(v) and (i not in once or v < once[i]):
            once[i] = v
    got = topk.top_k(frame(rows, SCHEMA), F.col("id") % 100 == 0)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == exact_top([(i, v) for i, v in once.items()], 10)


def test_top_k_few_and_huge(spark, frame):
    big = [(0, [3e6, -3e6], 0, ""), (1, [3e6, 3e6], 0, ""), (2, [2e6, -1.0], 0, "")]
    assert rows_of(topk.top_k(frame(big, SCHEMA), F.col("id") % 100 == 0), "query_id", "rank", "vec_id", "score") == exact_top(big, 10)
    assert topk.top_k(frame(big[:1], SCHEMA), F.col("id") % 100 == 0).count() == 0
    assert topk.top_k(frame([], SCHEMA), F.col("id") % 100 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, x = rng.integers(-500, 500, (20, 24)).astype(float), rng.integers(-500, 500, (30, 24)).astype(float)
    last = np.full((20, 30), np.inf)
    for s in topk.levels(24):
        bound = topk.statistics(q, s) @ topk.statistics(x, s).T
        assert (bound >= q @ x.T - 1e-6).all()
        last = bound
    assert (last - q @ x.T).mean() < (topk.statistics(q, 1) @ topk.statistics(x, 1).T - q @ x.T).mean()


def brute_links(rows, threshold=0.93):
    once = {}
    for i, v, label, *_ in rows:
        key = (label is not None, label if label is not None else 0, v is not None, v or [])
        if i not in once or key < once[i][0]:
            once[i] = (key, v, label)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, (_, v, label) in once.items()
            if i is not None and label is not None and usable(v) and any(v)}
    links = {i: [] for i in once}
    for i in unit:
        for j in unit:
            if i < j and once[i][2] == once[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i].append(j)
                links[j].append(i)
    out = []
    for i in once:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = i if i is None else min(seen)
        out.append((i, len(links[i]), least, i is not None and least == i))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [2048, 4])
def test_links_equal_brute_force(spark, frame, monkeypatch, tile):
    monkeypatch.setattr(polytope, "TILE", tile)
    monkeypatch.setattr(polytope, "SMALL", min(tile, polytope.SMALL))
    plain = vectors()
    rows = plain + ODD + [plain[7], (2000, plain[9][1], plain[9][2], "copy"), (2001, plain[9][1], plain[9][2], "copy")]
    got = polytope.link(frame(rows, SCHEMA))
    assert rows_of(got, "vec_id", "n_links", "component_id", "kept") == brute_links(rows)


def test_links_of_an_empty_table(spark, frame):
    assert polytope.link(frame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("dim", [16, 64, 100])
def test_recall_at_the_threshold(dim):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(2, 4000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    keys = [polytope.bucket_keys(v) for v in (a, 0.9301 * a + math.sqrt(1 - 0.9301 ** 2) * b)]
    assert (keys[0][:, :, None] == keys[1][:, None, :]).any((1, 2)).mean() > 0.99


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 32))
    assert np.allclose(polytope.hadamard(x) @ polytope.hadamard(x).T, x @ x.T)
