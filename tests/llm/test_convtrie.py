import hashlib
import random
import zlib

import numpy as np
import pytest

from shelfwise.llm import convtrie
from tests.llm.conftest import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth long, piece string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def built(rows, group, heads):
    """The nodes by walking every prefix of every conversation."""
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", md5(text or ""), text or ""))
    own = {c: [(r, t) for *_, r, _, t in sorted(turns)] for c, turns in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        convs[c] = own.get(c - c % group, [])[:h] + turns[h:]
    members, children = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    out = []
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[b] for b in below) or 1
        saved[p] = sum(saved[b] for b in below) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(p))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def talks(n, seed=1):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.choice([1, 2, 3, 7, 12])):
            text = rnd.choice(["hi", "ho", "hü", "", None]) if rnd.random() < 0.7 else f"x{rnd.random()}"
            rows.append((c, t if rnd.random() < 0.95 else None, rnd.choice(["user", "assistant", None]), text, "n", 1, "p"))
    return rows


ODD = [(None, 1, "user", "x", "", 0, ""), (5000, None, None, None, "", 0, ""), (5000, 1, "a", "b", "", 0, ""), (5000, 1, "a", "b", "", 0, ""),
       (5000, 1, "a", "a", "", 0, ""), (-7, 3, "u", "hi", "", 0, ""), (-7, 2, "u", "long " * 4000, "", 0, ""), (10 ** 15, 0, "u", "hi", "", 0, "")]


@pytest.mark.parametrize("in_task,turns,piece", [(1 << 15, 512, 512), (40, 3, 4)])
def test_equals_brute_force(spark, frame, monkeypatch, in_task, turns, piece):
    for name, value in (("IN_TASK", in_task), ("TURNS", turns), ("PIECE", piece)):
        monkeypatch.setattr(convtrie, name, value)
    rows = talks(60) + ODD + [(c, t, "user", f"same {t}", "", 0, "") for c in range(600, 640) for t in range(4)]
    for group, heads in ((5, 9), (1, 1)):
        got = convtrie.trie_of(frame(rows, SCHEMA), group, heads)
        assert rows_of(got, *COLUMNS) == built(rows, group, heads)


def test_deep(spark, frame, monkeypatch):
    monkeypatch.setattr(convtrie, "IN_TASK", 300)
    monkeypatch.setattr(convtrie, "TURNS", 50)
    rows = [(c, t, "u", f"t{t}" if t < 30 + 90 * c else f"own {c} {t}", "", 0, "") for c in range(4) for t in range(300)]
    assert rows_of(convtrie.trie_of(frame(rows, SCHEMA)), *COLUMNS) == built(rows, 1, 1)


def test_empty(spark, frame):
    assert convtrie.trie_of(frame([], SCHEMA), 5, 9).collect() == []
    assert convtrie.trie_of(frame([(None, 1, "u", "t", "", 0, "")], SCHEMA), 5, 9).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_decompose(seed):
    rnd = random.Random(seed)
    n = rnd.choice([1, 2, 30, 500])
    parent = np.array([-1] + [rnd.choice([-1] + [i - 1] * 4 + [rnd.randrange(i)]) if i > 1 else 0 for i in range(1, n)])
    values = np.array([[rnd.randrange(9), rnd.randrange(1000)] for _ in range(n)])
    weight, wanted = np.array([rnd.randint(1, 5) for _ in range(n)]), values.copy()
    for i in range(n - 1, 0, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            wanted[parent[i]] += wanted[i]
    assert (convtrie.decompose(parent, weight, values) == wanted).all()
