import hashlib
import math
import re
import time
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path
from urllib.parse import urlparse

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import components, lmscore, linededup, mixing, ngramjoin, urlfilter
from shelfwise.llm import queries as llm_queries
from shelfwise.llm.common import crc_fold, pack_sorted, planes, scratch_root
from tests.llm.conftest import rows_of

SPACE = "[^\\x20\\x09-\\x0D]+"


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


# ------------------------------------------------------------------ n-gram join
def make_docs(n=160, seed=2, vocab=400):
    rng = np.random.default_rng(seed)
    hot = [f"hot{i}" for i in range(30)]
    out = []
    for i in range(n):
        if i % 4 and out:
            text = (out[rng.integers(len(out))][1] or "").split(" ")
            for _ in range(int(rng.integers(0, 4))):
                text[int(rng.integers(len(text)))] = f"New{rng.integers(10 ** 6)}"
        else:
            text = [f"w{rng.integers(vocab)}" for _ in range(int(rng.integers(1, 120)))]
            if i % 8 == 0:
                text = hot + text
        out.append((i, " ".join(text), "x", "src"))
    return out


EDGE = [(900, None, "x", "s"), (901, "", "x", "s"), (902, " \n\t ", "x", "s"), (903, "one", "x", "s"), (904, "ONE ", "x", "s"),
        (905, "one two", "x", "s"), (906, "One\ttwo", "x", "s"), (None, "w1 w2 w3 w4 w5 w6", "x", "s"), (907, "é" * 50_000 + " b c d e f", "x", "s"),
        (908, " ".join(f"L{i}" for i in range(20_000)), "x", "s"), (909, " ".join(f"l{i}" for i in range(19_900)), "x", "s")]
SCHEMA = "doc_id long, text string, component_id string, source string"


def brute_classes(rows, size, p, q):
    sets = []
    for i, t, *_ in rows:
        w = words(t)
        sets.append((i, {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())))
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if i is not None and j is not None and s and t and q * len(s & t) >= p * len(s | t):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i) if s else find(i)) for i, s in sets), key=repr)


@pytest.mark.parametrize("size,similarity,tile", [(3, (9, 10), 1024), (5, (4, 5), 1024), (2, (1, 2), 8), (3, (9, 10), 4)])
def test_classes_equal_brute_force(spark, frame, monkeypatch, size, similarity, tile):
    monkeypatch.setattr(ngramjoin, "TILE", tile)
    rows = make_docs() + EDGE + [make_docs()[5]]
    got = ngramjoin.classes(frame(rows, SCHEMA), size, similarity)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == brute_classes(rows, size, *similarity)


def test_rows_of_one_id_are_one_document(spark, frame):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(5, a, "", ""), (5, b, "", ""), (7, a, "", ""), (3, b, "", "")]
    got = rows_of(ngramjoin.classes(frame(rows, SCHEMA)), "doc_id", "component_id")
    assert got == [(3, 3), (5, 3), (5, 3), (7, 3)]
    assert rows_of(ngramjoin.representatives(frame(rows, SCHEMA)), "doc_id", "text") == [(3, b)]


def test_pairs_of_tiles_in_turns_find_the_same_classes(spark, frame, monkeypatch):
    monkeypatch.setattr(ngramjoin, "TILE", 4)
    rows = make_docs()
    whole = rows_of(ngramjoin.classes(frame(rows, SCHEMA), 3, (9, 10)), "doc_id", "component_id")
    turns, link = [], ngramjoin._link_tiles
    monkeypatch.setattr(ngramjoin, "_link_tiles", lambda *a: turns.append(1) or link(*a))
    monkeypatch.setattr(ngramjoin, "TURN_CHARS", 1)
    assert rows_of(ngramjoin.classes(frame(rows, SCHEMA), 3, (9, 10)), "doc_id", "component_id") == whole
    assert len(turns) > 3


def test_classes_of_an_empty_table(spark, frame):
    assert ngramjoin.classes(frame([], SCHEMA)).count() == 0
    assert ngramjoin.representatives(frame([], SCHEMA)).count() == 0


def test_parts_lose_no_pair():
    rng = np.random.default_rng(0)
    common = np.zeros(ngramjoin.CELLS, bool)
    for n in (8, 9, 19, 20, 21, 57, 300, 1000):
        for p, q in ((9, 10), (4, 5), (1, 2)):
            a = rng.integers(0, 2 ** 63, n).astype(np.uint64)
            for _ in range(10):
                # The most that may differ: some shingles gone, others new.
                out = int(rng.integers(0, n * (q - p) // q + 1))
                new = 0
                while (n - out) * q >= p * (n + new + 1):
                    new += 1
                b = np.unique(np.concatenate([rng.permutation(a)[out:], rng.integers(0, 2 ** 63, new).astype(np.uint64)]))
                keys, places = ngramjoin.part_keys([np.unique(a), b], (p, q), common)
                assert set(keys[places == 0]) & set(keys[places == 1]), (n, p, q, out, new)


def test_tree_bounds_are_safe():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 400, int(rng.integers(1, 90))).astype(np.uint64)) for _ in range(120)]
    pairs = {tuple(sorted(x)) for a, b in ngramjoin.CountTree(sets).pairs((1, 2)) for x in zip(a.tolist(), b.tolist())}
    for i in range(120):
        for j in range(i):
            x = len(np.intersect1d(sets[i], sets[j]))
            if 2 * x >= len(sets[i]) + len(sets[j]) - x:
                assert (j, i) in pairs


def test_components(spark, frame):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(300 + i, 301 + i) for i in range(40)] + [(7, 7)]
    root = {n: n for e in edges for n in e}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = dict(rows_of(components.connected(frame(edges, "a long, b long")), "node", "root"))
    assert got == {n: find(n) for n in root if find(n) != n}
    assert components.connected(frame([], "a long, b long")).count() == 0


def test_rounds_leave_one_table_and_no_shuffle_files(spark, frame):
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f.rsplit("/", 1)[-1] for f in files if f.endswith(".data")}

    folder = Path(urlparse(scratch_root(spark)).path)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    tables, before = set(folder.glob("llm-edges-*")), shuffles()
    assert components.connected(edges).count() == 60
    left = [t for t in folder.glob("llm-edges-*") if t not in tables]
    assert len(left) == 1
    until = time.time() + 20
    while len(shuffles() - before) > 4 and time.time() < until:  # the count above leaves the files of its four tasks
        time.sleep(0.2)
    assert len(shuffles() - before) <= 4


# ------------------------------------------------------------------ line dedup
def test_lines_equal_sql(spark, frame):
    long = ["A line that many documents share ", "  a LINE that many documents share", "x" * 19, "é" * 20, "É" * 20, "Ünïcode line of twenty cp"]
    rng = np.random.default_rng(6)
    rows = [(i, "\n".join(str(rng.choice(long + ["", " ", f"own line number {i} of it"])) for _ in range(int(rng.integers(0, 7)))), "n")
            for i in range(60)]
    rows += [(100, None, "n"), (101, "", "n"), (102, "\n\n", "n"), (103, "A line that many documents share\r\n" * 3 + "\x0b", "n"),
             (104, "y" * 200_000 + "\n" + long[0], "n")]
    got = rows_of(linededup.drop_lines(frame(rows, "doc_id long, text string, n_lines string"))
                  .select("doc_id", "n_lines", "n_dropped", F.coalesce("text", F.lit("")).alias("text")),
                  "doc_id", "n_lines", "n_dropped", "text")
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?)", [r[:2] for r in rows])
    want = con.execute(f"WITH {llm_queries.line_dedup_sql('d')} SELECT doc_id, n_lines, n_dropped, text FROM kept").fetchall()
    assert got == sorted(want, key=repr) and sum(r[2] for r in got) > 50


@pytest.mark.parametrize("bits", [1 << 12, 1 << 20])
def test_lines_ties_nulls_and_full_filters(spark, frame, bits):
    line = "the same long line here"
    rows = [(1, line), (1, line), (2, line), (None, line), (3, "other\n" + line), (None, None)]
    got = linededup.drop_lines(frame(rows, "doc_id long, text string"), bits=bits)
    # Two rows of document 1 are one document; the null row counts for nothing and stays whole.
    assert rows_of(got, "doc_id", "text", "n_dropped") == sorted(
        [(1, "", 1), (1, "", 1), (2, "", 1), (None, line, 0), (3, "other\n" + line, 0), (None, None, 0)], key=repr)
    two = frame([(1, line), (1, line), (2, line)], "doc_id long, text string")
    assert {r["n_dropped"] for r in linededup.drop_lines(two, bits=bits).collect()} == {0}
    assert linededup.drop_lines(frame([], "doc_id long, text string"), bits=bits).count() == 0


# ------------------------------------------------------------------ URL rules
def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_rules_equal_brute_force(spark, frame):
    rules = llm_queries.URL_RULES + [("a.b.c.example.org", "/x", "block"), ("org", "/x/yy", "allow"), ("example.org", "/x/y", "block"),
                                     ("bad.test", "", "block"), ("é.test", "/ü", "block")]
    urls = ["http://example.com/en/1", "HTTP://WWW.Example.COM/en/?q", "https://www.example.com/en", "x://com/", "x://com", "x://xcom/", None, "",
            "no scheme", "://", "a://b://c.com/", "http://m.example.net/fr/1#f", "http://net/es/", "http://A.b.C.example.org/x/yyy",
            "http://z.example.org/x/y?", "http://bad.test", "http://bad.test:80/", "http://sub.bad.test?x", "http://é.test/üx", "http://É.test/üx",
            "http://a..com/", "http://.com/en/", "http://example.com/en/" + "p" * 20_000, "http://" + "a." * 3000 + "com/x\ny", "http://u@example.com/en/x y"]
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[0], "h")]
    got = urlfilter.judge(frame(rows, "page_id long, url string, host string"), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert rows_of(got, "page_id", "url", "host", "path", "rule", "verdict") == sorted(((i, u, *judge(u, rules)) for i, u, _ in rows), key=repr)


def test_rules_and_tables_may_be_empty_or_null(spark, frame):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert rows_of(urlfilter.judge(frame([(1, "http://a.com/")], "page_id long, url string"), none), "rule", "verdict") == [(None, "allow")]
    odd = spark.createDataFrame([(None, "/", "block"), ("com", None, "block"), ("com", "/", None), ("com", "/", "allow"), ("COM", "/", "block")],
                                "host string, path string, verdict string")
    assert rows_of(urlfilter.judge(frame([(1, "http://a.com/")], "page_id long, url string"), odd), "rule", "verdict") == [("com/", "block")]
    assert urlfilter.judge(frame([], "page_id long, url string"), odd).count() == 0


# ------------------------------------------------------------------ language model
def brute_scores(rows, trains, order, mu):
    counts = [Counter() for _ in range(order + 1)]
    for (i, t), train in zip(rows, trains):
        w = [b"\0S", *words(t), b"\0E"]
        if train:
            for k in range(1, order + 1):
                counts[k].update(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
    n = sum(c for g, c in counts[1].items() if g != (b"\0S",))
    v = sum(g != (b"\0S",) for g in counts[1])
    out = []
    for i, t in rows:
        w = [b"\0S", *words(t), b"\0E"]
        base = total = 0.0
        known = 0
        for j in range(1, len(w)):
            p = (counts[1][w[j],] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            known += counts[1][w[j],] > 0
            for k in range(2, order + 1):
                if j - k + 1 < 0 or not counts[k - 1][tuple(w[j - k + 1:j])]:
                    break
                p = (counts[k][tuple(w[j - k + 1:j + 1])] + mu * p) / (counts[k - 1][tuple(w[j - k + 1:j])] + mu)
            total += math.log10(p)
        out.append((i, len(w) - 1, known, n, base, total))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, frame, monkeypatch, order):
    monkeypatch.setattr(lmscore, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(lmscore, "NGRAMS_PER_BUCKET", 500)
    rows = [(i, t) for i, t, *_ in make_docs(60) + EDGE if i is not None and i != 908] + [(5, "w1 w2 w3")]
    trains = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    docs = frame([(i, t, "s") for i, t in rows], "doc_id long, text string, score string")
    got = lmscore.score(docs, crc_fold(F.col("doc_id")) != 1, order=order, mu=3.0)
    got = rows_of(got, "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    want = sorted(brute_scores(rows, trains, order, 3.0), key=repr)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([r[4:] for r in got], [r[4:] for r in want], rtol=1e-9)


def _block_row(n_docs, n_words, vocab, seed=3):
    """A block's row of documents of ``n_words`` words each."""
    rng = np.random.default_rng(seed)
    return {"vocab": pack_sorted(np.sort(rng.integers(0, 1 << 63, vocab).astype(np.uint64))),
            "codes": planes(rng.integers(0, vocab, n_docs * n_words).astype(np.int32)),
            "counts": planes(np.full(n_docs, n_words, np.int32)),
            "trains": planes((np.arange(n_docs) % 5 != 1).astype(np.uint8))}


def _scores_of(row, order):
    found = [lmscore._distinct(lmscore._unpack(row), k) for k in range(1, order + 1)]
    totals = [counts.astype(np.uint64) for _, counts, _ in found]
    return found, totals, lmscore._read(lmscore._unpack(row), totals, 10_000, 500, 3.0)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_parts_of_a_block_change_nothing(monkeypatch, order):
    row = _block_row(120, 37, 90)
    whole, _, scores = _scores_of(row, order)
    monkeypatch.setattr(lmscore, "PART_TOKENS", 100)
    assert len(lmscore._unpack(row)) > 10
    parts, _, again = _scores_of(row, order)
    for (keys, counts, places), (k, c, p) in zip(whole, parts):
        assert (keys == k).all() and (counts == c).all() and (np.concatenate(places) == np.concatenate(p)).all()
    assert all((scores[x] == again[x]).all() for x in scores)


def test_a_block_is_read_in_bounded_memory():
    row = _block_row(3000, 400, 50_000)
    _, totals, _ = _scores_of(row, 2)
    tracemalloc.start()
    lmscore._read(lmscore._unpack(row), totals, 10_000, 500, 3.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 * 3000 * 402  # bytes a token; 124 when a block's arrays were whole


def test_probabilities_sum_to_one():
    trains = [True] * 3
    rows = [(0, "a b a c"), (1, "a b b"), (2, "c a")]
    start = brute_scores(rows, trains, 2, 2.0)
    # After "a": every known word, the end and one unseen word.
    with_next = [brute_scores(rows + [(9, f"a {w}")], trains + [False], 2, 2.0)[-1][5] for w in ("a", "b", "c", "zz")]
    assert start[0][1] == 5 and all(x < 0 for x in with_next)


def test_scores_without_training_or_rows(spark, frame):
    docs = frame([(1, "a b"), (None, None)], "doc_id long, text string")
    got = lmscore.score(docs, F.lit(False))
    assert rows_of(got, "doc_id", "n_tokens", "n_known", "train_tokens") == sorted([(1, 3, 0, 0), (None, 1, 0, 0)], key=repr)
    assert lmscore.score(frame([], "doc_id long, text string"), F.lit(True)).count() == 0


def test_held_out_text_is_likelier_than_by_the_base(spark):
    out = llm_queries.op5_backoff_lm(spark, "/root/testdata/sf0.001").filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1]


# ------------------------------------------------------------------ mixing
def fair_targets(sizes, weights=(5, 2, 1), epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, budget = {}, set(names), sum(sizes.values())
    while free:
        share = budget / sum(w[s] for s in free)
        above = {s for s in free if share * w[s] >= epochs * sizes[s]}
        if not above:
            target |= {s: share * w[s] for s in free}
            break
        for s in above:
            target[s] = epochs * sizes[s]
            budget -= target[s]
        free -= above
    return target


def test_mix_meets_its_targets(spark, frame):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join("w" * int(rng.integers(1, 60))).strip(), [None, "a", "é", "z", "Z", "tiny"][min(5, int(rng.integers(0, 6)) if i % 50 else 5)], "x")
            for i in range(400)] + [(1000, None, "a", "x"), (1001, "", "empty source", "x"), (None, "a b c", "z", "x")]
    rows += [(2000, "same words here", "a", "x")] * 3
    schema = "doc_id long, text string, source string, copies string"
    plan = mixing.plan(frame(rows, schema)).collect()
    assert len(plan) == len(rows)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = fair_targets(sizes)
    by_size = {(r["source_size"], round(r["target"], 6)) for r in plan}
    assert by_size == {(sizes[s], round(want[s], 6)) for s in sizes}
    assert all(0 <= r["copies"] <= 3 for r in plan)
    for s in sizes:
        took = sum(r["copies"] * r["size"] for r in plan if (r["source_size"], round(r["target"], 6)) == (sizes[s], round(want[s], 6)))
        assert abs(took - want[s]) <= 120, s
    again = mixing.plan(frame(rows, schema, parts=7))
    assert rows_of(again, "id", "size", "target", "copies") == sorted(((r["id"], r["size"], r["target"], r["copies"]) for r in plan), key=repr)


def test_mixed_rows_follow_the_plan(spark, frame):
    rows = [(i % 40, f"text {'w ' * (i % 7)}{i % 40}", ["a", None][i % 2], "x") for i in range(120)]
    docs = frame(rows, "doc_id long, text string, source string, _copies string")
    plan = Counter()
    for r in mixing.plan(docs).collect():
        plan[r["id"]] += r["copies"]
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == +plan


def test_mix_of_nothing(spark, frame):
    schema = "doc_id long, text string, source string"
    assert mixing.plan(frame([], schema)).count() == 0 and mixing.mix(frame([], schema)).count() == 0
    only = mixing.plan(frame([(1, None, None), (2, " ", "a")], schema)).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in only] == [(0, 0.0, 0)] * 2


def test_queries_digest(spark):
    out = llm_queries.op8_bloom_line_dedup(spark, "/root/testdata/sf0.001").collect()
    assert all(re.fullmatch("[0-9a-f]{64}", r["kept_sha256"]) for r in out)
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
