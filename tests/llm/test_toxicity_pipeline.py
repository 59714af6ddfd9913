import gc
import weakref
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import bpe, toxicity
from shelfwise.llm.common import crc_fold
from tests.llm.conftest import rows_of
from tests.llm.test_text_operators import brute_classes, words

def fold():
    return crc_fold(F.col("doc_id"))



def corpus(n=400, seed=9):
    rng = np.random.default_rng(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 6 == 0
        text = [f"{rng.choice(list('abcdef'))}word{rng.integers(500)}" for _ in range(int(rng.integers(5, 40)))]
        if toxic:
            for _ in range(int(rng.integers(2, 6))):
                text.insert(int(rng.integers(len(text))), str(rng.choice(["Idiot!", "SCUM", "lowei" + "abcde"[rng.integers(5)], "moron,"])))
        docs.append((i, " ".join(text), "en", f"s{i % 4}", 0))
        labels.append((i, int(toxic)))
    return docs, labels


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(9000, None, None, None, None), (9001, "", "en", "s0", 0), (9002, "idiot " * 30_000, "en", "s0", 1), (None, "you idiot scum moron", "en", "s1", 1),
       (9003, "nothing here to see", "en", "s1", 1), (9003, "nothing here to see", "en", "s1", 1)]


def test_held_out_accuracy_and_evidence(spark, frame):
    docs, labels = corpus()
    rows = docs + ODD
    extra = [(None, 1), (3, None), (77_777, 1)]
    out = toxicity.score(frame(rows, DOCS), frame(labels + extra, "doc_id long, toxic int"), fold() != 0).collect()
    assert len(out) == len(rows)
    truth = dict(labels)
    held = [r for r in out if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 50 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    by = {r["doc_id"]: r for r in out}
    assert by[9002]["predicted"] == 1 and by[None]["predicted"] == 1
    assert by[9000]["score"] == by[9001]["score"] == by[9003]["score"] < 0.2 and by[9003]["evidence"] == []
    near = by[6]["evidence"]
    assert near and [e["cosine"] for e in near] == sorted((e["cosine"] for e in near), reverse=True)
    assert all(zlib.crc32(str(e["id"]).encode()) % 5 for r in out for e in r["evidence"])  # learned from training rows only


def test_labels_of_held_out_rows_change_nothing(spark, frame):
    docs, labels = corpus(150)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (toxicity.score(frame(docs, DOCS), frame(x, "doc_id long, toxic int"), fold() != 0) for x in (labels, flipped))
    assert rows_of(a, "doc_id", "score") == rows_of(b, "doc_id", "score")


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)], [(6, 1)]])
def test_few_labels(spark, frame, labels):
    docs, _ = corpus(30)
    out = toxicity.score(frame(docs, DOCS), frame(labels, "doc_id long, toxic int"), fold() != 0)
    assert {r["predicted"] for r in out.collect()} <= {0, 1} and out.count() == 30
    assert toxicity.score(frame([], DOCS), frame(labels, "doc_id long, toxic int"), fold() != 0).count() == 0


def test_without_toxic_keeps_columns(spark, frame):
    docs, labels = corpus(200)
    named = "doc_id long, text string, score string, evidence string, terms long"
    got = toxicity.without_toxic(frame(docs, named), frame(labels, "doc_id long, toxic int"), fold() != 0)
    assert got.columns == ["doc_id", "text", "score", "evidence", "terms"]
    truth = dict(labels)
    kept = {r["doc_id"] for r in got.collect()}
    assert np.mean([(i not in kept) == bool(y) for i, y in truth.items()]) > 0.97
    assert {i for i, y in truth.items() if not y} <= kept  # clean documents stay


def rare_insults():
    """Each insult stands in three toxic documents only; the first of the three carries no label."""
    rng = np.random.default_rng(4)
    names = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9)) for _ in range(5030)]
    names, insults = names[:5000], names[5000:]
    docs, labels = [], []
    for i in range(300):
        text = [str(w) for w in rng.choice(names, 12)]
        if i < 90:
            text.insert(5, insults[i // 3])
        docs.append((i, " ".join(text), "en", "s", 0))
        if i >= 90 or i % 3:
            labels.append((i, int(i < 90)))
    return docs, labels


def test_rare_insults_are_terms(spark, frame):
    docs, labels = rare_insults()
    out = toxicity.score(frame(docs, DOCS), frame(labels, "doc_id long, toxic int"), F.lit(True)).collect()
    by = {r["doc_id"]: r for r in out}
    assert all({i + 1, i + 2} <= {e["id"] for e in by[i]["evidence"]} for i in range(0, 90, 3))


def test_cosines_are_over_all_words_of_the_examples(spark, frame):
    docs, labels = rare_insults()
    bags = {i: Counter(t for w in text.split() for t in toxicity.terms_of(w.encode())) for i, text, *_ in docs}
    known = {t for i, _ in labels for t in bags[i]}
    seen = [Counter(t for i, y in labels if y == label for t in bags[i]) for label in (0, 1)]
    n = [sum(y == label for _, y in labels) for label in (0, 1)]
    weight = {t: (np.log((len(docs) + 1) / (sum(t in b for b in bags.values()) + 1)) + 1)
              * np.log2(2 + seen[1][t] / max(1, seen[0][t] * n[1] / n[0])) for t in known}
    units = {}
    for i, bag in bags.items():
        w = {t: (1 + np.log(c)) * weight[t] for t, c in bag.items() if t in known}
        units[i] = {t: x / np.sqrt(sum(v * v for v in w.values())) for t, x in w.items()}
    out = toxicity.score(frame(docs, DOCS), frame(labels, "doc_id long, toxic int"), F.lit(True)).collect()
    for r in out[::10]:
        mine = units[r["doc_id"]]
        want = sorted((sum(mine[t] * x for t, x in units[i].items() if t in mine) for i, _ in labels), reverse=True)[:15]
        assert np.allclose([e["cosine"] for e in r["evidence"]], [c for c in want if c > 1e-12])


def test_weights_count_the_drawn_examples_only(spark, frame):
    """Labels without a document teach nothing about the terms."""
    docs, labels = corpus(90)
    orphans = [(100_000 + i, i % 2) for i in range(3000)]
    a, b = (toxicity.score(frame(docs, DOCS), frame(x, "doc_id long, toxic int"), fold() != 0).collect() for x in (labels, labels + orphans))
    cosines = [{r["doc_id"]: [(e["id"], e["cosine"]) for e in r["evidence"]] for r in out} for out in (a, b)]
    assert cosines[0] == cosines[1] and any(cosines[0].values())


def test_nearest_is_exact():
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(500):
        t = np.sort(rng.choice(60, int(rng.integers(1, 8)), replace=False))
        vectors.append((t, toxicity.weighted(t, rng.integers(1, 4, len(t)).astype(float), np.linspace(1, 5, 60))))
    index = toxicity.BlockMaxIndex(vectors, 60)
    dense = np.zeros((500, 60))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for i in range(0, 500, 7):
        cosine = np.round(dense @ dense[i], 12)
        cosine[i] = 0
        best = sorted((-c, j) for j, c in enumerate(cosine) if c > 0)[:15]
        near = index.nearest(*vectors[i], 15, without=i)
        assert near.places.tolist() == [j for _, j in best] and np.allclose(near.cosines, [-c for c, _ in best])


def test_a_batch_finds_what_each_text_finds():
    """Texts read blocks together; rare and common terms, no term at all, and fewer than k partners."""
    rng = np.random.default_rng(5)
    n, terms = 700, 900
    vectors = []
    for i in range(n):
        topic = rng.choice(30, 6, replace=False) + 30 * (i % 5)
        t = np.unique(np.concatenate([topic, rng.choice(terms - 150, int(rng.integers(0, 9))) + 150]))[:0 if i % 97 == 5 else None]
        vectors.append((t, toxicity.weighted(t, rng.integers(1, 4, len(t)).astype(float), np.linspace(1, 5, terms))))
    index = toxicity.BlockMaxIndex(vectors, terms)
    dense = np.zeros((n, terms))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    cosine = np.round(dense @ dense.T, 12)
    np.fill_diagonal(cosine, 0)
    for k in (1, 15, 2000):
        for i, near in enumerate(index.nearest_of(vectors, k, list(range(n)))):
            best = sorted((-c, j) for j, c in enumerate(cosine[i].tolist()) if c > 0)[:k]
            assert np.allclose(near.cosines, [-c for c, _ in best])
            assert k == 2000 or near.places.tolist() == [j for _, j in best]
    assert toxicity.BlockMaxIndex([], 3).nearest_of(vectors[:2], 5)[1].places.tolist() == []


# ------------------------------------------------------------------ the pipeline, stage by stage
def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_and_columns(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "bpe"]
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == [*docs.columns, "ids"]
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                  mergeable_ranks=bpe.read_ranks(public_tokenizers.path(corpus_pipeline.VOCAB)))
    rows = out.collect()
    assert rows and all(r["ids"] == reference.encode_ordinary(r["text"] or "") and r["n_chars"] == len(r["text"] or "") for r in rows)
    # What survived is free of repeated lines and near-duplicates; repeats come from the mix.
    once = {r["doc_id"]: r["text"] for r in rows}
    assert max(Counter(r["doc_id"] for r in rows).values()) <= 3
    holders = Counter(k for t in once.values() for k in {line.strip().lower() for line in t.split("\n")} if len(k) >= 20)
    assert max(holders.values()) <= 2
    classes = brute_classes(list(once.items()), 5, 4, 5)
    assert all(c == i for i, n, c in classes if n)


def test_each_stage_takes_any_rows(spark, frame, tmp_path):
    docs, labels = corpus(60)
    sf = str(tmp_path)
    frame([(i, 0, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    for rows in (docs + ODD, []):
        now = frame(rows, DOCS)
        for name, fn in corpus_pipeline.STAGES:
            out = fn(spark, now, sf)
            assert out.columns[:5] == now.columns[:5], name
            got = out.collect()
            assert bool(got) == bool(rows), name
            now = spark.createDataFrame(got, out.schema) if got else spark.createDataFrame([], out.schema)


def test_ngram_stage_keeps_one_of_each_class(spark, frame):
    docs, _ = corpus(40)
    rows = docs + [(500 + i, t, l, s, n) for i, t, l, s, n in docs[:10]] + [(600 + i, t + " tail", l, s, n) for i, t, l, s, n in docs[:10]]
    kept = {r["doc_id"] for r in stage("ngram_join")(spark, frame(rows, DOCS), "").collect()}
    want = {c for _, n, c in brute_classes([r[:2] for r in rows], 5, 4, 5)}
    assert kept == want


def test_mixing_stage_repeats_rows(spark, frame):
    docs, _ = corpus(100)
    out = stage("mixing")(spark, frame(docs, DOCS), "").collect()
    total = sum(len(words(t)) for _, t, *_ in docs)
    assert abs(sum(len(words(r["text"])) for r in out) - total) < 60
    assert max(Counter(r["doc_id"] for r in out).values()) <= 3


def test_a_worker_drops_the_index_with_its_model():
    class Held:  # a broadcast as a worker holds it
        def __init__(self, value):
            self.value = value

    vectors = [(np.array([0, 1]), np.array([0.6, 0.8])), (np.array([1]), np.array([1.0]))]

    class Learned:
        def index(self):
            return toxicity.BlockMaxIndex(vectors, 2)

    one, other = Held(Learned()), Held(Learned())
    index = toxicity._index_of(one)
    assert toxicity._index_of(one) is index and toxicity._index_of(other) is not index
    gone = weakref.ref(index)
    del one, index
    gc.collect()
    assert gone() is None and len(toxicity._index_of(other).place) == 2
