"""Toxicity by the nearest labelled examples, found exactly with a block-max inverted index.

Terms are words (runs of letters, lower case) and, of longer ones, their first ``LETTERS`` letters, which
catch inflected and invented forms.  A bounded sample of labelled rows (at most
``EXAMPLES`` of each label, those with the least hash of their id) gives the examples; every term of an
example counts.  Each text is a vector of TF-IDF weights, document frequencies being counted over all
documents, times the relevance frequency log2(2 + toxic / clean) of the term among the examples (tf.rf
weighting): terms that lean towards toxic weigh more, none weighs nothing.  Words that no example has are
no terms: they are in no product, and would shorten all cosines of a text alike.  A text's nearest examples
by cosine vote with weights that fall with the distance, and a logistic curve, fitted to the examples with
each left out of its own vote, makes the vote a probability.

The index keeps the postings of rare terms by term; these are few, and are added up first.  Those of common
terms lie, a line for each term, in blocks of ``BLOCK`` similar examples, with each term's largest weight in each block.  The sum
of a query's weights times these maxima, and the block's largest sum of rare terms, bound the cosine of
every example of the block.  Blocks are read by falling bound, in rounds; a block with a bound below the k-th best cosine
found is left out: the result is that of reading all.  Texts read the index together, block by block.  Examples are put in order by the most similar of some of them, so that a
block has few distinct terms and its bound is near its cosines.
Examples and so their terms are bounded, so they are broadcast, and executors build the index; terms are
known by 64-bit fingerprints.

Defined results: a null or empty text, or one without any of the terms, has no neighbours and gets the
share of toxic rows among the examples that have none either.  Without labelled rows all scores are the
same, below 0.5.  A label counts as toxic if any row of its id says so; null labels and ids, and ids
without a document, teach nothing.
Repeated rows are scored one by one; ties of the cosine go to the smaller id.  An empty table gives no
rows.  Scores depend on texts and training labels alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import NamedTuple
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Words, planes, ship, slices, squeeze, tidy, unplanes, unsqueeze, written

#: Labelled rows of each label that are learned from at most.
EXAMPLES = 1024
#: Letters of a longer word that are a term, too.
LETTERS = 4
K = 15
BLOCK = 32
#: Examples that hold a common term at least; rare ones are added up before any block is read.
COMMON = 16
#: Examples that the others are put in order by, and the leaders of these.
SEEDS, LEADERS = 64, 8
#: A neighbour at distance d votes with weight (1 - d) ** NEARNESS; the prior has a weight of its own.
NEARNESS, PRIOR_WEIGHT = 2.0, 0.5
SEED = 11
#: Blocks that a text reads before it first drops some; texts that read the index together.
FIRST_BLOCKS, TOGETHER = 4, 256
#: Left-out examples that a task votes on.
EXAMPLES_PER_TASK = 512
#: Text bytes of which the words are held at once.
AT_ONCE = 4 << 20
#: Terms of which the document frequencies move in one packet.
PACKET = 512

_LETTERS = re.compile(r"[^\W\d_]+")


def terms_of(word: bytes) -> list[str]:
    """The terms of a word as it stands between white space."""
    text = word.decode("utf-8", "replace").lower()
    out = []
    for run in [text] if text.isalpha() else _LETTERS.findall(text):
        out.append(run)
        if len(run) > LETTERS:
            out.append(f"{run[:LETTERS]}*")
    return out


@lru_cache(1 << 16)
def _prints(word: bytes) -> list[int]:
    return [xxhash.xxh3_64_intdigest(t) for t in terms_of(word)]


# ------------------------------------------------------------------ what is learned
def _sample(docs: DataFrame, labels: DataFrame, examples: int, seed: int) -> tuple[DataFrame, dict[int, int]]:
    """(id, toxic, text) of the examples, and the number of labelled rows of each label."""
    rows = labels.filter("id is not null and toxic is not null").groupBy("id").agg(
        F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    rows = rows.join(docs.select("id"), "id", "left_semi")  # a label without a document teaches nothing
    rows = written(rows.withColumn("draw", F.xxhash64(F.lit(seed), F.col("id").cast("string"))), "toxicity-labels")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    drawn = None
    for label in (0, 1):
        some = rows.filter(F.col("toxic") == label).orderBy("draw", "id").limit(examples).select("id", "toxic")
        drawn = some if drawn is None else drawn.union(some)
    # At most 2 * examples ids.
    texts = docs.join(F.broadcast(drawn), "id").groupBy("id").agg(F.min("toxic").alias("toxic"), F.min("text").alias("text"))
    return texts, counts


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _bags(texts: pa.Array, known: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms, counts) of each text, by term: fingerprints, or places in the sorted fingerprints ``known``."""
    for i, j in slices(texts, AT_ONCE):
        words = Words(texts.slice(i, j - i))
        terms = [_prints(w) for w in words.vocab]
        size = np.array([len(t) for t in terms], np.int64)
        prints = np.fromiter(chain.from_iterable(terms), np.uint64, int(size.sum()))
        if known is None:
            kept, place = np.unique(prints, return_inverse=True)
        else:
            place = np.searchsorted(known, prints)
            found = np.append(known, np.uint64(0))[place] == prints
            found &= place < len(known)
            size = np.bincount(np.repeat(np.arange(len(size)), size)[found], minlength=len(size))
            place, kept = place[found], np.arange(len(known), dtype=np.int32)
        begin = np.cumsum(size) - size
        # Distinct words of each text, then their distinct terms.
        doc = np.repeat(np.arange(j - i), words.counts)
        pair, times = np.unique(doc * max(len(terms), 1) + words.codes, return_counts=True)
        doc, code = np.divmod(pair, max(len(terms), 1))
        key = np.repeat(doc, size[code]) * max(len(kept), 1) + place[_expand(begin[code], size[code])]
        order = np.argsort(key, kind="stable")
        key, times = key[order], np.repeat(times, size[code])[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        counts = np.add.reduceat(times, first).astype(np.int32) if len(first) else np.zeros(0, np.int32)
        doc, term = np.divmod(key[first], max(len(kept), 1))
        ends = np.searchsorted(doc, np.arange(j - i + 1))
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            yield kept[term[a:b]], counts[a:b]


def _pack(terms: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    return planes(np.diff(terms, prepend=terms.dtype.type(0))), planes(counts)


def _unpack(terms: bytes, counts: bytes, dtype) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(unplanes(terms, dtype), dtype=dtype), unplanes(counts, np.int32)


def _term_counts(docs: DataFrame, carry: list[str], text_col: str = "text", known=None) -> DataFrame:
    """(*carry, terms, counts): the terms that each text holds, and how often, packed.  ``known``: broadcast
    fingerprints, sorted, the places of which stand for the terms; other terms are left out."""
    docs = docs.select(*carry, F.col(text_col).cast("string").alias("_term_text"))
    schema = T.StructType([*(docs.schema[c] for c in carry), T.StructField("terms", T.BinaryType()),
                           T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_pack(*bag) for bag in _bags(batch.column(len(carry)), known and known.value)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(len(carry))), pa.array([t for t, _ in packed], pa.binary()),
                 pa.array([n for _, n in packed], pa.binary())], [*carry, "terms", "counts"])

    return docs.mapInArrow(tidy(run), schema)


def _document_frequency(bags: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term; a task gives one packet for ``PACKET`` neighbouring terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_terms, np.int64)
        for batch in batches:
            for terms in batch.column(0).to_pylist():
                seen[np.cumsum(unplanes(terms, np.int32))] += 1
        some = [k for k in range(0, n_terms, PACKET) if seen[k:k + PACKET].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([squeeze(seen[k:k + PACKET]) for k in some], pa.binary())],
                                         ["first", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n = unsqueeze(n, np.int64)
                total[first] = total[first] + n if first in total else n
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([squeeze(n) for n in total.values()], pa.binary())],
                                         ["first", "n"])

    out = np.zeros(n_terms, np.int64)
    for r in bags.mapInArrow(tidy(count), "first int, n binary").repartition("first").mapInArrow(add, "first int, n binary").collect():
        n = unsqueeze(bytes(r["n"]), np.int64)
        out[r["first"]:r["first"] + len(n)] = n
    return out


def relevance(bags: list[np.ndarray], toxic: np.ndarray, n_terms: int) -> np.ndarray:
    """log2(2 + toxic / clean) of each term: its examples of both labels, as if there were as many of each."""
    seen = [np.zeros(n_terms), np.zeros(n_terms)]
    for terms, y in zip(bags, toxic):
        seen[int(y)][terms] += 1
    n = [max(1, int((toxic == y).sum())) for y in (0, 1)]
    return np.log2(2 + seen[1] / np.maximum(1, seen[0] * n[1] / n[0]))


def weighted(terms: np.ndarray, counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Unit weights of one text's terms."""
    w = (1 + np.log(counts)) * weight[terms]
    return w / np.sqrt((w * w).sum())


# ------------------------------------------------------------------ the index
class Neighbours(NamedTuple):
    places: np.ndarray
    cosines: np.ndarray


def _arranged(vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> list[int]:
    """The examples by their most similar seed, seeds of one leader together."""
    seeds = np.arange(0, len(vectors), max(1, len(vectors) // SEEDS))
    leads = np.arange(0, len(seeds), max(1, len(seeds) // LEADERS))
    of_seed = np.zeros((n_terms, len(seeds)), np.float32)
    for j, s in enumerate(seeds):
        of_seed[vectors[s][0], j] = vectors[s][1]
    cosine = np.array([w.astype(np.float32) @ of_seed[t] for t, w in vectors]).reshape(len(vectors), len(seeds))
    nearest = cosine.argmax(1)
    leader = cosine[seeds][:, leads].argmax(1)
    return np.lexsort((-cosine[np.arange(len(vectors)), nearest], nearest, leader[nearest])).tolist()


class BlockMaxIndex:
    """Postings of unit vectors: rare terms by term, common ones in blocks of ``BLOCK`` similar examples, with
    each common term's maximum in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        order = _arranged(vectors, n_terms) if vectors else []
        self.place = np.array(order, np.int64)
        self.slot_of = np.argsort(self.place)
        self.blocks = -(-len(order) // BLOCK)
        slot = np.repeat(np.arange(len(order)), [len(vectors[o][0]) for o in order])
        term = np.concatenate([vectors[o][0] for o in order] or [np.zeros(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([vectors[o][1] for o in order] or [np.zeros(0)])
        common = np.bincount(term, minlength=n_terms) >= COMMON
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        rare = np.flatnonzero(~common[term])
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.begin = np.searchsorted(term[rare], np.arange(n_terms + 1))
        self.slot, self.weight = slot[rare], weight[rare]
        #: Bounds are in single precision, rounded up.
        self.largest = np.zeros((int(common.sum()), self.blocks), np.float32)
        #: Of each block: the line of each common term (0: none has it), and lines of its weights by example.
        self.postings = []
        for b in range(self.blocks):
            i, j = np.searchsorted(slot, [b * BLOCK, (b + 1) * BLOCK])
            some = np.flatnonzero(common[term[i:j]]) + i
            t, w = self.row[term[some]], weight[some]
            held, line = np.unique(t, return_inverse=True)
            line_of = np.zeros(len(self.largest), np.int32)
            line_of[held] = np.arange(1, len(held) + 1)
            lines = np.zeros((len(held) + 1, BLOCK))
            lines[line + 1, slot[some] - b * BLOCK] = w
            self.postings.append((line_of, lines))
            self.largest[held, b] = np.nextafter(lines[1:].max(1).astype(np.float32), np.float32(2))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> Neighbours:
        """The k examples with the highest positive cosine, ties to the smaller place."""
        return self.nearest_of([(terms, weights)], k, [without])[0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None = None) -> list[Neighbours]:
        """``nearest`` of each vector.  All of them read a block before the next one, their most promising
        blocks in the first round; a round's k-th best cosines tell which blocks are left to the next."""
        n, slots = len(vectors), self.blocks * BLOCK
        if not slots:
            return [Neighbours(np.zeros(0, np.int64), np.zeros(0)) for _ in vectors]
        left_out = np.array([self.slot_of[p] if p >= 0 else -1 for p in without or [-1] * n], np.int64)
        forgotten = np.flatnonzero(left_out >= 0), left_out[left_out >= 0]
        cosine, bound, common = np.zeros((n, slots)), np.zeros((n, self.blocks), np.float32), []
        for i, (terms, weights) in enumerate(vectors):
            row = self.row[terms]
            t, w = row[row >= 0], weights[row >= 0]
            rare = terms[row < 0]
            size = self.begin[rare + 1] - self.begin[rare]
            read = _expand(self.begin[rare], size)
            cosine[i] = np.bincount(self.slot[read], np.repeat(weights[row < 0], size) * self.weight[read], slots)
            bound[i] = (w.astype(np.float32) @ self.largest.take(t, 0)) * np.float32(1 + 1e-5) + np.float32(1e-6)
            common.append((t, w))
        cosine[forgotten] = 0
        by_block = cosine.reshape(n, self.blocks, BLOCK)
        bound += by_block.max(2)
        rank = np.argsort(np.argsort(-bound, 1, kind="stable"), 1)
        best, done = np.zeros((n, k)), 0
        while done < self.blocks:
            upto = max(FIRST_BLOCKS, 2 * done)
            reads = (rank >= done) & (rank < upto) & (bound >= best.min(1)[:, None])
            if not reads.any():
                break
            for b in np.flatnonzero(reads.any(0)).tolist():
                line_of, lines = self.postings[b]
                for i in np.flatnonzero(reads[:, b]).tolist():
                    t, w = common[i]
                    by_block[i, b] += w @ lines.take(line_of.take(t), 0)
            cosine[forgotten] = 0
            for i in np.flatnonzero(reads.any(1)).tolist():
                found = np.concatenate([best[i], by_block[i, reads[i]].ravel()])
                best[i] = np.partition(found, -k)[-k:]
            done = upto
        cosine = np.round(cosine[:, :len(self.place)], 12)
        out = []
        for i, least in enumerate(np.round(best.min(1), 12).tolist()):
            slot = np.flatnonzero((cosine[i] > 0) & (cosine[i] >= least))
            slot = slot[np.lexsort((self.place[slot], -cosine[i, slot]))[:k]]
            out.append(Neighbours(self.place[slot], cosine[i, slot]))
        return out


class Model(NamedTuple):
    """What a task needs to score a text; bounded by the examples.  ``terms`` and ``counts`` are squeezed."""

    ids: list
    toxic: np.ndarray
    stands_for: np.ndarray
    weight: np.ndarray
    terms: bytes
    counts: bytes
    ends: np.ndarray
    prior: float
    alone: float

    def index(self) -> BlockMaxIndex:
        cut = self.ends[:-1]
        bags = zip(np.split(unsqueeze(self.terms, np.int32), cut), np.split(unsqueeze(self.counts, np.int32), cut))
        return BlockMaxIndex([(t, weighted(t, c, self.weight)) for t, c in bags] if self.ids else [], len(self.weight))

    def vote(self, near: Neighbours) -> float:
        weight = near.cosines ** NEARNESS * self.stands_for[near.places]
        toxic = (weight * self.toxic[near.places]).sum()
        return float((toxic + PRIOR_WEIGHT * self.prior) / (weight.sum() + PRIOR_WEIGHT))

    def score(self, near: Neighbours, curve: tuple[float, float]) -> float:
        return _sigmoid(curve[0] + curve[1] * _logit(self.vote(near))) if len(near.places) else self.alone


#: Indexes of the broadcast models that this Python worker holds; one goes when Spark drops its model.
_BUILT: WeakKeyDictionary = WeakKeyDictionary()


def _index_of(model) -> BlockMaxIndex:
    """The index of a broadcast model, built once for each Python worker."""
    if model not in _BUILT:
        _BUILT[model] = model.value.index()
    return _BUILT[model]


def _logit(p):
    return np.log(p) - np.log1p(-p)


def _sigmoid(x) -> float:
    return float(1 / (1 + np.exp(-x)))


def _fit_curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Logistic intercept and slope by Newton's method, held near (0, 1)."""
    beta, start = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    design = np.stack([np.ones(len(x)), x], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (w * (y - p)) - (beta - start)
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


class Examples(NamedTuple):
    """The examples by id; ``terms[ends[i - 1]:ends[i]]`` are those of example i, as places in ``known``."""

    ids: list
    toxic: np.ndarray
    known: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    ends: np.ndarray

    def bags(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return list(zip(np.split(self.terms, self.ends[:-1]), np.split(self.counts, self.ends[:-1])))


def _examples(bags: DataFrame) -> Examples:
    rows = sorted(bags.collect(), key=lambda r: r["id"])  # at most 2 * examples rows
    some = [_unpack(bytes(r["terms"]), bytes(r["counts"]), np.uint64) for r in rows]
    ends = np.cumsum([len(t) for t, _ in some], dtype=np.int64)
    counts = np.concatenate([c for _, c in some] or [np.zeros(0, np.int32)])
    prints = np.concatenate([t for t, _ in some] or [np.zeros(0, np.uint64)])
    del some
    known = np.unique(prints)
    return Examples([r["id"] for r in rows], np.array([r["toxic"] for r in rows], float), known,
                    np.searchsorted(known, prints).astype(np.int32), counts, ends)


def _model(examples: Examples, counts: dict[int, int], frequency: np.ndarray, n_docs: int) -> Model:
    toxic, bags = examples.toxic, examples.bags() if examples.ids else []
    weight = (np.log((n_docs + 1) / (frequency + 1)) + 1) * relevance([t for t, _ in bags], toxic, len(frequency))
    drawn = [max(1, int((toxic == y).sum())) for y in (0, 1)]
    stands_for = np.array([counts.get(int(y), 0) / drawn[int(y)] for y in toxic])
    prior = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 2)
    empty = np.array([not len(t) for t, _ in bags], bool)
    alone = ((stands_for * toxic)[empty].sum() + 0.5 * prior) / (stands_for[empty].sum() + 0.5)
    held = np.flatnonzero(~empty)
    return Model([examples.ids[i] for i in held], toxic[held], stands_for[held], weight, squeeze(examples.terms),
                 squeeze(examples.counts), np.unique(examples.ends[examples.ends > 0]), prior, float(alone))


def _left_out(bags: DataFrame, known, model, ids: list, toxic: np.ndarray, stands_for: np.ndarray, k: int) -> tuple[float, float]:
    """The curve of the votes that the examples get when each is left out; ``known``, ``model`` are broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, index = model.value, _index_of(model)
        place = {i: p for p, i in enumerate(m.ids)}
        for batch in batches:
            rows = [(place[i], *_unpack(t, c, np.uint64)) for i, t, c in zip(*(column.to_pylist() for column in batch.columns)) if i in place]
            out = []
            for i in range(0, len(rows), TOGETHER):
                some = [(p, np.searchsorted(known.value, t), c) for p, t, c in rows[i:i + TOGETHER]]
                nearest = index.nearest_of([(t, weighted(t, c, m.weight)) for _, t, c in some], k, [p for p, _, _ in some])
                out += [(p, m.vote(near)) for (p, _, _), near in zip(some, nearest) if len(near.places)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int32()), pa.array([v for _, v in out], pa.float64())], ["i", "vote"])

    bags = bags.select("id", "terms", "counts").repartition(len(ids) // EXAMPLES_PER_TASK + 1)
    votes = sorted((r["i"], r["vote"]) for r in bags.mapInArrow(run, "i int, vote double").collect())
    if not votes:
        return 0.0, 1.0
    at = [i for i, _ in votes]
    return _fit_curve(_logit(np.array([v for _, v in votes])), toxic[at], stands_for[at])


# ------------------------------------------------------------------ scoring
def score(docs: DataFrame, labels: DataFrame, is_training, k: int = K, examples: int = EXAMPLES, seed: int = SEED,
          id_col: str = "doc_id", text_col: str = "text", carry: list[str] = ()) -> DataFrame:
    """(doc_id, *carry, score, predicted, evidence) of each row of ``docs``.

    ``labels`` has doc_id and toxic; ``is_training`` is a condition on doc_id that its rows must meet.
    ``evidence``: the nearest examples (id, cosine, toxic), nearest first.
    """
    spark = ship(docs.sparkSession)
    learn = labels.filter(is_training).select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    sample, counts = _sample(texts, learn, examples, seed)
    sample = written(sample, "toxicity-sample")
    sample = written(_term_counts(sample, ["id", "toxic"]), "toxicity-examples")
    learned = _examples(sample)

    kept = [id_col, *(c for c in carry if c != id_col)]
    known = spark.sparkContext.broadcast(learned.known)
    n_terms = len(learned.known)
    bags = written(_term_counts(docs, kept, text_col, known), "toxicity-bags")
    n_docs = bags.count()
    model = _model(learned, counts, _document_frequency(bags.select("terms"), n_terms), n_docs)
    ids, toxic, stands_for = model.ids, model.toxic, model.stands_for
    model = spark.sparkContext.broadcast(model)
    del learned
    curve = _left_out(sample, known, model, ids, toxic, stands_for, k)
    evidence = T.ArrayType(T.StructType([T.StructField("id", bags.schema[id_col].dataType), T.StructField("cosine", T.DoubleType()),
                                         T.StructField("toxic", T.IntegerType())]))
    schema = T.StructType([*(bags.schema[c] for c in kept), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()), T.StructField("evidence", evidence)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, index = model.value, _index_of(model)
        for batch in batches:
            texts = list(zip(batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()))
            unlike = list(dict.fromkeys(texts))
            done: dict[tuple, tuple[float, list]] = {}
            for i in range(0, len(unlike), TOGETHER):
                some = [_unpack(t, c, np.int32) for t, c in unlike[i:i + TOGETHER]]
                nearest = index.nearest_of([(at, weighted(at, n, m.weight)) for at, n in some], k)
                for key, near in zip(unlike[i:], nearest):
                    done[key] = (m.score(near, curve), [{"id": m.ids[p], "cosine": x, "toxic": int(m.toxic[p])}
                                                 for p, x in zip(near.places.tolist(), near.cosines.tolist())])
            scores, proofs = [done[key][0] for key in texts], [done[key][1] for key in texts]
            kinds = schema["evidence"].dataType
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array(proofs, _arrow(kinds))], [*kept, "score", "predicted", "evidence"])

    return bags.mapInArrow(tidy(run), schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def without_toxic(docs: DataFrame, labels: DataFrame, is_training, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted to be toxic."""
    names = [f"_c{i}" for i in range(len(docs.columns))]  # no column of ``docs`` meets one of the scores'
    plain = docs.toDF(*names)
    scored = score(plain, labels, is_training, id_col=names[docs.columns.index(id_col)],
                   text_col=names[docs.columns.index(text_col)], carry=names, **options)
    return scored.filter("predicted = 0").select(*names).toDF(*docs.columns)
