"""Language-model scores from a weighted backoff automaton.

States are the contexts seen in training: the empty one, words, and so on up to ``order - 1`` words.
From state h an arc reads word w with the smoothed probability

    p(w | h) = (c(h w) + mu p(w | h')) / (c(h) + mu)

if h w was seen; otherwise the failure arc leads to the shorter context h' with weight mu / (c(h) + mu),
and w is read there.  p(w) is the additive estimate (c + 0.5) / (N + 0.5 (V + 1)).  Each context's
probabilities sum to one.  A text is read from left to right, from the state of its start to its end
token: every position has the longest seen context as its state, and log10 weights add up.

All counts come from all training documents.  The model is never whole in one place: documents form
blocks; a block packs its distinct n-grams (64-bit fingerprints, with their training counts) into
packets by hash range, reduce tasks add the packets up and answer each with the totals of its n-grams,
and a block's answers are exactly the part of the automaton that its texts can reach.  Frequent n-grams
are one entry per block.

Defined results: a null or empty text is one end token.  A null id belongs to the training documents.
Repeated rows count and are scored one by one.  Without training tokens every probability is that of an
unseen word.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import (Words, bucket_bounds, chain, checkpointed, fingerprints, pack_sorted, planes,
                                  ship, slices, squeeze, unpack_sorted, unplanes, unsqueeze, written)

ORDER = 2
#: Weight of the shorter context, in counts.
MU = 50.0
#: n-grams that a reduce task adds up, about.
NGRAMS_PER_BUCKET = 1_000_000
#: Text bytes of a block.
BLOCK_BYTES = 8 << 20

#: Tokens that are read at once, about: a block's arrays of eight-byte values are never whole.
PART_TOKENS = 1 << 17

_START, _END = (np.array([x], np.uint64) for x in (0x7374617274, 0x656E64))


class _Block:
    """Tokens of some of a block's documents: a start, the words, an end for each document."""

    def __init__(self, vocab: np.ndarray, codes: np.ndarray, counts: np.ndarray, trains: np.ndarray):
        self.counts, self.trains = counts, trains
        ids = np.concatenate([vocab, _START, _END])
        n = len(counts)
        length = counts + 2
        ends = np.cumsum(length)
        place = np.full(int(length.sum()), len(vocab), np.int32)  # start tokens
        place[ends - 1] = len(vocab) + 1
        inner = np.ones(len(place), bool)
        inner[ends - 1] = False
        inner[ends - length] = False
        place[inner] = codes
        self.doc = np.repeat(np.arange(n, dtype=np.int32), length)
        self.read = np.ones(len(place), bool)  # what is scored: all but the start
        self.read[ends - length] = False
        self.token = ids[place]
        self.train = trains[self.doc]

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of the n-grams that end at each position, and whether there is one."""
        key, fits = self.token, np.ones(len(self.token), bool)
        for k in range(1, order):
            # A longer history read oldest first, so that a context is the key of its own n-gram.
            key = np.concatenate([key[:1], chain(key[:-1], self.token[1:])])
            fits = np.concatenate([[False], fits[:-1]]) & np.concatenate([[False], self.doc[1:] == self.doc[:-1]])
        return key, fits


def _distinct(parts: list[_Block], order: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct n-grams of a block, ascending; their training counts; and each position's place, or -1, by part."""
    found = []
    for part in parts:
        key, fits = part.grams(order)
        keys, inverse = np.unique(key[fits], return_inverse=True)
        counts = np.bincount(inverse[part.train[fits]], minlength=len(keys)).astype(np.uint32)
        found.append((keys, counts, inverse.astype(np.int32), fits))
    every = np.sort(np.concatenate([keys for keys, *_ in found]))
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    every = every[new]
    totals, places = np.zeros(len(every), np.uint32), []
    for keys, counts, inverse, fits in found:
        to = np.searchsorted(every, keys).astype(np.int32)
        totals[to] += counts
        at = np.full(len(fits), -1, np.int32)
        at[fits] = to[inverse]
        places.append(at)
    return every, totals, places


_BLOCK_SCHEMA = ("block long, ids array<long>, trains binary, counts binary, vocab binary, codes binary, "
                 "tokens long, train_tokens long")


def _blocks(docs: DataFrame) -> DataFrame:
    """One row for each block of documents (id, trains, text): ids, fingerprints of words, and codes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j in slices(batch.column(2), BLOCK_BYTES):
                words = Words(batch.column(2).slice(i, j - i))
                trains = batch.column(1).slice(i, j - i).to_numpy(zero_copy_only=False).astype(np.uint8)
                counts = words.counts.astype(np.int32)
                vocab = fingerprints(words.vocab)
                order = np.argsort(vocab)  # sorted fingerprints pack well
                rank = np.empty(len(order), np.int32)
                rank[order] = np.arange(len(order), dtype=np.int32)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([number], pa.int64()),
                    "ids": pa.array([batch.column(0).slice(i, j - i)], pa.list_(pa.int64())),
                    "trains": [planes(trains)], "counts": [planes(counts)], "vocab": [pack_sorted(vocab[order])],
                    "codes": [planes(rank[words.codes])],
                    "tokens": [int(counts.sum()) + len(counts)],
                    "train_tokens": [int(counts[trains > 0].sum() + trains.sum())]})
                number += 1

    return docs.mapInArrow(pack, _BLOCK_SCHEMA)


def _unpack(row: dict) -> list[_Block]:
    """A block's documents in parts of about ``PART_TOKENS`` tokens, or one longer document."""
    vocab, codes = unpack_sorted(row["vocab"]), unplanes(row["codes"], np.int32)
    counts, trains = unplanes(row["counts"], np.int32).astype(np.int64), unplanes(row["trains"], np.uint8) > 0
    ends = np.cumsum(counts)
    number = (ends + 2 * np.arange(1, len(ends) + 1)) // PART_TOKENS
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1), len(counts)]
    return [_Block(vocab, codes[ends[i] - counts[i]:ends[j - 1]], counts[i:j], trains[i:j])
            for i, j in zip(cuts, cuts[1:])]


def _totals(blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """(block, gram, bucket, totals, seen): training counts of a packet's n-grams over all blocks.

    ``seen`` is the number of distinct n-grams of the bucket that occur in training.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                parts = _unpack(row)
                for gram in range(1, order + 1):
                    keys, counts, _ = _distinct(parts, gram)
                    at = bucket_bounds(keys, buckets)
                    for i in range(0, buckets, 64):  # so that a block's packets are not held twice
                        some = [(b, pack_sorted(keys[at[b]:at[b + 1]]), planes(counts[at[b]:at[b + 1]]))
                                for b in range(i, min(i + 64, buckets)) if at[b + 1] > at[b]]
                        if some:
                            bucket, packed, counted = zip(*some)
                            yield pa.RecordBatch.from_pydict({
                                "gram": pa.array([gram] * len(some), pa.int32()), "bucket": pa.array(bucket, pa.int32()),
                                "block": pa.array([row["block"]] * len(some), pa.int64()),
                                "keys": pa.array(packed, pa.binary()), "counts": pa.array(counted, pa.binary())})

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in pdf["keys"]]
        counts = np.concatenate([unplanes(x, np.uint32) for x in pdf["counts"]]).astype(np.float64)
        distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.uint64)
        answer = np.split(sums[inverse], np.cumsum([len(k) for k in keys])[:-1])
        real = ~np.isin(distinct, _START)
        return pd.DataFrame({"block": pdf["block"], "gram": pdf["gram"], "bucket": pdf["bucket"],
                             "totals": [squeeze(a) for a in answer], "seen": int((sums[real] > 0).sum())})

    packets = blocks.mapInArrow(pack, "gram int, bucket int, block long, keys binary, counts binary")
    return packets.groupBy("gram", "bucket").applyInPandas(
        add_up, "block long, gram int, bucket int, totals binary, seen long")


def _read(parts: list[_Block], totals: list[np.ndarray], n_train: int, n_words: int, mu: float) -> dict[str, np.ndarray]:
    """Scores of a block's documents; totals[k]: counts of its distinct (k+1)-grams, ascending by key."""
    places = [_distinct(parts, k)[2] for k in range(1, len(totals) + 1)]
    scores = [_read_part(part, list(at), totals, n_train, n_words, mu) for part, *at in zip(parts, *places)]
    return {c: np.concatenate([x[c] for x in scores]) for c in scores[0]}


def _read_part(part: _Block, places: list[np.ndarray], totals: list[np.ndarray], n_train: int, n_words: int,
               mu: float) -> dict[str, np.ndarray]:
    read = part.read
    starts = np.flatnonzero(~read)  # a document's tokens begin with its start
    count = totals[0][places[0]].astype(np.float64)
    prob = (count + 0.5) / (n_train + 0.5 * (n_words + 1))
    base = np.where(read, np.log10(prob), 0.0)
    context = count  # how often the context that ends at a position was seen; its start: as a word
    weight = np.where(read, np.log10(prob), 0.0)
    for place, total in zip(places[1:], totals[1:]):
        has = (place >= 0) & read
        seen = np.where(has, total[np.maximum(place, 0)], 0).astype(np.float64)
        before = np.concatenate([[0.0], context[:-1]])  # of the state in which this token is read
        state = has & (before > 0)
        prob = np.where(state, (seen + mu * prob) / (before + mu), prob)
        arc = state & (seen > 0)
        failure = state & ~arc
        weight[arc] = np.log10(prob[arc])
        weight[failure] += np.log10(mu / (before[failure] + mu))
        context = seen
    add = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
    return {"n_tokens": add(read.astype(np.int64)), "n_known": add((read & (count > 0)).astype(np.int64)),
            "base_score": add(base), "score": add(weight)}


def score(docs: DataFrame, is_training, order: int = ORDER, mu: float = MU, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each document.

    ``is_training`` is a condition on the columns of ``docs``.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_training, F.lit(True)).alias("trains"),
                       F.col(text_col).cast("string").alias("text"))
    blocks = written(_blocks(rows), "lm-blocks")
    size = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("train_tokens"), F.lit(0))).first()
    buckets = max(4, int(size[0]) * order // NGRAMS_PER_BUCKET)
    totals = written(_totals(blocks, order, buckets), "lm-totals")
    n_words = totals.filter("gram = 1").groupBy("bucket").agg(F.max("seen").alias("seen")).agg(
        F.coalesce(F.sum("seen"), F.lit(0))).first()[0]
    n_train = int(size[1])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.select([c for c in left.column_names if c != "ids"]).to_pylist()[0]
        right = right.sort_by([("gram", "ascending"), ("bucket", "ascending")]).to_pylist()
        found = [np.concatenate([unsqueeze(x["totals"], np.uint64) for x in right if x["gram"] == k] or [np.zeros(0, np.uint64)])
                 for k in range(1, order + 1)]
        scores = _read(_unpack(row), found, n_train, int(n_words), mu)
        return pa.table({"id": left.column("ids").chunk(0).flatten(), **{c: pa.array(v) for c, v in scores.items()}})

    scored = blocks.groupBy("block").cogroup(totals.select("block", "gram", "bucket", "totals").groupBy("block")).applyInArrow(
        run, "id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
                         "base_score", "score")
