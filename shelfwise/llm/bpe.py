"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task takes its documents in blocks.  The distinct pieces (matches of the split pattern) of a block
form a small corpus: their bytes lie in one symbol array, and an inverted index leads from a merge
(the rank of the joined bytes of a symbol pair) to the positions where that pair stands.  Merges are
replayed in rank order; each touches only its positions and re-indexes their two neighbours.  The ids
of a text are then gathered from the ids of its pieces.

Pieces seen before in the task are remembered up to ``MEMO_PIECES`` (memory only, never results).
Nothing is shuffled; the rank table (a vocabulary file, bounded) is the only broadcast.

Defined results: a null or empty text has no ids and decodes to empty bytes; ids that are null decode
to empty bytes; an id outside the vocabulary, or null within the list, raises.  Repeated rows, null or
repeated ids of documents and extra columns pass through; an existing column named like the output is
replaced.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain as flat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfwise.llm.common import ship, slices, tidy

#: Pieces remembered in a task between blocks.
MEMO_PIECES = 150_000
#: Text bytes whose new pieces are replayed together, text bytes split at once, and ids decoded at once.
REPLAY_BYTES = 4 << 20
SPLIT_BYTES = 1 << 20
DECODE_IDS = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class Merges:
    """Symbol pairs that a vocabulary joins, and the rank of what they become."""

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.shift = max(ranks.values()).bit_length()
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << self.shift | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of what the pairs (a, b) become, -1 where nothing joins them."""
        key = a.astype(np.int64) << self.shift | b
        if not len(self.keys):
            return np.full(len(key), -1, np.int32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], np.int32(-1))

    def byte_pairs(self) -> np.ndarray:
        """``rank`` of all pairs of single bytes."""
        a, b = np.divmod(np.arange(65536), 256)
        return self.rank(self.byte_ids[a], self.byte_ids[b]).reshape(256, 256)


class _Index:
    """The inverted index: positions of the pairs that become a rank, and the ranks still to replay."""

    def __init__(self):
        self.at: dict[int, list[np.ndarray]] = {}
        self.todo: list[int] = []

    def add(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        begin = np.concatenate([[0], cuts])
        for r, i, j in zip(ranks[begin].tolist(), begin.tolist(), [*cuts.tolist(), len(ranks)]):
            if r in self.at:
                self.at[r].append(positions[i:j])
            else:
                self.at[r] = [positions[i:j]]
                heapq.heappush(self.todo, r)

    def pop(self) -> tuple[int, np.ndarray]:
        r = heapq.heappop(self.todo)
        return r, np.unique(np.concatenate(self.at.pop(r)))


def replay(pieces: list[bytes], merges: Merges, byte_pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one after the other, and where each piece's ids end."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
    n = len(data)
    if not n:
        return np.zeros(0, np.int32), ends
    last = np.zeros(n, bool)
    last[ends[ends > 0] - 1] = True
    here = np.arange(n, dtype=np.int32)  # a block holds far less than 2^31 bytes
    sym = merges.byte_ids[data]
    nxt = np.where(last, np.int32(-1), here + np.int32(1))
    prv = np.where(np.concatenate([[True], last[:-1]]), np.int32(-1), here - np.int32(1))
    rank = np.full(n, -1, np.int32)  # of the pair that begins at a position
    rank[:-1] = np.where(last[:-1], -1, byte_pairs[data[:-1], data[1:]])
    alive = np.ones(n, bool)
    index = _Index()
    some = np.flatnonzero(rank >= 0).astype(np.int32)
    if len(some):
        index.add(rank[some], some)
    while index.todo:
        r, p = index.pop()
        p = p[rank[p] == r]  # a neighbour's merge may have taken one of the two symbols
        if len(p) > 1 and (touch := nxt[p[:-1]] == p[1:]).any():
            # Pairs that share a symbol: from the left, every other pair of such a run.
            nth = np.arange(len(p))
            run = np.maximum.accumulate(np.where(np.concatenate([[True], ~touch]), nth, 0))
            p = p[(nth - run) % 2 == 0]
        if not len(p):
            continue
        q = nxt[p]
        after = nxt[q]
        sym[p] = r
        nxt[p] = after
        alive[q] = False
        rank[q] = rank[p] = -1
        more = after >= 0
        prv[after[more]] = p[more]
        before = prv[p]
        left = before[before >= 0]
        heads = np.concatenate([p[more], left])
        if len(heads):
            k = merges.rank(sym[heads], sym[nxt[heads]])
            rank[heads] = k
            some = k >= 0
            if some.any():
                index.add(k[some], heads[some])
    kept = np.concatenate([[0], np.cumsum(alive)])
    return sym[alive].astype(np.int32), kept[ends]


class _Encoder:
    """Encodes arrays of texts, with the pieces of earlier blocks remembered."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.byte_pairs = merges, merges.byte_pairs()
        self.find = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.ends = np.zeros(0, np.int64)

    def __call__(self, texts: pa.Array) -> pa.ListArray:
        if len(self.place) > MEMO_PIECES:
            self.forget()
        codes, counts, new = [np.zeros(0, np.int32)], [0], []
        for i, j in slices(texts, SPLIT_BYTES):
            found = [self.find(t) if t else [] for t in texts.slice(i, j - i).to_pylist()]
            coded = pa.array(flat.from_iterable(found), pa.large_string()).dictionary_encode()
            pieces = coded.dictionary.to_pylist()
            for p in pieces:
                if p not in self.place:
                    self.place[p] = len(self.place)
                    new.append(p.encode())
            at = np.fromiter((self.place[p] for p in pieces), np.int32, len(pieces))
            codes.append(at[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else at[:0])
            counts += map(len, found)
        if new:
            ids, ends = replay(new, self.merges, self.byte_pairs)
            self.ends = np.concatenate([self.ends, ends + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        starts = np.concatenate([[0], self.ends])
        known = pa.LargeListArray.from_arrays(starts, pa.array(self.ids))
        codes = np.concatenate(codes)
        gathered = known.take(pa.array(codes)).flatten()
        upto = np.concatenate([[0], np.cumsum(np.diff(starts)[codes])])
        return pa.ListArray.from_arrays(pa.array(upto[np.cumsum(counts)], pa.int32()), gathered)


def encode(docs: DataFrame, vocab_path: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of ``text_col`` as an ``array<int>`` column ``out_col``."""
    spark = ship(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(vocab_path))
    keep = [c for c in docs.columns if c.lower() != out_col.lower() or c == text_col]
    docs = docs.select(*[f"`{c}`" for c in keep])
    names = [c for c in keep if c.lower() != out_col.lower()]
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(out_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or _Encoder(Merges(ranks.value), pattern)
            texts = batch.column(batch.schema.get_field_index(text_col))
            for i, j in slices(texts, REPLAY_BYTES):
                part = batch.slice(i, j - i)
                cols = [part.column(part.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*cols, encoder(texts.slice(i, j - i))], [*names, out_col])

    return docs.mapInArrow(tidy(run), schema)


def decode(df: DataFrame, vocab_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``df`` with the bytes of the ids of ``ids_col`` as a ``binary`` column ``out_col``."""
    spark = ship(df.sparkSession)
    ranks = spark.sparkContext.broadcast(read_ranks(vocab_path))
    keep = [c for c in df.columns if c.lower() != out_col.lower() or c == ids_col]
    df = df.select(*[f"`{c}`" for c in keep])
    names = [c for c in keep if c.lower() != out_col.lower()]
    schema = T.StructType([df.schema[c] for c in names] + [T.StructField(out_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            if table is None:
                tokens: list[bytes | None] = [None] * (max(ranks.value.values()) + 1)
                for token, rank in ranks.value.items():
                    tokens[rank] = token
                table = pa.array(tokens, pa.large_binary())
            lists = batch.column(batch.schema.get_field_index(ids_col))
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            i = 0
            while i < len(batch):
                j = max(i + 1, int(np.searchsorted(upto, upto[i] + DECODE_IDS, "right")) - 1)
                part = batch.slice(i, j - i)
                got = table.take(lists.slice(i, j - i).flatten())
                if got.null_count:
                    raise ValueError("an id is null or not in the vocabulary")
                byte_at = np.frombuffer(got.buffers()[1], np.int64)[:len(got) + 1] if len(got) else np.zeros(1, np.int64)
                ends = np.ascontiguousarray(byte_at[upto[i:j + 1] - upto[i]])
                decoded = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends), got.buffers()[2]])
                cols = [part.column(part.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays([*cols, decoded.cast(pa.binary())], [*names, out_col])
                i = j

    return df.mapInArrow(run, schema)
