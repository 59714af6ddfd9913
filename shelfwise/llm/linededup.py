"""Line dedup with two Bloom filters: only suspected repeats are shuffled and confirmed exactly.

Every task hashes the line keys of its documents into two filters: *once* (some document holds the
key) and *twice* (a second one does).  The filters are cut into segments and merged as a stream:
twice takes the bits that both sides' once have, once the bits of either.  A key held by two documents
is always in the merged twice; a key of one document is so only by chance.  Lines whose key is in it
are the suspects: only their (key, document) rows are shuffled, counted exactly, and the document that
keeps the key is chosen.

The merged filter has ``FILTER_BITS`` bits (8 MB), whatever the input, and is the only broadcast.  When
lines by far outnumber the bits, more lines are suspects and the shuffle grows towards all keys; the
result stays exact.  Give ``filter_bits`` about 16 times the number of lines where memory allows.

Defined results: a null or empty text is one empty line and stays as it is.  Rows with one doc_id are one
document when keys are counted.  A row with a null doc_id is kept whole and counts for nothing.  The
largest doc_id that holds a key keeps all lines with it.  An empty table gives no rows; extra columns
pass through (those named ``n_lines`` and ``n_dropped`` are replaced).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import mix, ship, slices, tidy

MIN_CHARS, MIN_DOCS = 20, 3
FILTER_BITS = 1 << 26
SEGMENTS = 64
HASHES = 4
#: Text bytes whose lines a task hashes together.
AT_ONCE = 4 << 20


def line_key(line: bytes) -> bytes:
    """The line without outer white space (ASCII), A-Z lower-cased."""
    return line.strip(b"\x20\t\n\x0b\x0c\r").lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)


def _keys(text: bytes | None, min_chars: int) -> set[bytes]:
    return {k for k in map(line_key, text.split(b"\n")) if _long_enough(k, min_chars)} if text else set()


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(hashes, HASHES) bit numbers."""
    step = mix(hashes) | np.uint64(1)
    return (hashes[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(bits)


def _add(filter_: np.ndarray, at: np.ndarray) -> None:
    at = at.ravel()
    np.bitwise_or.at(filter_, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))


def _has(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filter_[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(1)


def _hash_all(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def repeated_filter(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int = FILTER_BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> np.ndarray:
    """The filter of keys that at least two rows hold (and some others, by chance)."""
    ship(docs.sparkSession)
    size = bits // 8 // SEGMENTS

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            for i, j in slices(texts, AT_ONCE):
                held = [k for t in texts.slice(i, j - i).to_pylist() for k in _keys(t, min_chars)]
                hashes, counts = np.unique(_hash_all(held), return_counts=True)
                at = _positions(hashes, bits)
                _add(twice, at[(counts > 1) | _has(once, at)])
                _add(once, at)
        for s in range(SEGMENTS):
            a, b = once[s * size:(s + 1) * size], twice[s * size:(s + 1) * size]
            if a.any():
                yield pa.RecordBatch.from_pydict({"segment": pa.array([s], pa.int32()), "once": [zlib.compress(a, 1)],
                                                  "twice": [zlib.compress(b, 1)]})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (np.frombuffer(zlib.decompress(row[c]), np.uint8) for c in ("once", "twice"))
                if row["segment"] in merged:
                    once, twice = merged[row["segment"]]
                    twice |= b | (once & a)
                    once |= a
                else:
                    merged[row["segment"]] = [a.copy(), b.copy()]
        for s, (_, twice) in merged.items():
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s], pa.int32()), "twice": [zlib.compress(twice, 1)]})

    parts = (docs.filter(F.col(id_col).isNotNull()).select(F.col(text_col).cast("string"))
             .mapInArrow(tidy(build), "segment int, once binary, twice binary")
             .repartition(SEGMENTS, "segment").mapInArrow(merge, "segment int, twice binary"))
    out = np.zeros(bits // 8, np.uint8)
    for row in parts.collect():  # at most SEGMENTS rows, together the bytes of one filter
        out[row["segment"] * size:(row["segment"] + 1) * size] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return out


def dropped_keys(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = FILTER_BITS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keys): the keys whose lines each document loses; only documents that lose any."""
    twice = docs.sparkSession.sparkContext.broadcast(repeated_filter(docs, min_chars, bits, id_col, text_col))
    named = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", T.BinaryType()), named.schema["id"]])

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            for i, j in slices(texts, AT_ONCE):
                sets = [list(_keys(t, min_chars)) for t in texts.slice(i, j - i).to_pylist()]
                keys = [k for ks in sets for k in ks]
                hit = np.flatnonzero(_has(twice.value, _positions(_hash_all(keys), bits)))
                of = np.repeat(np.arange(i, j), [len(ks) for ks in sets])
                yield pa.RecordBatch.from_arrays([pa.array([keys[x] for x in hit.tolist()], pa.binary()),
                                                  batch.column(0).take(pa.array(of[hit]))], ["key", "id"])

    held = named.mapInArrow(tidy(suspects), schema).distinct()
    losing = held.groupBy("key").agg(F.count("*").alias("docs"), F.max("id").alias("keeper")).filter(F.col("docs") >= min_docs)
    return (held.join(losing.select("key", "keeper"), "key").filter(F.col("id") != F.col("keeper"))
            .groupBy("id").agg(F.collect_list("key").alias("keys")))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = FILTER_BITS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated lines of ``text_col``, with ``n_lines`` (before) and ``n_dropped``."""
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    lost = dropped_keys(docs, min_chars, min_docs, bits, id_col, text_col)
    rows = docs.select(*[f"`{c}`" for c in names])
    plain = [f"c{i}" for i in range(len(names))]  # no column of ``docs`` meets one of ``lost``
    joined = rows.toDF(*plain).join(lost, F.col(plain[names.index(id_col)]) == F.col("id"), "left").select(*plain, "keys")
    schema = T.StructType([*rows.schema, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index(text_col))
            texts, lines, drops = [], [], []
            for text, keys in zip(column.cast(pa.large_binary()).to_pylist(), batch.column(len(names)).to_pylist()):
                parts = (text or b"").split(b"\n")
                keep = parts
                if keys:
                    gone = set(keys)
                    keep = [p for p in parts if line_key(p) not in gone]
                    text = b"\n".join(keep)
                texts.append(text)
                lines.append(len(parts))
                drops.append(len(parts) - len(keep))
            cols = [batch.column(i) for i in range(len(names))]
            cols[names.index(text_col)] = pa.array(texts, pa.large_binary()).cast(pa.large_string()).cast(column.type)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lines, pa.int64()), pa.array(drops, pa.int64())],
                                             [*names, "n_lines", "n_dropped"])

    return joined.mapInArrow(tidy(rebuild), schema)
