"""Helpers shared by the operators: scratch tables, word arrays, and packed packets of sorted keys.

Packets.  Several operators must look up or merge one key per word, shingle or n-gram of the
corpus.  One Spark row per key costs far more than the key, so a task packs the *sorted, distinct*
keys of a block of documents into one binary value per hash range ("bucket"); Spark shuffles these
packets by bucket, and a reduce task merges them as arrays.  Keys are 64-bit fingerprints, dealt
evenly whatever the input: a key that holds a third of all tokens still occurs once per block.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.plans import storage
from shelfwise.session import save

#: Text bytes that one block of documents holds at most (a single longer text is a block of its own).
BLOCK_BYTES = 12 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

M64 = (1 << 64) - 1


# ------------------------------------------------------------------ code on the executors
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once per application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}_code.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent).as_posix())
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def give_back() -> None:
    """Return the memory that this Python worker has freed to the system."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()  # also what numpy and Python have freed


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``; its task ends by giving back what it has freed.

    A worker idles beside the tasks that follow; what it keeps is memory that the executor lacks.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


# ------------------------------------------------------------------ scratch tables
def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a fresh one of this machine only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # The setting cannot change in a running session: the context's own folder stands in.
        context = spark.sparkContext
        if context._jsc.sc().getCheckpointDir().isEmpty():
            context.setCheckpointDir(tempfile.mkdtemp(prefix="llm-scratch-"))
        return context._jsc.sc().getCheckpointDir().get()
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared scratch folder and read it back."""
    return save(df, f"{scratch_root(df.sparkSession).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}")


class Scratch:
    """Scratch tables of one computation, so that those which nothing reads any more can go before it ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self._paths = spark, name, {}

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, written and read back; the shuffle files that made it are gone."""
        path = f"{scratch_root(self.spark).rstrip('/')}/llm-{self.name}-{uuid.uuid4().hex}"
        out = save(df, path)
        self._paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` returned; plans over them can no longer run."""
        for t in tables:
            storage.delete(self.spark, self._paths.pop(id(t))[1])


def checkpointed(df: DataFrame) -> DataFrame:
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id's text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


# ------------------------------------------------------------------ words of a block of texts
def slices(texts: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """(start, end) rows whose texts hold ``max_bytes`` together, or one longer text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if texts.type in (pa.string(), pa.binary()) else np.int64)
    offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
        yield i, min(j, len(texts))
        i = j


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts, A-Z lower-cased (null: no words).

    ``codes[ends[d-1]:ends[d]]`` are the words of text d, as places in ``vocab`` (list of bytes).
    """

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        word = ~_SPACE[raw]
        first = np.zeros(len(raw) + 1, bool)
        first[offsets] = True
        start = word.copy()
        start[1:] &= ~word[:-1] | first[1:-1]
        starts = np.flatnonzero(start)
        # A word stops before a space, the next text or the end.
        stop = word.copy()
        stop[:-1] &= ~word[1:] | start[1:]
        data = _LOWER[raw[word]]
        self.ends = np.searchsorted(starts, offsets[1:])
        at = np.concatenate([[0], np.cumsum(np.flatnonzero(stop) + 1 - starts)]).astype(np.int64)
        del word, first, start, stop
        tokens = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data)])
        coded = tokens.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
        self.vocab = coded.dictionary.to_pylist()

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ends, prepend=0)


def fingerprints(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def chain(h: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Fingerprint of a sequence extended by one more item, from the fingerprints of both."""
    return mix(h * np.uint64(0x9E3779B97F4A7C15) + nxt + np.uint64(0x632BE59BD9B4E019))


# ------------------------------------------------------------------ packets
def planes(a: np.ndarray) -> bytes:
    """An integer array with the bytes of equal significance side by side, so that it compresses."""
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.frombuffer(b, np.uint8).reshape(size, -1).T.copy().view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unplanes(b, np.uint64), dtype=np.uint64)


def squeeze(a: np.ndarray) -> bytes:
    return zlib.compress(planes(a), 1)


def unsqueeze(b: bytes, dtype) -> np.ndarray:
    return unplanes(zlib.decompress(b), dtype)


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Places at which sorted 64-bit keys pass from one of ``buckets`` equal hash ranges to the next."""
    edges = np.array([((b << 64) + buckets - 1) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges, "left"), [len(keys)]]).astype(np.int64)



# ------------------------------------------------------------------ whole groups of a sorted partition
def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, in order, of a partition sorted by ``keys`` (integers without nulls)."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        same = np.all([c == c[-1] for c in columns], axis=0)
        cut = int(np.argmax(same))
        if cut == 0 and rest:
            last = [rest[-1].column(rest[-1].schema.get_field_index(k))[-1].as_py() for k in keys]
            if [c[0] for c in columns] != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch)
            continue
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
        rest = [batch.slice(cut)]
    if rest:
        yield pa.Table.from_batches(rest)


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where the groups of a sorted table begin, and its length."""
    new = np.zeros(len(table), bool)
    new[0] = True
    for k in keys:
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), len(table))
