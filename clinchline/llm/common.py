"""What the operators share: staged tables, and fast hashes of the words of many texts."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Texts are worked on in blocks of about so many bytes, which bounds a Python worker's memory.
BLOCK_BYTES = 1 << 20
#: A list of ids up to this long (8 MB) is sent to all executors; a longer one is joined.
BROADCAST_IDS = 1_000_000
#: A block is hashed in 64-bit arithmetic modulo 2**64 with this odd multiplier.
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see; a local one only where the cluster names none (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        folder = _OWN.setdefault("folder", "") or f"file://{tempfile.mkdtemp(prefix='stages-')}"
        _OWN["folder"] = folder
    return folder.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def staged(df: DataFrame, what: str = "stage") -> DataFrame:
    """The rows as a table in the shared folder: lineage is cut, a lost executor costs a re-read."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sent(ids: DataFrame) -> DataFrame:
    """Different ids, to join texts with: as a broadcast while they are few, so that the texts stay where they are.

    Spark weighs a list by its estimated bytes alone and would rather shuffle all texts than send 30,000 ids.
    ``ids`` is read twice: stage it first when it is costly.
    """
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_blocks(texts: list[str | None], most: int = BLOCK_BYTES):
    """(first, last) of runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > most:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(texts):
        yield first, len(texts)


_TABLES: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE`` and its inverse to the powers 0 to n, modulo 2**64; kept, and grown on demand."""
    if "up" not in _TABLES or len(_TABLES["up"]) <= n:
        size = max(n + 1, 2 * BLOCK_BYTES)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _TABLES[name] = np.multiply.accumulate(out)
    return _TABLES["up"], _TABLES["down"]


def _byte_values() -> np.ndarray:
    if "bytes" not in _TABLES:
        _TABLES["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return _TABLES["bytes"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHash:
    """Hashes of any slices of a block of bytes, from one running sum."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_byte_values()[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal slices have equal hashes; different ones differ but for odds of about 2**-64."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a block of texts, A-Z in lower case, as hashes.

    ``doc`` holds the index of a word's text, ``start`` and ``end`` its bytes in the block,
    ``hash`` its 64-bit hash; ``first[i]:first[i + 1]`` are the words of text i.
    """

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(r) + 1 for r in raw], dtype=np.int64)
        self.ends = np.cumsum(sizes)  # a line feed closes each text, so no word spans two
        self.data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)]
        space = _SPACES[self.data]
        word = ~space
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.ends, self.start, side="right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.prefix = PrefixHash(self.data)
        self.hash = self.prefix.of(self.start, self.end)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, doc) of distinct k-word shingles of each text, by (doc, hash).

    A text of one to k - 1 words has one shingle, its whole sequence; a text without words none.
    """
    n = len(words.hash)
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < k))
    hashes, docs = [], []
    if n >= k:
        acc = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            acc = mix(acc + words.hash[j : n - k + 1 + j])
        whole = words.doc[: n - k + 1] == words.doc[k - 1 :]
        hashes.append(acc[whole])
        docs.append(words.doc[: n - k + 1][whole])
    for i in short:
        acc = np.zeros(1, dtype=np.uint64)
        for h in words.hash[words.first[i] : words.first[i + 1]]:
            acc = mix(acc + h)
        hashes.append(mix(acc + np.uint64(counts[i])))
        docs.append(np.array([i]))
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    hashes, docs = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    return hashes[new], docs[new]


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
