"""Exact substring deduplication by a distributed merge sort of sparse suffixes.

Removed is every byte covered by a string of ``length`` bytes that also starts earlier. Each such
string (window) is charged to one suffix, the one that starts at its minimizer: the k-byte string
inside it with the least hash, the leftmost of equals. Equal windows have equal minimizers at
equal places, so only suffixes with equal first k bytes need to meet, one for about every 35 bytes.

1. A suffix with its windows is told apart by two hashes: of its first k bytes, and of all bytes
   of its windows (its context). Of equal contexts all but the first are removed right away.
   Suffixes whose first k bytes start one context only need nothing more.
2. What is left, the first of every context, is fetched from the texts, sorted in runs, front-coded
   (common prefix lengths and remaining bytes) and dealt out by the first k bytes.
3. Runs are merged by loser trees that keep the known common prefix with the last winner: they
   compare lengths of known prefixes first and bytes only beyond them. Suffixes that share k bytes
   come out together, and their windows are compared byte by byte.

First k bytes with very many contexts are not merged in one place: their windows are dealt out
one by one, by the window's bytes, each once per run.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from clinchline.llm.common import BLOCK_BYTES, PrefixHash, batch_of, partitions, staged

LENGTH = 100
#: Bytes of a minimizer.
K = 32
#: Contexts of equal first k bytes beyond which windows are dealt out one by one.
CROWD = 4096
#: Bytes of a run that a task sorts in memory.
RUN_BYTES = 8 << 20
_POSITION = (1 << 21) - 1
_ENTRY = struct.Struct("<qqBBBBB")  # doc, start, windows before, windows less one, common, rest, left


def _pieces(ids: list[int], texts: list[str | None], length: int):
    """Blocks of (doc, offset, bytes) of up to about BLOCK_BYTES; long texts overlap by length - 1."""
    block, size = [], 0
    for doc, text in zip(ids, texts):
        if doc is None or not text:
            continue
        raw = text.encode("utf-8", "surrogatepass")
        step = BLOCK_BYTES // 2
        for at in range(0, max(len(raw) - length + 1, 0), step):
            piece = raw[at : at + step + length - 1]
            if size and size + len(piece) > BLOCK_BYTES:
                yield block
                block, size = [], 0
            block.append((doc, at, piece))
            size += len(piece)
    if block:
        yield block


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, from running minima of blocks of w."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def _suffixes(length: int):
    schema = pa.schema([("kh", pa.int64()), ("ch", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist(), length):
                data = np.frombuffer(b"".join(p for _, _, p in block), dtype=np.uint8)
                ends = np.cumsum([len(p) for _, _, p in block])
                hashes = PrefixHash(data)
                starts = np.arange(len(data) - K + 1)
                kh = hashes.of(starts, starts + K)
                key = (kh & ~np.uint64(_POSITION)) | starts.astype(np.uint64)
                least = _sliding_min(key, length - K + 1) & np.uint64(_POSITION)
                q = np.arange(len(least))
                piece = np.searchsorted(ends, q, side="right")
                q = q[q + length <= ends[piece]]
                p = least[q].astype(np.int64)
                new = np.ones(len(q), dtype=bool)
                new[1:] = (p[1:] != p[:-1]) | (q[1:] != q[:-1] + 1)
                at = np.flatnonzero(new)
                first, last = q[at], q[np.append(at[1:], len(q)) - 1]
                p = p[at]
                shape = (p - first) << 8 | (last - first)
                ch = hashes.of(first, last + length) + shape.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                piece = piece[first]
                docs = np.array([d for d, _, _ in block], dtype=np.int64)[piece]
                begin = ends[piece] - np.array([len(x) for _, _, x in block])[piece]
                offset = np.array([o for _, o, _ in block], dtype=np.int64)[piece] + first - begin
                yield batch_of(
                    schema, kh=kh[p].view(np.int64), ch=ch.view(np.int64), doc=docs, at=offset << 16 | shape
                )

    return run


def _runs(length: int, buckets: int):
    """Sorted front-coded runs of the wanted suffixes; and windows of crowds seen before in the run."""
    schema = pa.schema([("bucket", pa.int32()), ("run", pa.binary()), ("doc", pa.int64()), ("at", pa.int64())])

    def flush(held: list[tuple]):
        held = sorted(set(held))
        by_bucket: dict[int, list[bytes]] = {}
        last: dict[int, bytes] = {}
        window: dict[int, bytes] = {}
        gone = []
        for bucket, right, left, doc, q, before, span in held:
            alone = span == 255
            if alone:
                if window.get(bucket) == right:
                    gone.append((doc, q << 16))
                    continue
                window[bucket] = right
                span = 0
            common = common_prefix(last.get(bucket, b""), right, 0)
            last[bucket] = right
            by_bucket.setdefault(bucket, []).append(
                pack_entry(doc, q, before, span, common, len(right) - common, len(left)) + right[common:] + left
            )
        rows = [(b, b"".join(x), None, None) for b, x in by_bucket.items()] + [(-1, None, d, a) for d, a in gone]
        names = schema.names
        return batch_of(schema, **dict(zip(names, zip(*rows)))) if rows else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i, doc in enumerate(batch.column("doc").to_pylist()):
                raw = batch.column("text")[i].as_py().encode("utf-8", "surrogatepass")
                for want in batch.column("wanted")[i].as_py():
                    at, crowded = want["at"], want["crowded"]
                    q, before, span = at >> 16, at >> 8 & 255, at & 255
                    if crowded:
                        for s in range(q, q + span + 1):
                            right = raw[s : s + length]
                            held.append((zlib.crc32(right) % buckets, right, b"", doc, s, 0, 255))
                            size += 2 * length
                    else:
                        p = q + before
                        right = raw[p : q + span + length]
                        held.append((zlib.crc32(right[:K]) % buckets, right, raw[q:p], doc, q, before, span))
                        size += 2 * length
                if size > RUN_BYTES:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def pack_entry(*fields: int) -> bytes:
    return _ENTRY.pack(*fields)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that share ``known`` bytes."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


class LoserTree:
    """Merge of front-coded sorted runs that never compares a known common prefix again.

    Every loser in the tree keeps its common prefix with the last overall winner. A challenger
    with a longer one is the smaller string; only equal ones are compared, beyond the prefix.
    """

    def __init__(self, runs: list[bytes]):
        self.runs = runs
        self.at = [0] * len(runs)
        self.head: list[bytes | None] = [b""] * len(runs)
        self.rest: list[tuple] = [()] * len(runs)
        self.known = [0] * len(runs)
        for r in range(len(runs)):
            self._next(r)
            self.known[r] = 0
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.loser = [-1] * self.size
        self.winner = self._build(1)

    def _next(self, r: int) -> None:
        run, at = self.runs[r], self.at[r]
        if at >= len(run):
            self.head[r], self.known[r] = None, -1
            return
        doc, q, before, span, common, rest, left = _ENTRY.unpack_from(run, at)
        at += _ENTRY.size
        self.head[r] = self.head[r][:common] + run[at : at + rest]
        self.rest[r] = (run[at + rest : at + rest + left], doc, q, before, span)
        self.known[r], self.at[r] = common, at + rest + left

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        if a < 0 or b < 0:
            return (b, a) if a < 0 else (a, b)
        if self.known[a] != self.known[b]:
            return (a, b) if self.known[a] > self.known[b] else (b, a)
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        common = common_prefix(x, y, self.known[a])
        if x[common:] <= y[common:]:
            self.known[b] = common
            return a, b
        self.known[a] = common
        return b, a

    def _build(self, node: int) -> int:
        if node >= self.size:
            r = node - self.size
            return r if r < len(self.runs) else -1
        winner, self.loser[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self):
        """(common prefix with the one before, string, left, doc, start, before, span) in order."""
        r = self.winner
        while r >= 0 and self.head[r] is not None:
            yield (self.known[r], self.head[r], *self.rest[r])
            self._next(r)
            node = (r + self.size) // 2
            while node >= 1:
                r, self.loser[node] = self._play(r, self.loser[node])
                node //= 2


def repeated_windows(group: list[tuple], length: int) -> list[tuple[int, int]]:
    """(doc, start << 16 | windows - 1) of windows that an earlier suffix of the group has too.

    ``group`` holds (right, left, doc, start, windows before the minimizer, windows - 1).
    """
    group = sorted(set(group), key=lambda g: (g[2], g[3]))  # a repeated row is the same document
    seen: set[tuple[int, bytes]] = set()
    out = []
    for right, left, doc, start, before, span in group:
        since = None
        for i in range(span + 1):
            back = before - i  # negative: the window starts behind the first byte of right
            window = left[i:] + right[: length - back] if back > 0 else right[-back : length - back]
            key = (back, window)
            if key in seen:
                since = i if since is None else since
            else:
                seen.add(key)
                if since is not None:
                    out.append((doc, (start + since) << 16 | (i - 1 - since)))
                    since = None
        if since is not None:
            out.append((doc, (start + since) << 16 | (span - since)))
    return out


def _merge(length: int):
    schema = pa.schema([("doc", pa.int64()), ("at", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("run").to_pylist()):
                by_bucket.setdefault(bucket, []).append(data)
        out: list[tuple[int, int]] = []
        for bucket in sorted(by_bucket):
            group: list[tuple] = []
            for common, *entry in LoserTree(by_bucket.pop(bucket)):
                if common < K and group:
                    out += repeated_windows(group, length) if len(group) > 1 else []
                    group = []
                group.append(tuple(entry))
            out += repeated_windows(group, length) if len(group) > 1 else []
            if len(out) > 100_000:
                yield batch_of(schema, doc=[d for d, _ in out], at=[a for _, a in out])
                out = []
        if out:
            yield batch_of(schema, doc=[d for d, _ in out], at=[a for _, a in out])

    return run


def _cut(length: int, kind: str, id_col: str):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for i, text in enumerate(batch.column("text")):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                gone = batch.column("gone")[i].values
                own: list[dict] = []
                if gone is not None and len(gone):
                    at = np.sort(gone.to_numpy())
                    start, end = at >> 16, np.maximum.accumulate((at >> 16) + (at & 255) + length)
                    new = np.append(True, start[1:] > end[:-1])
                    first = np.flatnonzero(new)
                    last = np.append(first[1:], len(at)) - 1
                    own = [{"start": int(a), "end": int(b)} for a, b in zip(start[first], end[last])]
                parts, reached = [], 0
                for s in own:
                    parts.append(raw[reached : s["start"]])
                    reached = s["end"]
                parts.append(raw[reached:])
                sizes.append(len(raw))
                spans.append(own)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                [id_col, "n_bytes", "removed", "kept"],
            )

    return run


def _numbered(texts: DataFrame) -> DataFrame:
    """``texts`` (key, text) with ``doc``: whole numbers in the order of the documents, null for a null key.

    Whole-number keys that do not repeat with another text are their own numbers. Otherwise the
    different (key, text) are sorted, by a hash of the text, and numbered; the texts are joined to
    these numbers, which is one more shuffle of them.
    """
    text = F.coalesce("text", F.lit(""))
    hashes = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b"))
    hashed = texts.withColumn("hashes", hashes)
    if texts.schema["key"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        seen = hashed.where("key is not null").groupBy("key").agg(F.min("hashes").alias("lo"), F.max("hashes").alias("hi"))
        if seen.where("lo <> hi").isEmpty():
            return texts.select("key", F.col("key").cast("long").alias("doc"), "text")
    numbers = staged(
        hashed.where("key is not null").select("key", "hashes").distinct().orderBy("key", "hashes").withColumn("doc", F.monotonically_increasing_id()),
        "numbers",
    )
    return hashed.join(numbers, ["key", "hashes"], "left").select("key", "doc", "text")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per document: id, n_bytes, ``removed`` (maximal spans of bytes), ``kept`` (the rest).

    Texts are UTF-8 bytes; a byte is removed if a string of ``length`` bytes covers it that also
    starts earlier: in a document of smaller id, or earlier in the same one. Strings are judged on
    the input and do not cross documents. Null and empty texts have no bytes. Rows that repeat id and
    text are one document and get equal rows; rows that repeat an id with another text are documents
    of their own, in the order of the texts' hashes. Ids may have any type that has an order. Rows with
    a null id have no place in the order: they keep all bytes and remove none. Other columns are
    ignored. ``length`` is at least ``K`` + 1 and at most 160.
    """
    if not K < length <= 160:
        raise ValueError(f"length must be over {K} and at most 160")
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = _numbered(docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")))
    same = Window.partitionBy("kh", "ch").orderBy("doc", "at")
    near = Window.partitionBy("kh")
    judged = staged(
        texts.select("doc", "text")
        .mapInArrow(_suffixes(length), "kh long, ch long, doc long, at long")
        .repartition("kh")
        .withColumn("first", F.rank().over(same) == 1)
        .withColumn("several", F.min("ch").over(near) != F.max("ch").over(near))
        .where("several or not first")
        .withColumn("contexts", F.count(F.when(F.col("first"), 1)).over(near))
        .select("doc", "at", "first", (F.col("contexts") > CROWD).alias("crowded")),
        "judged",
    )
    wanted = judged.where("first").groupBy("doc").agg(F.collect_set(F.struct("at", "crowded")).alias("wanted"))
    by_id = texts.repartition("doc")
    buckets = max(64, 4 * partitions(spark))
    runs = staged(
        by_id.join(wanted, "doc").select("doc", "text", "wanted").mapInArrow(
            _runs(length, buckets), "bucket int, run binary, doc long, at long"
        ),
        "runs",
    )
    merged = (
        runs.where("bucket >= 0").select("bucket", "run").repartition("bucket").mapInArrow(_merge(length), "doc long, at long")
    )
    gone = (
        judged.where("not first").select("doc", "at")
        .union(runs.where("bucket < 0").select("doc", "at"))
        .union(merged)
        .groupBy("doc")
        .agg(F.collect_set("at").alias("gone"))
    )
    return texts.join(gone, "doc", "left").select("key", "text", "gone").mapInArrow(
        _cut(length, kind, id_col),
        f"`{id_col}` {kind}, n_bytes long, removed array<struct<start: bigint, `end`: bigint>>, kept binary",
    )
