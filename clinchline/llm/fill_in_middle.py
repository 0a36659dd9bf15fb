"""Fill-in-middle arrangements of documents as piece tables.

A document's text is never edited. It is a list of pieces (buffer, start, length) over two immutable
buffers, its UTF-8 bytes and the sentinels. A cut splits a piece, an arrangement permutes pieces, the
inverse permutation restores the text, and a digest streams the pieces without joining them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Marks of prefix, suffix and middle; a text that holds one stays as it is.
SENTINELS = (b"<P>", b"<S>", b"<M>")
#: Order of prefix (0), middle (1) and suffix (2) in each form; every part follows its own sentinel.
FORMS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}

_TEXT, _MARKS = 0, 1
_MARK_BUFFER = memoryview(b"".join(SENTINELS))
_MARK_OF_PART = (0, 2, 1)  # sentinel of prefix, middle, suffix
_CHUNK = 1 << 16


class Piece(NamedTuple):
    buffer: int
    start: int
    length: int


def _mark(part: int) -> Piece:
    k = _MARK_OF_PART[part]
    return Piece(_MARKS, sum(map(len, SENTINELS[:k])), len(SENTINELS[k]))


def cut(pieces: Sequence[Piece], at: int) -> list[Piece]:
    """The pieces with a border ``at`` bytes from their start; a cut at a border gives an empty piece."""
    out, before = [], 0
    for i, p in enumerate(pieces):
        if before <= at <= before + p.length:
            head = at - before
            split = [Piece(p.buffer, p.start, head), Piece(p.buffer, p.start + head, p.length - head)]
            return [*out, *split, *pieces[i + 1 :]]
        out.append(p)
        before += p.length
    raise ValueError(f"cut at {at} of {before} bytes")


def permuted(pieces: Sequence[Piece], order: Sequence[int]) -> list[Piece]:
    return [pieces[k] for k in order]


def inverse(order: Sequence[int]) -> list[int]:
    out = [0] * len(order)
    for place, k in enumerate(order):
        out[k] = place
    return out


def stream(pieces: Sequence[Piece], buffers: Sequence[memoryview]) -> Iterator[memoryview]:
    for p in pieces:
        yield buffers[p.buffer][p.start : p.start + p.length]


def digest(pieces: Sequence[Piece], buffers: Sequence[memoryview]) -> str:
    sha = hashlib.sha256()
    for part in stream(pieces, buffers):
        sha.update(part)
    return sha.hexdigest()


class CodePoints:
    """Code points of UTF-8 bytes: their number, and the byte at which each begins."""

    def __init__(self, data: memoryview):
        self.bytes = np.frombuffer(data, dtype=np.uint8)
        counts = [
            np.count_nonzero((self.bytes[i : i + _CHUNK] & 0xC0) != 0x80) for i in range(0, len(data), _CHUNK)
        ]
        self.before = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        self.count = int(self.before[-1])

    def byte(self, k: int) -> int:
        if k >= self.count:
            return len(self.bytes)
        chunk = int(np.searchsorted(self.before, k, side="right")) - 1
        first = chunk * _CHUNK
        starts = np.flatnonzero((self.bytes[first : first + _CHUNK] & 0xC0) != 0x80)
        return first + int(starts[k - int(self.before[chunk])])


def arrange(text: memoryview, key: str, kept_percent: int, spm_percent: int) -> tuple[dict, list[Piece]]:
    """Form, lengths and pieces of a text; ``key`` decides the cuts and the form."""
    points = CodePoints(text)
    n = points.count
    hashed = hashlib.sha256(key.encode()).hexdigest()
    h = [int(hashed[8 * i : 8 * i + 8], 16) for i in range(4)]
    whole = [Piece(_TEXT, 0, len(text))]
    out = {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None}
    raw = bytes(text)
    if n == 0 or h[2] % 100 >= 100 - kept_percent or any(s in raw for s in SENTINELS):
        return out, whole
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    parts = cut(cut(whole, points.byte(last)), points.byte(first))
    form = "spm" if h[3] % 100 < spm_percent else "psm"
    marked = [[_mark(part), piece] for part, piece in enumerate(parts)]
    pieces = [p for pair in permuted(marked, FORMS[form]) for p in pair]
    return out | {"form": form, "prefix_chars": first, "middle_chars": last - first}, pieces


def restored(output: memoryview, form: str) -> list[Piece]:
    """Pieces of an arranged output that give the text again.

    The text holds no sentinel and no text byte can complete one, so the first of each is the mark.
    """
    if form == "plain":
        return [Piece(_TEXT, 0, len(output))]
    raw, order, at, parts = bytes(output), FORMS[form], 0, []
    for part, following in zip(order, [*order[1:], None]):
        at += len(SENTINELS[_MARK_OF_PART[part]])
        end = len(raw) if following is None else raw.index(SENTINELS[_MARK_OF_PART[following]], at)
        parts.append(Piece(_TEXT, at, end - at))
        at = end
    return permuted(parts, inverse(order))


def _views(column: pa.Array) -> list[memoryview]:
    """Bytes of the strings, in place; null is empty."""
    return [memoryview(v.as_buffer() if v.is_valid else b"") for v in column.cast(pa.binary())]


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def fill_in_middle(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = 1,
    kept_percent: int = 10,
    spm_percent: int = 20,
) -> DataFrame:
    """Each document as prefix, suffix, middle (psm), suffix, prefix, middle (spm), or unchanged (plain).

    One row per input row: the id, ``n`` (code points), ``form``, ``prefix_chars`` and ``middle_chars``
    (null if plain), ``pieces`` (the descriptors: buffer 0 is the text, 1 the sentinels; bytes),
    ``output``, and ``output_sha256``. SHA-256 of ``seed:id`` places both cuts and picks the form, so a
    row's result depends on nothing but the row. A null text counts as empty; empty texts and texts
    that hold a sentinel are plain. A null id is hashed as an empty one. Rows that repeat an id are
    arranged each on its own. Other input columns are left out. Ids may have any type that casts to a string.
    """
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).alias("key"),
        F.col(text_column).alias("text"),
    )
    pieces_type = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))

    def run(batches):
        for batch in batches:
            done, outputs = [], []
            for key, text in zip(batch.column("key").to_pylist(), _views(batch.column("text"))):
                row, pieces = arrange(text, key, kept_percent, spm_percent)
                buffers = (text, _MARK_BUFFER)
                row["pieces"] = [p._asdict() for p in pieces]
                row["output_sha256"] = digest(pieces, buffers)
                outputs.append(b"".join(stream(pieces, buffers)))
                done.append(row)
            column = lambda name, kind: pa.array([r[name] for r in done], kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    column("n", pa.int64()),
                    column("form", pa.string()),
                    column("prefix_chars", pa.int64()),
                    column("middle_chars", pa.int64()),
                    column("pieces", pieces_type),
                    _strings(outputs),
                    column("output_sha256", pa.string()),
                ],
                ["id", "n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(
        run,
        f"id {kind}, n long, form string, prefix_chars long, middle_chars long,"
        " pieces array<struct<buffer:int,start:long,length:long>>, output string, output_sha256 string",
    )
    return found.withColumnRenamed("id", id_column)


def restore(arranged: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The exact texts again, from ``output`` and ``form`` alone; adds ``text`` and ``restored_sha256``.

    All columns but ``output`` and ``pieces`` of the arranged rows stay.
    """
    kept = arranged.drop("pieces", "text", "restored_sha256")

    def run(batches):
        for batch in batches:
            texts, digests = [], []
            for output, form in zip(_views(batch.column("output")), batch.column("form").to_pylist()):
                pieces = restored(output, form)
                texts.append(b"".join(stream(pieces, (output,))))
                digests.append(digest(pieces, (output,)))
            same = [n for n in batch.schema.names if n != "output"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in same), _strings(texts), pa.array(digests, pa.string())],
                [*same, "text", "restored_sha256"],
            )

    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != "output"
    )
    return kept.mapInArrow(run, f"{fields}, text string, restored_sha256 string")
