"""Mixture-controlled packing of documents into fixed-length token sequences.

Sources are queues of documents. Windows of ``window_tokens`` are filled by deficit round-robin:
a source's credit grows by its share of the window each round, it delivers as many whole tokens
as the credit covers and carries the rest (its deficit, below one token) to the next window.
What a source has delivered after w windows is therefore ``floor(w * credit)``, a closed form:
a document's place in its queue alone says which window it is dealt to, and where, so nothing
walks over windows, deficits carry across tasks, and every task packs its own documents. When a
queue runs dry, its share goes to the others, which starts a new phase of the same kind.
Windows are laid end to end and cut into sequences.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from clinchline.llm.common import staged
from clinchline.llm.secrets import default_ranks, rank_encoding

SEQUENCE_TOKENS = 1024
#: Tokens of a window: the stretch within which the mixture holds.
WINDOW_TOKENS = 64 * SEQUENCE_TOKENS
#: The id that ends every document.
END_ID = 0
#: Queues of their own, at most: sources named in the shares, then those of most tokens. The others
#: share ``TAIL_QUEUES`` queues, dealt by a hash, in which they follow each other.
OWN_QUEUES = 100_000
TAIL_QUEUES = 1024


@dataclass
class Phase:
    """Windows first .. first + count; per source the tokens delivered before, and the credit."""

    first: int
    count: int
    base: int
    before: dict[str, int]
    credit: dict[str, Fraction]
    names: list[str] = field(default_factory=list)

    def delivered(self, source: str, windows: int) -> int:
        """Tokens of ``source`` after ``windows`` windows of this phase."""
        return self.before[source] + int(self.credit[source] * windows)


def plan_phases(totals: dict[str, int], shares: dict[str, float] | None, window: int) -> list[Phase]:
    """The phases of a mixture, one more than sources that run dry at different times at most.

    ``shares`` None: in proportion to the tokens there are, so that all queues end together.
    A source without a share gets none while others last; then the rest is packed in proportion.
    """
    left = {s: n for s, n in sorted(totals.items()) if n > 0}
    done = {s: 0 for s in left}
    phases, first, base = [], 0, 0
    while left:
        wanted = {s: Fraction(shares.get(s, 0)) for s in left} if shares else {}
        if sum(wanted.values()) <= 0:
            wanted = {s: Fraction(n) for s, n in left.items()}
        wanted = {s: w for s, w in wanted.items() if w > 0}
        whole = sum(wanted.values())
        credit = {s: w * window / whole for s, w in wanted.items()}
        count = min(int(left[s] / c) for s, c in credit.items())
        if count == 0:  # a queue ends inside this window: it gives what it has
            count, credit = 1, {s: min(c, Fraction(left[s])) for s, c in credit.items()}
            if all(int(c) == 0 for c in credit.values()):
                credit = {s: Fraction(left[s]) for s in credit}
        given = {s: int(c * count) for s, c in credit.items()}
        phases.append(Phase(first, count, base, {s: done[s] for s in credit}, credit, sorted(credit)))
        for s, n in given.items():
            done[s] += n
            left[s] -= n
            if left[s] == 0:
                del left[s]
        first, base = first + count, base + sum(given.values())
    return phases


class Schedule:
    """Where a token of a source's queue lands in the packed stream."""

    def __init__(self, phases: list[Phase]):
        self.phases = phases
        self.of: dict[str, list[Phase]] = {}
        self.starts: dict[str, list[int]] = {}
        for p in phases:
            for s in p.names:
                self.of.setdefault(s, []).append(p)
                self.starts.setdefault(s, []).append(p.before[s])
        self._rows: dict[tuple[int, int], dict[str, int]] = {}

    def _window(self, phase: Phase, w: int) -> dict[str, int]:
        """Stream position of each source's part of window ``w`` of ``phase``."""
        key = (phase.first, w)
        if key not in self._rows:
            if len(self._rows) > 4096:
                self._rows.clear()
            at = phase.base + sum(int(c * w) for c in phase.credit.values())
            row = {}
            for s in phase.names:
                row[s] = at
                at += phase.delivered(s, w + 1) - phase.delivered(s, w)
            self._rows[key] = row
        return self._rows[key]

    def place(self, source: str, token: int) -> tuple[int, int]:
        """(stream position, tokens that follow without a gap, itself included) of a queue's token."""
        phase = self.of[source][bisect.bisect_right(self.starts[source], token) - 1]
        credit, local = phase.credit[source], token - phase.before[source]
        w = min(-(-(local + 1) // credit) - 1, phase.count - 1)
        start, end = phase.delivered(source, w), phase.delivered(source, w + 1)
        return self._window(phase, int(w))[source] + token - start, end - token


def encode_documents(docs: DataFrame, id_col: str, text_col: str, source_col: str, ranks: str) -> DataFrame:
    """Token ids of whole documents, and their place in the part of their queue that a task holds."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoding(ranks)
        chunk = TaskContext.get().partitionId()
        reached: dict[str, int] = {}
        for batch in batches:
            ids, sizes, starts, sources = [], [], [], []
            for source, text in zip(batch.column(2).to_pylist(), batch.column(1)):
                found = encoding.encode_to_numpy(text.as_py() or "", disallowed_special=())
                ids.append(found.astype("<u4" if encoding.max_token_value >> 16 else "<u2").tobytes())
                sizes.append(len(found) + 1)
                source = "" if source is None else source
                sources.append(source)
                starts.append(reached.get(source, 0))
                reached[source] = starts[-1] + len(found) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sources, pa.string()),
                    pa.array([chunk] * len(ids), pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["id", "source", "chunk", "start", "n", "ids"],
            )

    return docs.select(id_col, text_col, F.col(source_col).cast("string")).mapInArrow(
        run, f"id {kind}, source string, chunk int, start long, n long, ids binary"
    )


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shares: dict[str, float] | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    window_tokens: int = WINDOW_TOKENS,
    ranks: str | None = None,
) -> DataFrame:
    """One row per piece of a document: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its token ids, without special tokens, and ``END_ID``. Every id lies in one
    piece; sequences are full but for the last, which is shorter. ``shares`` are target token
    proportions by source (default: those of the input). Null texts are empty documents of one
    id; a null source is the source "". Repeated rows are documents of their own; null ids stay
    null; other columns are ignored; no rows give no rows. There may be any number of sources: beyond
    ``OWN_QUEUES`` those without a share and with the fewest tokens are mixed as ``TAIL_QUEUES`` joint queues.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    encoded = staged(encode_documents(docs, id_col, text_col, source_col, ranks or default_ranks()), "ids")
    parts = encoded.groupBy("source", "chunk").agg(F.sum("n").alias("part"))
    named = F.col("source").isin(*(shares or [])) if shares else F.lit(False)
    by_size = parts.groupBy("source").agg(F.sum("part").alias("tokens")).orderBy(named.desc(), F.desc("tokens"), "source")
    own = by_size.limit(OWN_QUEUES).select("source")
    largest = {r["source"]: r["tokens"] for r in by_size.limit(OWN_QUEUES + 1).collect()}
    queue = F.col("source")
    if len(largest) > OWN_QUEUES:
        own = staged(own, "queues").withColumn("own", F.lit(True))
        parts = parts.join(own, "source", "left")
        tail = F.concat(F.lit("tail "), F.pmod(F.xxhash64("source"), F.lit(TAIL_QUEUES)).cast("string"))
        # no source of its own has such a name: theirs begin otherwise
        queue = F.when(F.col("own"), F.concat(F.lit("own "), "source")).otherwise(tail)
        shares = {f"own {s}": share for s, share in shares.items()} if shares else None
    parts = parts.select(queue.alias("queue"), "source", "chunk", "part")
    before = Window.partitionBy("queue").orderBy("source", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(
        "queue", "source", "chunk", F.coalesce(F.sum("part").over(before), F.lit(0)).alias("base")
    )
    totals = largest
    if len(largest) > OWN_QUEUES:
        totals = {r[0]: r[1] for r in parts.groupBy("queue").agg(F.sum("part")).collect()}
    phases = plan_phases(totals, shares, window_tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule = Schedule(phases)
        for batch in batches:
            out: list[tuple] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("queue", "base", "start", "n")))
            for i, (source, base, start, n) in enumerate(rows):
                raw = batch.column("ids")[i].as_py()
                ids = np.zeros(n, dtype="<u4")
                ids[:-1] = np.frombuffer(raw, dtype="<u4" if len(raw) > 2 * (n - 1) else "<u2")
                data, at = memoryview(ids.tobytes()), 0
                while at < n:
                    stream, run_on = schedule.place(source, base + start + at)
                    run_on = min(run_on, n - at)
                    while run_on:
                        sequence, offset = divmod(stream, sequence_tokens)
                        take = min(run_on, sequence_tokens - offset)
                        out.append((i, at, take, zlib.crc32(data[4 * at : 4 * (at + take)]), n, sequence, offset))
                        at, stream, run_on = at + take, stream + take, run_on - take
            if out:
                row, *rest = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(row))] + [pa.array(c, pa.int64()) for c in rest],
                    [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )

    return (
        encoded.join(bases, ["source", "chunk"])
        .select("id", "queue", "base", "start", "n", "ids")
        .mapInArrow(
            run,
            f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
            "sequence_id long, offset long",
        )
    )
