"""A quality classifier on statistics of whole documents.

Random Fourier features approximate Gaussian kernels over the statistics. Tasks sum normal
equations of their rows, the sums of a bounded number of groups are added on the driver, and
ridge scores are solved there. Two folds score each other for the choice of the penalty and for
isotonic calibration, which is fitted on counts in a fixed grid of scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clinchline.llm.common import staged

#: Random features; the normal equations of a task take FEATURES squared numbers.
FEATURES = 256
#: Groups in which the tasks' sums are added before they reach the driver.
SUM_GROUPS = 16
#: Widths of the two kernels, in units of the root of the number of statistics.
WIDTHS = (0.5, 1.5)
PENALTIES = tuple(10.0**k for k in range(-3, 4))
#: Steps of the grid of raw scores (-1 to 2) on which calibration counts labels.
GRID = 3000

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))
_DIGITS = b"0123456789"
_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#$%&*@^~<>{}[]\\_=+"
_HIGH = bytes(range(128, 256))
_COUNTED = (_UPPER, _LETTERS, _DIGITS, _SPACE, _SYMBOLS, b"!", b"|", b".", b",", _HIGH, b"?;:'\"()-/")
STATISTICS = len(_COUNTED) + 14


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text; all zero for a null or empty one."""
    if not text:
        return [0.0] * STATISTICS
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    out = [math.sqrt((n - len(raw.translate(None, c))) / n) for c in _COUNTED]
    words = text.split()
    w = max(len(words), 1)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    m = max(len(lines), 1)
    lengths = [len(x) for x in lines]
    return out + [
        math.log1p(n),
        math.log1p(len(words)),
        n / w if words else 0.0,
        len(counts) / w,
        len(counts) / math.sqrt(w),
        max(counts.values(), default=0) / w,
        sum(map(str.isupper, words)) / w,
        sum(map(str.isalpha, words)) / w,
        sum(map(str.istitle, words)) / w,
        math.log1p(max(map(len, words), default=0)),
        math.log1p(len(lines)),
        math.log1p(sum(lengths) / m),
        math.log1p(max(lengths, default=0)),
        len(set(lines)) / m,
    ]


def document_statistics(docs: DataFrame, id_col: str, text_col: str, carried: tuple[str, ...] = ()) -> DataFrame:
    """(id, stats, ``carried`` columns) for every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(stats, pa.list_(pa.float32())), *batch.columns[2:]],
                ["id", "stats", *carried],
            )

    return docs.select(id_col, text_col, *carried).mapInArrow(run, f"id {kind}, stats array<float>{more}")


@dataclass
class QualityModel:
    """Standardisation, random features, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    grid: np.ndarray
    curve: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = random_features(stats, self.mean, self.scale) @ self.weights
        smooth = 1 / (1 + np.exp(-4 * (np.clip(raw, -10, 10) - 0.5)))
        return 0.99 * np.interp(raw, self.grid, self.curve) + 0.01 * smooth


def random_features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, and a constant."""
    rng = np.random.default_rng(7)
    x = np.clip((stats - mean) / scale, -4, 4)
    width = np.repeat(np.array(WIDTHS), (FEATURES - 1) // 2 + 1)[: FEATURES - 1] * math.sqrt(stats.shape[1])
    omega = rng.standard_normal((stats.shape[1], FEATURES - 1)) / width
    phase = rng.uniform(0, 2 * math.pi, FEATURES - 1)
    wave = np.cos(x @ omega + phase) * math.sqrt(2 / (FEATURES - 1))
    return np.hstack([wave, np.ones((len(x), 1))])


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("stats")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), STATISTICS).astype(np.float64)


def _normal_sums(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Per fold: the summed matrix of (features, label)' (features, label)."""
    shape = (2, FEATURES + 1, FEATURES + 1)
    schema = pa.schema([("slot", pa.int32()), ("sums", pa.binary())])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                y = batch.column("quality").to_numpy(zero_copy_only=False).astype(np.float64)
                z = np.hstack([random_features(_stats_of(batch), mean, scale), y[:, None]])
                fold = batch.column("fold").to_numpy(zero_copy_only=False)
                for f in (0, 1):
                    total[f] += z[fold == f].T @ z[fold == f]
        slot = TaskContext.get().partitionId() % SUM_GROUPS
        yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()])], schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(shape), False
        for batch in batches:
            for x in batch.column("sums"):
                total += np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(shape)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()])], schema=schema)

    parts = rows.mapInArrow(part, "slot int, sums binary").repartition(SUM_GROUPS, "slot")
    groups = parts.mapInArrow(add, "slot int, sums binary").collect()
    return sum((np.frombuffer(r.sums).reshape(shape) for r in groups), np.zeros(shape))


def _ridge(sums: np.ndarray, penalty: float) -> np.ndarray:
    gram = sums[:-1, :-1].copy()
    gram[np.diag_indices(FEATURES - 1)] += penalty
    gram[-1, -1] += 1e-9
    return np.linalg.solve(gram, sums[:-1, -1])


def _loss(sums: np.ndarray, w: np.ndarray) -> float:
    return float(w @ sums[:-1, :-1] @ w - 2 * w @ sums[:-1, -1] + sums[-1, -1])


def isotonic(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators of ``total / weight`` over ascending ``x``: (x, value) of the blocks."""
    blocks: list[list[float]] = []
    for a, w, t in zip(x, weight, total):
        blocks.append([a * w, w, t])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([a / w for a, w, _ in blocks]), np.array([t / w for _, w, t in blocks])


def fit_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """Fit on all labelled rows of ``stats`` whose crc32(id as text) mod 3 is not 1.

    Rows without a label are not used; several labels of an id are averaged. With no labelled row
    every score is 0.5; with labels of one kind all scores are near it.
    """
    marks = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.avg(label_col).cast("double").alias("quality"))
    )
    rows = staged(
        stats.join(marks, "id").where(~held_out("id"))
        .withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(2)).cast("int")),
        "training",
    )
    moments = rows.agg(
        F.count("*"),
        *[f(F.col("stats")[i].cast("double")) for i in range(STATISTICS) for f in (F.avg, F.stddev_pop)],
    ).first()
    if not moments[0]:
        zero, even = np.zeros(STATISTICS), np.zeros(FEATURES)
        even[-1] = 0.5
        return QualityModel(zero, zero + 1, even, np.array([0.0]), np.array([0.5]))
    mean, scale = np.array(moments[1::2]), np.array(moments[2::2])
    scale = np.where(scale > 1e-9, scale, 1.0)
    sums = _normal_sums(rows, mean, scale)
    penalty = min(PENALTIES, key=lambda p: _loss(sums[0], _ridge(sums[1], p)) + _loss(sums[1], _ridge(sums[0], p)))
    crossed = np.stack([_ridge(sums[1], penalty), _ridge(sums[0], penalty)])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                fold = batch.column("fold").to_numpy(zero_copy_only=False)
                value = (random_features(_stats_of(batch), mean, scale) * crossed[fold]).sum(axis=1)
                step = np.clip(np.round((value + 1) / 3 * GRID), 0, GRID).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("quality")], ["step", "quality"])

    counts = (
        rows.mapInArrow(raw, "step int, quality double")
        .groupBy("step")
        .agg(F.count("*").alias("n"), F.sum("quality").alias("good"))
        .orderBy("step")
        .collect()
    )
    step, n, good = (np.array(c, dtype=np.float64) for c in zip(*counts))
    grid, curve = isotonic(step * 3 / GRID - 1, n, good)
    return QualityModel(mean, scale, _ridge(sums[0] + sums[1], penalty), grid, curve)


def held_out(id_col: str):
    """Whether crc32(id as text) mod 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (0 to 1), predicted (score >= 0.5), ``carried`` columns.

    Only statistics of the whole text enter a score; labels of held-out rows are never read. Null
    and empty texts have zero statistics and are scored like any other. Repeated rows get equal
    scores; null ids are scored and never learned from; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    stats = staged(document_statistics(docs, id_col, text_col, carried), "statistics")
    model = fit_quality(stats.select("id", "stats"), labels, id_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = model.score(_stats_of(batch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(score), *batch.columns[2:]], ["id", "score", *carried]
                )

    return stats.mapInArrow(run, f"id {kind}, score double{more}").select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *carried,
    )
