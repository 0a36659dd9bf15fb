"""Nearest neighbours by multi-index hashing of learned binary codes.

A rotation of the principal directions is learned on a bounded sample so that the signs of the rotated
vectors lose least (iterative quantization). The signs are a vector's code. Codes are cut into
substrings, each with an index of its own: of two codes at most r = M a + b bits apart, one of the first
b + 1 substrings differs in at most a bits, or one of the others in at most a - 1 (pigeonhole), so
probing these finds every code within r. What is found is ranked by the distance of the vectors.

The radius follows from the distances. On the sample it is learned within how many bits the codes of
vectors at a distance lie (a quantile); a query is done when its radius reaches what its k-th nearest
distance so far calls for. Rows are spread over shards, and queries pass through every shard in
batches, so neither a bucket nor the query set is ever held as a whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clinchline.llm.common import partitions, staged

#: Rows that the rotation and the radius are learned on: those of smallest hash.
SAMPLE_ROWS = 8192
#: Most rows of a shard; vectors, codes and index take about 700 bytes a row of 64 floats while it is built.
#: A query passes through every shard: at 500,000 rows a shard and a query for every 100 rows, the
#: queries sent are about twice the table at 100 million rows.
SHARD_ROWS = 1 << 19
#: A smaller shard is not worth a task of its own.
LEAST_SHARD_ROWS = 1024
#: Bits of a code, at most; fewer components give shorter codes.
CODE_BITS = 64

_ROTATIONS = 40
_PAIR_ROWS = 512
_NEAR = 24


def usable(column: Column) -> Column:
    """Vectors that take part: not null, not zero, all components present and finite."""
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return column.isNotNull() & ~F.exists(column, wrong) & F.exists(column, lambda x: x != 0)


def codes(x: np.ndarray, mean: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """Signs of the rotated vectors as 64-bit numbers."""
    signs = (x - mean) @ rotation > 0
    weights = np.uint64(1) << np.arange(signs.shape[1], dtype=np.uint64)
    return (signs * weights).sum(axis=1, dtype=np.uint64)


def distances(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    d = x.astype(np.float64) - query
    return np.sqrt(np.sum(d * d, axis=1))


@dataclass
class Model:
    """What is learned on the sample; the sample itself bounds each query's k-th distance."""

    mean: np.ndarray
    rotation: np.ndarray
    reach: np.ndarray  # increasing distances
    radius: np.ndarray  # bits within which the codes of vectors at these distances lie
    sample: np.ndarray

    def radius_at(self, distance: float) -> int:
        k = int(np.searchsorted(self.reach, distance))
        return int(self.radius[k]) if k < len(self.radius) else self.rotation.shape[1]


def learn(x: np.ndarray, recall: float, seed: int = 0) -> Model:
    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    centred = x - mean
    bits = min(x.shape[1], CODE_BITS)
    _, directions = np.linalg.eigh(centred.T @ centred)
    directions = directions[:, ::-1][:, :bits]
    z = centred @ directions
    turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(_ROTATIONS):
        signs = np.where(z @ turn > 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(signs.T @ z)
        turn = (u @ vt).T
    rotation = directions @ turn
    code = codes(x, mean, rotation)
    far, bits_apart = [], []
    for i in rng.permutation(len(x))[:_PAIR_ROWS]:
        d = distances(x, x[i])
        near = np.argpartition(d, min(_NEAR, len(x) - 1))[: _NEAR + 1]
        some = np.concatenate((near, rng.integers(0, len(x), _NEAR)))
        some = some[d[some] > 0]
        far.append(d[some])
        bits_apart.append(np.bitwise_count(code[some] ^ code[i]))
    far, bits_apart = np.concatenate(far), np.concatenate(bits_apart).astype(np.int64)
    order = np.argsort(far, kind="stable")
    far, bits_apart = far[order], bits_apart[order]
    group = max(50, len(far) // 64)
    cuts = range(0, len(far), group)
    reach = np.array([far[c : c + group][-1] for c in cuts])
    radius = np.array([np.ceil(np.quantile(bits_apart[c : c + group], recall)) for c in cuts])
    return Model(mean, rotation, reach, np.maximum.accumulate(radius).astype(np.int64), x)


def _masks(width: int) -> list[np.ndarray]:
    """Numbers of ``width`` bits by how many are set."""
    numbers = np.arange(1 << width, dtype=np.int64)
    set_bits = np.bitwise_count(numbers)
    return [numbers[set_bits == k] for k in range(width + 1)]


class Shard:
    """Index of the distinct vectors of rows sorted by vector and id."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, model: Model, k: int):
        # equal vectors are one entry; none but its k + 1 smallest ids can be among k nearest
        new = _new(x)
        self.first = np.concatenate((np.flatnonzero(new), [len(x)]))
        self.x, self.ids, self.model, self.k = x[new], ids, model, k
        self.code = codes(self.x, model.mean, model.rotation)
        bits = model.rotation.shape[1]
        width = int(np.clip(np.log2(len(self.x) + 1), 4, 16))
        self.parts = max(1, round(bits / width))
        edges = np.linspace(0, bits, self.parts + 1).astype(int)
        self.width = np.diff(edges)
        self.masks = {w: _masks(int(w)) for w in set(self.width.tolist())}
        self.index = []
        for low, w in zip(edges[:-1], self.width):
            part = ((self.code >> np.uint64(low)) & np.uint64((1 << int(w)) - 1)).astype(np.int64)
            by_part = np.argsort(part, kind="stable")
            self.index.append((int(low), by_part, np.searchsorted(part[by_part], np.arange((1 << int(w)) + 1))))
        self.bits = bits

    def _probe(self, code: int, part: int, away: int) -> np.ndarray:
        """Entries whose substring differs in exactly ``away`` bits."""
        low, order, first = self.index[part]
        w = int(self.width[part])
        if away > w:
            return order[:0]
        keys = self.masks[w][away] ^ ((code >> low) & ((1 << w) - 1))
        start, size = first[keys], first[keys + 1] - first[keys]
        start, size = start[size > 0], size[size > 0]
        if not len(size):
            return order[:0]
        ends = np.cumsum(size)
        return order[np.arange(ends[-1]) + np.repeat(start - (ends - size), size)]

    def nearest(self, query: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(entry, distance) of what is found; ``bound``: k others lie at this distance at most."""
        code = int(codes(query[None], self.model.mean, self.model.rotation)[0])
        seen = np.zeros(len(self.x), dtype=bool)
        own = np.uint64(code)
        entries, found = [], []
        best = np.zeros(0)
        radius, r = self.model.radius_at(bound), 0
        while r <= radius:
            new = self._probe(code, r % self.parts, r // self.parts)
            new = new[~seen[new]]
            seen[new] = True
            new = new[np.bitwise_count(self.code[new] ^ own) <= radius]
            if len(new):
                d = distances(self.x[new], query)
                entries.append(new)
                found.append(d)
                # an entry of many ids counts once, and the query's own not at all: a safe bound
                best = np.sort(np.concatenate((best, d)))[: self.k + 1]
                if len(best) > self.k:
                    bound = min(bound, float(best[-1]))
                    radius = min(radius, self.model.radius_at(bound))
            r += 1
        if not entries:
            return np.zeros(0, dtype=np.int64), best
        return np.concatenate(entries), np.concatenate(found)

    def search(self, query: np.ndarray, bound: float, ids: list[int]):
        """(query id, vec_id, distance) of the k nearest found for each id that has this query vector."""
        entries, d = self.nearest(query, bound)
        keep = np.argsort(d, kind="stable")
        # entries that tie with the last place may hold smaller ids
        if len(keep) > self.k + 1:
            keep = keep[d[keep] <= d[keep[self.k]]]
        members = [self.ids[self.first[e] : self.first[e + 1]][: self.k + 1] for e in entries[keep]]
        if not members:
            return
        near = np.repeat(d[keep], [len(m) for m in members])
        vec = np.concatenate(members)
        order = np.lexsort((vec, near))
        near, vec = near[order], vec[order]
        for own in ids:
            other = np.flatnonzero(vec != own)[: self.k]
            yield own, vec[other], near[other]


def _new(x: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    return np.concatenate(([True], np.any(x[1:] != x[:-1], axis=1)))


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    recall: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The k nearest other rows that are found for each row for which ``queries`` (on ``id``) holds.

    Returns ``query_id``, ``rank`` (from 1, ties to the smaller id), ``vec_id`` and ``score``, the Euclidean
    distance of the vectors as they are, in double precision. Every code within a query's radius is found;
    ``recall`` is the share of neighbours that the radius is learned to cover, measured in the tests.
    Fewer than k others: all of them come back, as no k-th distance shortens the radius.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows with a
    null id, nor vectors with another number of components than most rows have (of two equally
    frequent numbers the smaller). Rows that repeat id and vector are one; a repeated id with another
    vector is an entry, or a query, of its own, and no row is near to one of its own id. Other columns
    are not read. Ids are whole numbers.
    """
    spark = vectors.sparkSession
    floats = vectors.schema[vector_column].dataType.simpleString() == "array<float>"
    value = F.col(vector_column).cast("array<float>" if floats else "array<double>")
    rows = (
        vectors.select(F.col(id_column).cast("long").alias("id"), value.alias("v"))
        .where(F.col("id").isNotNull() & usable(F.col("v")))
        .withColumn("n", F.size("v"))
    )
    counts = rows.groupBy("n").count().orderBy(F.desc("count"), "n").first()
    none = "query_id long, rank int, vec_id long, score double"
    if counts is None:
        return spark.createDataFrame([], none)
    rows = staged(rows.where(F.col("n") == counts["n"]).select("id", "v").distinct(), "vectors")
    total = counts["count"]
    picked = rows.orderBy(F.xxhash64("id"), "id", "v").limit(sample_rows).toPandas()
    model = learn(np.array(picked["v"].tolist(), dtype=np.float64), recall)
    shards = max(-(-total // SHARD_ROWS), min(partitions(spark), -(-total // LEAST_SHARD_ROWS)))
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        """Rows of a shard come first, then the queries; then those of the next shard."""
        model = sent.value
        held, ids, shard, index = [], [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, own = _vectors(batch.column("v")), batch.column("id").to_numpy()
            asker = batch.column("asker").to_numpy()
            of = batch.column("shard").to_numpy()
            asks = batch.column("query").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(of) | np.diff(asks)) + 1
            out = []
            for first, last in zip([0, *edges], [*edges, len(of)]):
                if of[first] != shard:
                    held, ids, shard, index = [], [], of[first], None
                if not asks[first]:
                    held.append(x[first:last])
                    ids.append(own[first:last])
                    continue
                if index is None:
                    index = Shard(np.concatenate(held), np.concatenate(ids), model, k) if held else False
                    held, ids = [], []
                if index:
                    out += _answers(index, x[first:last], own[first:last], asker[first:last], model, k)
            if out:
                columns = [pa.array(np.concatenate([row[j] for row in out])) for j in range(4)]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "asker", "vec_id", "score"])

    shard = lambda: F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int")
    rows = rows.withColumn("asker", F.xxhash64("v"))
    entries = rows.withColumns({"shard": shard(), "query": F.lit(False)})
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = rows.where(queries).withColumns({"shard": every, "query": F.lit(True)})
    # one shard a partition; equal vectors follow each other: one entry, and one search a batch
    laid = entries.unionByName(asked).repartitionById(shards, "shard")
    found = laid.sortWithinPartitions("shard", "query", "v", "id").mapInArrow(
        run, "query_id long, asker long, vec_id long, score double"
    )
    place = Window.partitionBy("query_id", "asker").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _answers(index: Shard, x: np.ndarray, own: np.ndarray, asker: np.ndarray, model: Model, k: int) -> list:
    """Answers to queries of which equal vectors follow each other."""
    edges = [*np.flatnonzero(_new(x)), len(x)]
    out = []
    for first, last in zip(edges[:-1], edges[1:]):
        query = x[first].astype(np.float64)
        d = distances(model.sample, query)
        # the sample may hold the query's own row, which is not counted
        bound = float(np.partition(d, k)[k]) if len(d) > k else np.inf
        for query_id, vec, near in index.search(query, bound, own[first:last].tolist()):
            out.append((np.full(len(vec), query_id), np.full(len(vec), asker[first]), vec, near))
    return out
