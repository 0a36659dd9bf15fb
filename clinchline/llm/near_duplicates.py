"""MinHash near-duplicates with sequential Bayesian verification.

Texts become sets of word shingles and MinHash signatures; equal sets are folded into one
representative. Banded signatures propose candidates. A candidate pair's signatures are compared
a batch at a time, and the pair is dropped as soon as the posterior probability that its
similarity reaches the threshold (uniform prior) is below ``miss``; what survives is verified
on the full sets of both whole texts. Verified links are joined to components.

Candidates of a bucket are not all its pairs. First each member meets the smallest one of its
bucket. Then only members of the bucket that are still in different components meet: their
pairs are compared inside tasks, a large bucket being split in blocks whose pairs of blocks are
dealt out. Members with a pair that passes the posterior test meet once more with their texts,
and only verified links leave the task, one for two components. So no link between components is
lost, and a group of many copies costs about as many rows as it has members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clinchline.llm.common import Words, batch_of, mix, sent, shingles, staged, text_blocks
from clinchline.llm.components import connected_components

#: Hashes of a band; the number of bands follows from the threshold and ``miss``.
BAND_ROWS = 5
#: Signature entries that are compared before the posterior is looked at again.
COMPARED = 20
#: Members of a bucket that meet inside one task.
BLOCK = 1024


def bands_for(threshold: float, miss: float) -> int:
    """Bands with which a pair at the threshold shares none with probability ``miss`` at most."""
    share = threshold**BAND_ROWS
    return max(1, math.ceil(math.log(miss) / math.log(1 - share))) if share < 1 else 1


def least_matches(threshold: float, miss: float, size: int) -> np.ndarray:
    """For each number n of compared entries: matches below which the pair is dropped.

    With a uniform prior, m matches of n leave P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    least = np.zeros(size + 1, dtype=np.int64)
    for n in range(1, size + 1):
        total, m = 0.0, -1
        while total < miss and m < n:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        least[n] = m
    return least


def _signatures(shingle_words: int, size: int):
    schema = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("ha", pa.int64()), ("hb", pa.int64()),
         ("sig", pa.binary())]
    )
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            texts = batch.column("text").to_pylist()
            for i, j in text_blocks(texts):
                hashes, docs = shingles(Words(texts[i:j]), shingle_words)
                n = np.bincount(docs, minlength=j - i)
                full = np.flatnonzero(n)
                ha = np.zeros(j - i, dtype=np.uint64)
                hb = np.zeros(j - i, dtype=np.uint64)
                sig = np.zeros((j - i, size), dtype=np.uint16)
                if len(full):
                    at = np.searchsorted(docs, full)
                    ha[full] = np.add.reduceat(mix(hashes), at)
                    hb[full] = np.bitwise_xor.reduceat(mix(hashes + np.uint64(77)), at)
                    for k in range(size):
                        low = np.minimum.reduceat(mix_to(hashes, a[k]), at)
                        sig[full, k] = (mix(low.astype(np.uint64)) >> np.uint64(20)).astype(np.uint16)
                yield batch_of(
                    schema,
                    id=ids.slice(i, j - i),
                    n=n,
                    ha=ha.view(np.int64),
                    hb=hb.view(np.int64),
                    sig=[row.tobytes() for row in sig],
                )

    return run


def mix_to(x: np.ndarray, a: np.uint64) -> np.ndarray:
    """One member of a family of hash functions of mixed 64-bit numbers; 32 bits."""
    return ((x * a) >> np.uint64(32)).astype(np.uint32)


def _band_keys(size: int, bands: int):
    schema = pa.schema([("key", pa.int64()), ("band", pa.int32()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column("sig"), size).astype(np.uint64)
            keys = np.empty((len(sig), bands), dtype=np.uint64)
            for b in range(bands):
                acc = np.full(len(sig), b + 1, dtype=np.uint64)
                for k in range(BAND_ROWS):
                    acc = mix(acc + sig[:, b * BAND_ROWS + k])
                keys[:, b] = acc
            ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), bands)
            band = np.tile(np.arange(bands, dtype=np.int32), len(sig))
            yield batch_of(schema, key=keys.ravel().view(np.int64), band=band, id=ids)

    return run


def _matrix(column, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, size)


def _likely(a, b, na, nb, num: int, den: int, least: np.ndarray) -> np.ndarray:
    """Which pairs of signatures pass the sequential posterior test."""
    alive = np.flatnonzero(den * np.minimum(na, nb) >= num * np.maximum(na, nb))
    matches = np.zeros(len(alive), dtype=np.int64)
    for start in range(0, a.shape[1], COMPARED):
        end = min(start + COMPARED, a.shape[1])
        matches += (a[alive, start:end] == b[alive, start:end]).sum(axis=1)
        go = matches >= least[end]
        alive, matches = alive[go], matches[go]
    return alive


def _prune(size: int, num: int, den: int, least: np.ndarray):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = _likely(
                _matrix(batch.column("sig_a"), size),
                _matrix(batch.column("sig_b"), size),
                batch.column("n_a").to_numpy(),
                batch.column("n_b").to_numpy(),
                num, den, least,
            )
            yield batch.select(["a", "b"]).take(pa.array(keep)).cast(schema)

    return run


def _likely_pairs(table: pa.Table, size: int, num: int, den: int, least: np.ndarray):
    """(root, i, others): members of a (bucket, block, block) and whom they may be linked with.

    Only pairs of different components count, and of those the ones whose first common band is the
    bucket's, so that a pair meets in one bucket only. ``root`` holds each member's component; the
    caller may merge components in it, which takes their pairs out.
    """
    ids = table.column("id").to_numpy()
    root = table.column("comp").to_numpy().copy()
    n = table.column("n").to_numpy()
    own = table.column("own").to_numpy()
    band = table.column("band")[0].as_py()
    same = table.column("bi")[0].as_py() == table.column("bj")[0].as_py()
    sig = _matrix(table.column("sig").combine_chunks(), size)
    for i in range(len(ids)):
        if not same and not own[i]:
            continue
        other = np.flatnonzero(root != root[i])
        other = other[ids[other] > ids[i]] if same else other[own[other] != own[i]]
        if len(other):
            k = _likely(
                np.broadcast_to(sig[i], (len(other), size)), sig[other],
                np.full(len(other), n[i]), n[other], num, den, least,
            )
            other = other[k]
        if len(other) and band:
            before = (sig[other, : band * BAND_ROWS] == sig[i, : band * BAND_ROWS]).reshape(len(other), band, BAND_ROWS)
            other = other[~before.all(axis=2).any(axis=1)]
        if len(other):
            yield root, i, other


def _involved(size: int, num: int, den: int, least: np.ndarray):
    """The members of a group that have a likely pair: (key, bi, bj, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            rows = [np.append(other, i) for _, i, other in _likely_pairs(table, size, num, den, least)]
            if rows:
                found = table.select(["key", "bi", "bj", "id"]).take(pa.array(np.unique(np.concatenate(rows))))
                yield from found.combine_chunks().to_batches()

    return run


def _linked(size: int, num: int, den: int, least: np.ndarray, shingle_words: int):
    """Links between components, verified on full sets; of two components of a group one link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            sets: dict[int, np.ndarray] = {}

            def of(i: int) -> np.ndarray:
                if i not in sets:
                    if len(sets) >= BLOCK:
                        sets.clear()
                    sets[i] = shingles(Words([table.column("text")[i].as_py()]), shingle_words)[0]
                return sets[i]

            ids = table.column("id").to_numpy()
            found = []
            for root, i, other in _likely_pairs(table, size, num, den, least):
                for j in other:
                    if root[i] != root[j]:
                        both = np.isin(of(i), of(j), assume_unique=True).sum()
                        if den * both >= num * (len(of(i)) + len(of(j)) - both):
                            found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                            root[root == root[j]] = root[i]
            if found:
                a, b = zip(*found)
                yield batch_of(schema, a=a, b=b)

    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole (key, bi, bj) groups of two rows or more, of rows sorted by them."""
    rest: list[pa.RecordBatch] = []
    for batch in _chain(batches):
        if batch is not None:
            rest += [batch] if batch.num_rows else []
        if not rest:
            continue
        table = pa.Table.from_batches(rest)
        key = [table.column(c).to_numpy() for c in ("key", "bi", "bj")]
        cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        bounds = [0, *cut.tolist(), table.num_rows]
        if batch is not None:  # the last group may go on
            bounds.pop()
            rest = table.slice(bounds[-1]).combine_chunks().to_batches()
        for i, j in zip(bounds[:-1], bounds[1:]):
            if j - i > 1:
                yield table.slice(i, j - i)


def _chain(batches):
    yield from batches
    yield None


def _verify(shingle_words: int, num: int, den: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[int | None, np.ndarray | None] = (None, None)
        for batch in batches:
            a, b, texts = (batch.column(c).to_pylist() for c in ("a", "b", "text_b"))
            keep = []
            for i, j in text_blocks(texts):
                hashes, docs = shingles(Words(texts[i:j]), shingle_words)
                at = np.searchsorted(docs, np.arange(j - i + 1))
                for r in range(i, j):
                    if known[0] != a[r]:
                        known = (a[r], shingles(Words([batch.column("text_a")[r].as_py()]), shingle_words)[0])
                    other = hashes[at[r - i] : at[r - i + 1]]
                    both = np.isin(other, known[1], assume_unique=True).sum()
                    if den * both >= num * (len(other) + len(known[1]) - both):
                        keep.append(r)
            yield batch_of(schema, a=[a[r] for r in keep], b=[b[r] for r in keep])

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    threshold: tuple[int, int] = (80, 100),
    miss: float = 1e-6,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; documents are linked where
    ``den * |A and B| >= num * |A or B|`` for ``threshold = (num, den)``. ``component_id`` is
    the smallest id reachable over links, ``kept`` marks the document that has it. ``miss`` bounds the probability that
    banding overlooks a pair at the threshold; a pair is dropped once its posterior is below ``miss``. It is looked at
    after every batch of its signature, so in all a pair at the threshold is overlooked with a probability of
    at most ``miss`` times one more than the number of looks.

    Texts that are null, empty or without words have no shingles, are linked with nothing and
    kept. Shorter texts than a shingle are one shingle. Repeated rows of an id each get a row
    and are one document with each other; a null id is a component of its own, with a null
    ``component_id``, and is kept. Ids may have any type that has an order; those that are not whole numbers are
    numbered first, which is one more shuffle of the texts. Other columns of ``docs`` are ignored. No
    documents, no rows.
    """
    if docs.schema[id_col].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct().orderBy("id")
        ids = staged(ids.withColumn("number", F.monotonically_increasing_id()), "numbers")
        rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id", "left")
        found = near_duplicates(rows, "number", "text", shingle_words, threshold, miss)
        smallest = ids.select(F.col("id").alias("smallest"), F.col("number").alias("component_id"))
        return (
            found.join(ids, "number", "left")
            .join(smallest, "component_id", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.col("smallest").alias("component_id"), "kept")
        )
    num, den = threshold
    t = num / den
    bands = bands_for(t, miss)
    size = bands * BAND_ROWS
    least = least_matches(t, miss, size)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = staged(
        source.mapInArrow(
            _signatures(shingle_words, size), "id long, n long, ha long, hb long, sig binary"
        ),
        "sets",
    )
    named = sets.where("n > 0 and id is not null")
    reps = staged(
        named.groupBy("n", "ha", "hb").agg(F.min("id").alias("id"), F.min("sig").alias("sig")),
        "representatives",
    )
    keyed = reps.select("id", "sig").mapInArrow(_band_keys(size, bands), "key long, band int, id long")
    shared = staged(
        keyed.join(
            keyed.groupBy("key").agg(F.min("id").alias("center"), F.count("*").alias("members")),
            "key",
        ).where("members > 1"),
        "buckets",
    )

    def texts_of(ids: DataFrame) -> DataFrame:
        return source.join(sent(ids.distinct()), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))

    side = lambda s: reps.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
    star = (
        shared.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    )
    pairs = staged(
        star.join(side("b"), "b").join(side("a"), "a").mapInArrow(
            _prune(size, num, den, least), "a long, b long"
        ),
        "pairs",
    )
    texts = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("id")))
    links = staged(
        pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_verify(shingle_words, num, den), "a long, b long"),
        "links",
    )
    found = connected_components(links)
    member = shared.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "band", "id", "members", F.coalesce("component", "id").alias("comp")
    )
    open_keys = (
        member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    )
    # members of a bucket's largest component need not meet each other: they have blocks of their own,
    # numbered behind those of the rest, and meet the rest's blocks only
    sizes = member.join(open_keys, "key").groupBy("key", "comp").agg(F.count("*").alias("size"))
    largest = F.max(F.struct("size", (-F.col("comp")).alias("comp")))
    halves = sizes.groupBy("key").agg(largest.alias("core"), F.sum("size").alias("members")).select(
        "key",
        (-F.col("core.comp")).alias("core"),
        F.ceil((F.col("members") - F.col("core.size")) / BLOCK).cast("int").alias("loose_blocks"),
        F.ceil(F.col("core.size") / BLOCK).cast("int").alias("core_blocks"),
    )
    hashed, core = F.xxhash64("id"), F.col("comp") == F.col("core")
    loose, cores = F.col("loose_blocks"), F.col("core_blocks")
    dealt = (
        member.join(halves, "key")
        .join(reps.select("id", "n", "sig"), "id")
        .withColumn("block", F.when(core, loose + F.pmod(hashed, cores)).otherwise(F.pmod(hashed, loose)).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(core, loose).otherwise(loose + cores) - 1)))
        .select(
            "key", "band", "id", "comp", "n", "sig",
            F.least("block", "other").alias("bi"),
            F.greatest("block", "other").alias("bj"),
            (F.col("block") <= F.col("other")).alias("own"),
        )
    )
    dealt = staged(dealt, "dealt")
    involved = staged(
        dealt.repartition("key", "bi", "bj")
        .sortWithinPartitions("key", "bi", "bj")
        .mapInArrow(_involved(size, num, den, least), "key long, bi int, bj int, id long"),
        "involved",
    )
    more = staged(
        dealt.join(involved, ["key", "bi", "bj", "id"])
        .join(texts_of(involved.select("id")), "id")
        .repartition("key", "bi", "bj")
        .sortWithinPartitions("key", "bi", "bj")
        .mapInArrow(_linked(size, num, den, least, shingle_words), "a long, b long"),
        "links",
    )
    if not more.isEmpty():
        found = connected_components(links.union(more))
    components = staged(
        named.join(reps.select("n", "ha", "hb", F.col("id").alias("node")), ["n", "ha", "hb"])
        .join(found, "node", "left")
        .groupBy("id")
        .agg(F.min(F.coalesce("component", "node")).alias("component_id")),
        "components",
    )
    return (
        sets.select("id", "n")
        .join(components, "id", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
        )
    )
