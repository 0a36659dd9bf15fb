"""Maximal periodic runs of words, found at many scales by minimizers.

A run is a stretch of words with smallest period q that no neighbouring word extends. Periods below
``SHORT`` are found by comparing the words with themselves at each lag. For periods in [s, 2s) the
words are seen as grams of m = 2s/3 words, of which the least hash of every window of s words is its
minimizer. A run repeats its windows at the distance of its period, so it holds two equal minimizers
q apart; every such pair seeds an extension.

Grams that are periodic themselves (a period of at most m/2) would be minimizers everywhere in a
shorter run, so they take no part. The other grams recur at distances over m/2 only, which bounds the
pairs of each to a handful. A run whose first period holds nothing but periodic grams consists of the
ends of two runs of one shorter period that touch or overlap; its periods follow from these two.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clinchline.llm.common import mix, text_blocks

#: Least length of a run. Scales need runs from this length, so a smaller ``least`` is used below it.
LEAST = 12
#: First scale; shorter periods are scanned lag by lag.
SHORT = 18

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_SLICE = 1 << 20


def _words(text: str):
    """Lists of the words of a text; a long one is read in slices that end between words."""
    start = 0
    while start < len(text):
        end = start + _SLICE
        found = _SPACE.search(text, end) if end < len(text) else None
        end = found.start() if found else len(text)
        yield _WORD.findall(text, start, end)
        start = end


class Vocabulary(dict):
    """Numbers of words in order of first use."""

    def __init__(self):
        self.words: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number

    def numbers(self, text: str | None) -> np.ndarray:
        parts = [np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in _words(text or "")]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _slide(a: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` every ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        a = of(a[:-span], a[span:])
        span *= 2
    rest = width - span
    return of(a[:-rest], a[rest:]) if rest else a


def _prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] if n > 1 else out


def _smallest(ids: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch from ``start`` of period q, two periods long at least, has no smaller one."""
    first = ids[start : start + q]
    return not any(np.array_equal(first, ids[start + q // r : start + q // r + q]) for r in _prime_factors(q))


def _matches_right(ids: np.ndarray, p: int, lag: int) -> int:
    """The first place from p at which a word differs from that ``lag`` later."""
    step, end = 64, len(ids) - lag
    while p < end:
        stop = min(p + step, end)
        differ = ids[p:stop] != ids[p + lag : stop + lag]
        k = int(differ.argmax())
        if differ[k]:
            return p + k
        p, step = stop, 2 * step
    return end


def _matches_left(ids: np.ndarray, p: int, lag: int) -> int:
    """The first place up to p from which on words equal those ``lag`` later."""
    step = 64
    while p > 0:
        stop = max(p - step, 0)
        differ = (ids[stop:p] != ids[stop + lag : p + lag])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return p - k
        p, step = stop, 2 * step
    return 0


def _lag_scan(ids: np.ndarray, q: int, least: int) -> list[tuple[int, int, int]]:
    differ = np.flatnonzero(ids[q:] != ids[:-q])
    edges = np.concatenate(([-1], differ, [len(ids) - q]))
    same = np.diff(edges) - 1
    hits = np.flatnonzero(same >= max(least, 2 * q) - q)
    found = [(int(edges[k]) + 1, int(edges[k + 1]) + q, q) for k in hits]
    return [run for run in found if _smallest(ids, run[0], q)]


def _seeds(grams: np.ndarray, periodic: np.ndarray, s: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, place) of pairs of equal minimizers s to 2s - 1 apart, by lag and place."""
    value = np.where(periodic, _NONE, grams)
    least = _slide(value, width, np.minimum)
    pad = np.zeros(width - 1, dtype=np.uint64)
    over = _slide(np.concatenate((pad, least, pad)), width, np.maximum)
    place = np.flatnonzero((value == over) & (value != _NONE))
    order = np.argsort(value[place], kind="stable")
    place, value = place[order], value[place][order]
    lags, places = [], []
    for t in range(1, len(place)):
        near = (value[t:] == value[:-t]) & (place[t:] - place[:-t] < 2 * s)
        if not near.any():
            break
        lag = (place[t:] - place[:-t])[near]
        lags.append(lag[lag >= s])
        places.append(place[:-t][near][lag >= s])
    if not lags:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    lags, places = np.concatenate(lags), np.concatenate(places)
    order = np.lexsort((places, lags))
    return lags[order], places[order]


def _extended(ids: np.ndarray, lags: np.ndarray, places: np.ndarray):
    """Runs that hold a seed; seeds inside the stretch of an earlier one of their lag are passed over."""
    edges = np.flatnonzero(np.concatenate(([True], lags[1:] != lags[:-1], [True])))
    for first, last in zip(edges[:-1], edges[1:]):
        q, k = int(lags[first]), int(first)
        while k < last:
            p = int(places[k])
            end = _matches_right(ids, p, q)
            start = _matches_left(ids, p, q) if end > p else p
            if end - start >= q and _smallest(ids, start, q):
                yield start, end + q, q
            k = int(first + np.searchsorted(places[first:last], max(end, p + 1)))


def _across(ids: np.ndarray, known: np.ndarray, s: int):
    """Runs with periods of s to 2s - 1 across the border of two touching runs of one shorter period.

    In such a run the words before the border belong to one run and those after it to the other, so
    its period is the distance of equal places of their repeated word, and its ends are theirs. It has
    no smaller period: that would make the two runs one.
    """
    short = known[known[:, 2] <= s // 3]
    short = short[np.lexsort((short[:, 0], short[:, 2]))]
    a, b = short[:-1], short[1:]
    size = np.minimum(a[:, 1] - a[:, 0], b[:, 1] - b[:, 0])
    for k in np.flatnonzero((a[:, 2] == b[:, 2]) & (b[:, 0] <= a[:, 1]) & (size >= s)):
        (a1, b1, d), (a2, b2, _) = map(int, a[k]), map(int, b[k])
        word = ids[a2 : a2 + d]
        for x in np.flatnonzero(ids[b1 - 2 * d : b1 - d] == word[0]) + b1 - 2 * d:
            if np.array_equal(ids[x : x + d], word):
                break
        else:
            continue
        least = s + (a2 - int(x) - s) % d
        for q in range(least, min(2 * s, int(size[k]) + 1), d):
            start, end = max(a1, a2 - q), min(b1, b2 - q)
            if a1 == a2 - q and start < end:
                start = _matches_left(ids, start, q)
            if b1 == b2 - q and start < end:
                end = _matches_right(ids, end, q)
            if end - start >= q:
                yield start, end + q, q


def find_runs(ids: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, end, period) of all runs of ``least`` words or more, by start and period.

    ``ids`` are the numbers of the words of texts of ``sizes`` words; a number that occurs once closes
    each text, so no run spans two.
    """
    if not len(ids):
        return np.zeros((0, 3), dtype=np.int64)
    longest, keep_from = int(sizes.max()), min(least, LEAST)
    runs: list[tuple[int, int, int]] = []
    for q in range(1, min(SHORT, longest // 2 + 1)):
        runs += _lag_scan(ids, q, keep_from)
    s, m = SHORT, LEAST
    back = np.arange(len(ids))
    grams = None
    while 2 * s <= longest:
        inside = np.repeat(sizes >= 2 * s, sizes + 1)  # texts too short for this scale are left out
        mask = inside[back]
        if grams is None:
            one = mix((ids.astype(np.uint64) + np.uint64(1)) * _ODD)
            grams = np.zeros(len(ids), dtype=np.uint64)
            for j in range(m):
                grams[: len(ids) - j] = mix(grams[: len(ids) - j] * _ODD + one[j:])
                grams[len(ids) - j :] = mix(grams[len(ids) - j :] * _ODD)
            back, grams = back[mask], grams[mask]
        else:
            following = np.zeros_like(grams)
            following[: -m // 2] = grams[m // 2 :]
            grams = mix(grams * _ODD + following)
            back, grams = back[mask], grams[mask]
        known = np.array(runs, dtype=np.int64).reshape(-1, 3)
        step = np.zeros(len(ids) + 1, dtype=np.int32)
        covering = known[(known[:, 2] <= m // 2) & (known[:, 1] - known[:, 0] >= m)]
        np.add.at(step, covering[:, 0], 1)
        np.add.at(step, covering[:, 1] - m + 1, -1)
        periodic = np.cumsum(step[:-1])[back] > 0
        lags, places = _seeds(grams, periodic, s, s - m + 1)
        found = set(_across(ids, known, s))
        if len(lags):
            found.update(_extended(ids, lags, back[places]))
        runs += found
        s, m = 2 * s, 2 * m
    out = np.array(sorted(set(runs)), dtype=np.int64).reshape(-1, 3)
    out = out[out[:, 1] - out[:, 0] >= least]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def collapsed(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: a run keeps its first period."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 1], -1)
    return np.cumsum(step[:-1]) == 0


def _block(texts: list[str | None], least: int) -> list[tuple[int, np.ndarray, str]]:
    """(number of words, runs, collapsed text) of each text."""
    vocabulary = Vocabulary()
    numbers = [vocabulary.numbers(t) for t in texts]
    sizes = np.array([len(x) for x in numbers], dtype=np.int64)
    closed = [x for k, ids in enumerate(numbers) for x in (ids, [len(vocabulary.words) + k])]
    runs = find_runs(np.concatenate(closed).astype(np.int64), sizes, least)
    first = np.concatenate(([0], np.cumsum(sizes + 1)))
    edges = np.searchsorted(runs[:, 0], first)
    out = []
    for k, ids in enumerate(numbers):
        own = runs[edges[k] : edges[k + 1]] - [first[k], first[k], 0]
        kept = ids[collapsed(len(ids), own)]
        out.append((len(ids), own, " ".join(map(vocabulary.words.__getitem__, kept.tolist()))))
    return out


def periodic_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST
) -> DataFrame:
    """All maximal periodic runs of each text, and the text without their repetitions.

    One row per input row: the id, ``n_words``, ``runs`` (start, length, period; by start and period) of
    max(``least``, twice the period) words or more, and ``collapsed``: the words that lie in no run
    behind its first period, joined by one space. Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are. A null or empty
    text has no words, no runs and an empty collapsed text. Rows that repeat an id are worked on each on
    its own. Other columns are left out. A worker holds one block of texts, or one long text, at a time:
    about 100 bytes a word.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, last in text_blocks(texts):
                done = _block(texts[first:last], least)
                listed = [
                    [{"start": a, "length": b - a, "period": q} for a, b, q in runs.tolist()] for _, runs, _ in done
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, last - first),
                        pa.array([n for n, _, _ in done], pa.int64()),
                        pa.array(listed, run_type),
                        pa.array([text for _, _, text in done], pa.string()),
                    ],
                    ["id", "n_words", "runs", "collapsed"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(
        run,
        f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string",
    )
    return found.withColumnRenamed("id", id_column)


def longest_run(runs: Column) -> Column:
    """The run of greatest length; of equal ones that of smallest start, then period; null without runs."""
    ranked = F.transform(runs, lambda r: F.struct((-r["length"]).alias("rank"), r["start"], r["period"]))
    best = F.array_min(ranked)
    return F.when(
        best.isNotNull(),
        F.struct(best["start"].alias("start"), (-best["rank"]).alias("length"), best["period"].alias("period")),
    )


def with_repeated_tails(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Documents of which every tenth, by a hash of its id, repeats a stretch of its words up to its end.

    With h = crc32 of the id and g = h / 10, rows with h % 10 = 0 and n words go on from word a = g % n
    by repeating 1 + (n - a) / (3 + g % 8) words; their words are joined by one space. Rows with a null
    id or without words stay as they are.
    """
    h = F.crc32(F.col(id_column).cast("string"))
    rows = docs.select(
        F.col(id_column),
        F.col(text_column).alias("text"),
        F.when(h % 10 == 0, F.regexp_extract_all(F.col(text_column), F.lit(r"([^\x20\x09-\x0D]+)"), 1)).alias("w"),
        F.floor(h / 10).alias("g"),
    )
    n = F.size("w")
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    place = F.sequence(F.lit(0), n - 1)
    tail = F.transform(place, lambda i: F.get("w", F.when(i < a, i).otherwise(a + (i - a) % p)))
    edited = F.when(n > 0, F.array_join(tail, " ")).otherwise(F.col("text"))
    return rows.select(F.col(id_column), edited.alias("text"))
