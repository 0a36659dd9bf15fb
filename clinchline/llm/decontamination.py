"""Benchmark decontamination: a BM25 index of test items, searched by every training passage.

The index holds the test items; each passage (a window of words of a whole document, half
overlapping) is a query. Impacts are BM25 weights divided by the item's score for itself, so one
threshold suits all items; counts of items and words are those of the whole benchmark. Search is block-max WAND over blocks
of items: terms whose summed largest impacts cannot reach the slack are left to a constant
(the non-essential ones), the block maxima of the others bound a passage's score in each block,
and only blocks whose bound reaches the threshold are scored, item by item. The bounds never
undershoot, so all items above the threshold are retrieved. What is retrieved is scored and verified
in the windows of the item's own length in the passage: overlap of the question's five-word
shingles, and of the answer's words. So a long item does not widen the windows of the others.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clinchline.llm.common import Words, mix, staged, text_blocks

#: Items of an index; a larger benchmark is searched in parts of this size, one after the other.
INDEX_ITEMS = 20_000
#: Items of a block with common block maxima.
BLOCK_ITEMS = 8
#: Summed largest impacts of the terms that bounds replace by a constant.
SLACK = 0.05
K1, B = 1.2, 0.75
SHINGLE_WORDS = 5
#: Fewest words of a window; an item's window is twice the next power of two of its length.
LEAST_PASSAGE = 64


class Index:
    """Impact-ordered postings of one part of the test items, with block maxima.

    ``counts``: number of items, their mean length, and (word hashes, items that hold them) of the
    whole benchmark; by default those of the items given.
    """

    def __init__(self, items: list[tuple], k1: float = K1, b: float = B, counts: tuple | None = None):
        self.ids = [i for i, _, _ in items]
        whole = Words([f"{q}\n{a}" for _, q, a in items])
        n = len(items)
        self.lengths = np.diff(whole.first)
        self.longest = int(self.lengths.max(initial=0))
        self.terms, term = np.unique(whole.hash, return_inverse=True)
        pair, tf = np.unique(term * n + whole.doc, return_counts=True)
        t, item = np.divmod(pair, max(n, 1))
        if counts is None:
            total, mean, df = n, self.lengths.mean() if n else 0.0, np.bincount(t, minlength=len(self.terms))
        else:
            total, mean, (words, held) = counts
            known, first = np.unique(words, return_index=True)
            df = held[first][np.searchsorted(known, self.terms)]
        idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
        norm = k1 * (1 - b + b * self.lengths / max(mean, 1e-9))
        weight = idf[t] * tf * (k1 + 1) / (tf + norm[item])
        self.self_score = np.bincount(item, weight, minlength=n)
        self.impact = weight / self.self_score[item]
        self.item = item
        # of each item: its words by hash, and their impacts
        by_item = np.lexsort((t, item))
        cut = np.searchsorted(item[by_item], np.arange(1, n))
        self.words = np.split(self.terms[t[by_item]], cut)
        self.weights = np.split(self.impact[by_item], cut)
        half = np.maximum(self.lengths, LEAST_PASSAGE // 2)
        self.half = 1 << np.ceil(np.log2(half)).astype(np.int64)  # half an item's window
        self.stride = int(self.half.max(initial=LEAST_PASSAGE // 2))
        self.start = np.searchsorted(t, np.arange(len(self.terms) + 1))
        # block maxima of the essential terms
        self.blocks = -(-n // BLOCK_ITEMS)
        top = np.zeros(len(self.terms))
        np.maximum.at(top, t, self.impact)
        order = np.argsort(top)
        self.slight = np.zeros(len(self.terms), dtype=bool)
        self.slight[order[np.cumsum(top[order]) <= SLACK]] = True
        self.slack = float(top[self.slight].sum())
        key, at = np.unique(t * max(self.blocks, 1) + item // BLOCK_ITEMS, return_inverse=True)
        self.block_max = np.zeros(len(key))
        np.maximum.at(self.block_max, at, self.impact)
        term_of, self.block = np.divmod(key, max(self.blocks, 1))
        self.block_start = np.searchsorted(term_of, np.arange(len(self.terms) + 1))
        question, answer = Words([q for _, q, _ in items]), Words([a for _, _, a in items])
        self.width = np.minimum(SHINGLE_WORDS, np.diff(question.first))
        self.question = [
            _grams(question.hash[i:j], k)
            for i, j, k in zip(question.first[:-1], question.first[1:], self.width)
        ]
        self.answer = [np.unique(answer.hash[i:j]) for i, j in zip(answer.first[:-1], answer.first[1:])]

    def term_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for words that no item has."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def search(self, passage: np.ndarray, term: np.ndarray, count: int, threshold: float):
        """(passage, item, score) of all scores at or above the threshold.

        ``passage`` and ``term`` are pairs of passage numbers below ``count`` and terms.
        """
        none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        if not len(term) or not self.blocks:
            return none
        essential = ~self.slight[term]
        p, t = passage[essential], term[essential]
        rows, at = _expand(self.block_start, t)
        key = p[rows] * self.blocks + self.block[at]
        found, where = np.unique(key, return_inverse=True)
        bound = np.bincount(where, self.block_max[at]) + self.slack + 1e-9
        found = found[bound >= threshold]
        if not len(found):
            return none
        live = np.zeros(count, dtype=bool)
        live[found // self.blocks] = True
        keep = live[passage]
        p, t = passage[keep], term[keep]
        pair = np.unique(p * len(self.terms) + t)
        p, t = np.divmod(pair, len(self.terms))
        rows, at = _expand(self.start, t)
        block_key = p[rows] * self.blocks + self.item[at] // BLOCK_ITEMS
        spot = np.minimum(np.searchsorted(found, block_key), len(found) - 1)
        keep = found[spot] == block_key
        rows, at = rows[keep], at[keep]
        key, where = np.unique(p[rows] * len(self.ids) + self.item[at], return_inverse=True)
        score = np.bincount(where, self.impact[at])
        keep = score >= threshold
        p, item = np.divmod(key[keep], len(self.ids))
        return p, item, score[keep]


def _expand(start: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each term its postings: (row of ``term``, index of the posting)."""
    size = start[term + 1] - start[term]
    rows = np.repeat(np.arange(len(term)), size)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start[term], size)
    return rows, at


def _grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct k-word shingles."""
    if not k or len(hashes) < k:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(len(hashes) - k + 1, dtype=np.uint64)
    for j in range(k):
        acc = mix(acc + hashes[j : len(hashes) - k + 1 + j])
    return np.unique(acc)


def _share(wanted: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(wanted, there).mean()) if len(wanted) else 1.0


_EDGES: list[re.Pattern] = []


def _edges() -> re.Pattern:
    """White space beyond ASCII, and punctuation at the edges of words that are not all punctuation.

    Characters of the basic plane only: a class of these is a bitmap, others make it 30 times slower.
    """
    if not _EDGES:
        chars = [chr(c) for c in range(1 << 16)]
        p = re.escape("".join(c for c in chars if unicodedata.category(c)[0] == "P"))
        u = "".join(c for c in chars if c.isspace() and c not in " \t\n\v\f\r")
        _EDGES.append(re.compile(rf"[{p}{u}](?:(?<=[{u}])|(?<!\S.)[{p}]*+(?=[^\s{p}])|(?<=[^\s{p}].)[{p}]*+(?!\S))", re.S))
    return _EDGES[0]


def normalised(text: str | None) -> str:
    """What items and documents are compared by: the same for copies in another case or Unicode form.

    Full case folding (``ß`` and ``SS`` are equal), composed characters, any white space a space, and words
    without the punctuation around them.
    """
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    return _edges().sub(" ", unicodedata.normalize("NFC", text.casefold()))


def split_item(text: str | None) -> tuple[str, str]:
    """(question, answer) of a test item that is one text: its last sentence is the answer."""
    body = (text or "").strip()
    cut = max(body.rstrip(".!?").rfind(c) for c in (". ", ".\n", "? ", "?\n", "! ", "!\n"))
    return (body, "") if cut < 0 else (body[: cut + 1], body[cut + 2 :])


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.6,
    overlap: float = 0.8,
    answer_overlap: float = 0.5,
) -> DataFrame:
    """(id, item_id, score, question_overlap, answer_overlap, passages): verified matches.

    ``items`` has item_id, question and answer. An item is looked for in windows of w words, half
    overlapping, w being twice the next power of two of its length (64 at least). ``score`` is the best normalised
    BM25 score of the document's windows for the item, at least ``threshold``; a window counts if at least
    ``overlap`` of the question's shingles (of a question below five words, the whole question)
    and ``answer_overlap`` of the answer's words are in it; a part without words counts as
    overlapping; ``passages`` is the number of windows that count. Words are those of ``normalised``
    texts, split at white space.

    The benchmark is the stated set of items that all documents are held against: it is read in
    parts of ``INDEX_ITEMS`` items, so each index has a bounded size; results do not depend on the parts,
    nor on the other items' lengths. Items without words match nothing; an item with a null id is an
    item with a null id, and items that repeat an id are one in the result. Ids may have any type. Null texts are
    empty and match nothing; ids that repeat are one document in the result; rows with a null id
    give rows with a null id. Whole texts are searched; other columns are ignored; without
    documents or items there are no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema["item_id"].dataType
    listed = staged(_counted(items), "items")
    total, mean = listed.agg(F.count("*"), F.avg("n_words")).first()
    source = docs.select(id_col, text_col)
    found = None
    part: list[tuple] = []

    def matches(part):
        told = [np.array([x for row in part for x in row[j]], dtype=np.int64) for j in (3, 4)]
        counts = total, mean or 0.0, (told[0].view(np.uint64), told[1])
        index = docs.sparkSession.sparkContext.broadcast(Index([row[:3] for row in part], counts=counts))
        return source.mapInArrow(
            _search(index, id_col, to_arrow_type(item_kind), threshold, overlap, answer_overlap),
            f"`{id_col}` {kind}, item_id {item_kind.simpleString()}, score double, question_overlap double, "
            "answer_overlap double",
        )

    for row in listed.orderBy("key").select("item_id", "question", "answer", "words", "held").toLocalIterator():
        part.append(tuple(row))
        if len(part) == INDEX_ITEMS:
            found, part = matches(part) if found is None else found.union(matches(part)), []
    if part or found is None:
        found = matches(part) if found is None else found.union(matches(part))
    best = F.max(F.struct("score", "question_overlap", "answer_overlap"))
    return (
        found.groupBy(id_col, "item_id")
        .agg(best.alias("best"), F.count("*").alias("passages"))
        .select(id_col, "item_id", "best.*", "passages")
    )


def _counted(items: DataFrame) -> DataFrame:
    """Items with words, normalised: key, item_id, question, answer, n_words, and of their different
    words the hashes and the number of items that hold them."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [[normalised(t) for t in batch.column(c).to_pylist()] for c in (1, 2)]
            words = Words([f"{q}\n{a}" for q, a in zip(*parts)])
            own = [words.hash[i:j] for i, j in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(p, pa.string()) for p in parts),
                    pa.array([len(h) for h in own], pa.int64()),
                    pa.array([np.unique(h).view(np.int64).tolist() for h in own], pa.list_(pa.int64())),
                ],
                ["item_id", "question", "answer", "n_words", "words"],
            )

    read = items.select("item_id", "question", "answer").mapInArrow(
        run, f"item_id {kind}, question string, answer string, n_words long, words array<long>"
    )
    rows = staged(read.where("n_words > 0").withColumn("key", F.monotonically_increasing_id()), "item_words")
    each = rows.select("key", F.explode("words").alias("word"))
    held = each.groupBy("word").agg(F.count("*").alias("held"))
    both = F.collect_list(F.struct("word", "held"))
    counts = each.join(held, "word").groupBy("key").agg(both.alias("counts"))
    return rows.drop("words").join(counts, "key").select(
        "key", "item_id", "question", "answer", "n_words", F.col("counts.word").alias("words"), F.col("counts.held").alias("held")
    )


def _search(index, id_col: str, item_kind: pa.DataType, threshold: float, overlap: float, answer_overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Index = index.value
        stride = held.stride
        for batch in batches:
            texts = [normalised(t) for t in batch.column(1).to_pylist()]
            for i, j in text_blocks(texts):
                words = Words(texts[i:j])
                term = held.term_ids(words.hash)
                # stride s of a document lies in its passages s - 1 and s
                number = (np.arange(len(words.hash)) - words.first[words.doc]) // stride
                counts = np.diff(words.first)
                strides = -(-counts // stride)
                base = np.concatenate(([0], np.cumsum(np.maximum(strides, 1))))
                own = base[words.doc] + number
                hit = term >= 0
                early = hit & (number > 0)
                p, item, score = held.search(
                    np.concatenate([own[hit], own[early] - 1]),
                    np.concatenate([term[hit], term[early]]),
                    int(base[-1]),
                    threshold,
                )
                rows, scores, q_share, a_share, names = [], [], [], [], []
                for passage, k, s in zip(p, item, score):
                    doc = int(np.searchsorted(base, passage, side="right")) - 1
                    start = words.first[doc] + (passage - base[doc]) * stride
                    end, half = words.first[doc + 1], int(held.half[k])
                    # strides are multiples of half a window: each window is in the passage it begins in
                    for first in range(int(start), int(min(start + stride, end)), half):
                        there = words.hash[first : min(first + 2 * half, end)]
                        score = s if half == stride else held.weights[k][np.isin(held.words[k], there)].sum()
                        if score < threshold:
                            continue
                        q, a = _share(held.question[k], _grams(there, held.width[k])), _share(held.answer[k], there)
                        if q >= overlap and a >= answer_overlap:
                            rows.append(i + doc)
                            names.append(held.ids[k])
                            scores.append(score)
                            q_share.append(q)
                            a_share.append(a)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(rows)),
                            pa.array(names, item_kind),
                            pa.array(scores, pa.float64()),
                            pa.array(q_share, pa.float64()),
                            pa.array(a_share, pa.float64()),
                        ],
                        [id_col, "item_id", "score", "question_overlap", "answer_overlap"],
                    )

    return run
