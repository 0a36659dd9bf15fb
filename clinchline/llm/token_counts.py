"""Count-only Viterbi segmentation under a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that ends at a character; dynamic
programming carries only the best score and its number of pieces, no back-pointers. Ties follow
the tokenizer: paths are extended from left to right by their start, a later one replaces an
earlier one only if its score is strictly higher, and characters that no piece covers are an
unknown piece, runs of which count once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: The mark that stands for the space before a word.
MARK = "▁"
#: An unknown character scores so much below the lowest piece (a fixed value of the tokenizer).
UNKNOWN_PENALTY = 10.0
#: Words whose counts a worker keeps; the memory they take is bounded, results do not depend on it.
KEPT_WORDS = 400_000
#: Positions whose scores are kept before those beyond the longest piece are dropped.
KEPT_POSITIONS = 1 << 14
#: str.split also splits at these four, which are not white space to the tokenizer.
_ODD = re.compile("[\x1c-\x1f]")
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")

_COUNTERS: dict[str, WordCounts] = {}


def unigram_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file with log scores by rank: -log(2 + rank); unknown first.

    The file's own scores are merge ranks; this fixed rule makes a unigram vocabulary of them.
    Control, byte and unused pieces take no part.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = [("<unk>", 0.0)]
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            out.append((model.id_to_piece(i), -math.log(2.0 + i)))
    return out


class WordCounts(dict):
    """word -> number of pieces, filled on demand."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces[1:]:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces[1:]), default=0.0) - UNKNOWN_PENALTY
        self.longest = max((len(p) for p, _ in pieces[1:]), default=1)

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        marked = word if word[0] == MARK else MARK + word
        count = sum(self.pieces_of(m[0]) for m in re.finditer(f"{MARK}[^{MARK}]*", marked))
        if len(word) <= 40:
            self[word] = count
        return count

    def pieces_of(self, text: str) -> int:
        """Pieces of the best path; matches come by end, and for one end the longest first,
        which is the order of their starts: the first of the best scores is the tokenizer's.

        Matches are read as they come and only the last positions, those a piece can start at, are kept."""
        best, count, fused, gone = [0.0], [0], [False], 0
        matches = self.automaton.iter(text)
        at, match = next(matches, (-1, None))
        for end in range(len(text)):
            ending = []
            while at == end:
                ending.append(match)
                at, match = next(matches, (-1, None))
            here = end - gone
            score, pieces, unknown, single = -math.inf, 0, False, False
            for length, value in sorted(ending, reverse=True):
                start = here + 1 - length
                single |= length == 1
                if best[start] + value > score:
                    score, pieces, unknown = best[start] + value, count[start] + 1, False
            if not single and best[here] + self.unknown > score:
                score, pieces, unknown = best[here] + self.unknown, count[here] + (not fused[here]), True
            best.append(score)
            count.append(pieces)
            fused.append(unknown)
            if here >= KEPT_POSITIONS + self.longest:
                for kept in (best, count, fused):
                    del kept[: -self.longest]
                gone = end + 2 - self.longest
        return count[-1]


def word_counts(path: str) -> WordCounts:
    """The counts of a vocabulary file, kept in each worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = WordCounts(unigram_pieces(path))
    return _COUNTERS[path]


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pieces: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: its id, n_words and n_tokens of the whole text.

    Texts are split at Unicode white space and every word is marked and segmented on its own.
    Null and empty texts have no words and no tokens. Repeated rows and null ids stay as they are;
    other columns are ignored; no rows give no rows. A word of any length is segmented whole, in memory that
    does not grow with it but for the word itself.
    """
    path = pieces or default_pieces()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = word_counts(path)
        for batch in batches:
            words, tokens = [], []
            for scalar in batch.column(1):
                text = scalar.as_py() or ""
                parts = [w for w in _WHITE.split(text) if w] if _ODD.search(text) else text.split()
                words.append(len(parts))
                tokens.append(sum(map(counts.__getitem__, parts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                [id_col, "n_words", "n_tokens"],
            )

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words bigint, n_tokens bigint"
    )
