"""Secret scans: fixed patterns, and strings that a tokenizer finds hard to compress.

Random strings break into many short tokens: a run of token characters whose characters per
token stay at or below ``max_ratio`` is reported as kind ``dense``, unless it is a digest of a
known length, a UUID or an identifier made of words and short numbers. Where a whole run is none,
stretches of its parts between separators are measured too, so readable text hides no key.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Kinds in the order in which spans that start together are listed.
KINDS = ("assign", "access", "hex", "dense")
#: Fixed patterns; a match counts if the measured part has so many characters at least.
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_LONG_RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
_DIGESTS = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_KNOWN = re.compile(rf"(?<![A-Za-z0-9])(?:{_UUID.pattern}|{_DIGESTS.pattern})(?![A-Za-z0-9])")
_PART = re.compile(r"[A-Za-z0-9]+")
_SHORT_PART = re.compile(r"[A-Za-z]{1,3}[0-9]{0,4}|[0-9]{1,8}")
_WORD = re.compile(r"([A-Z]?[a-z]+|[A-Z]+(?![a-z]))([0-9]{1,4}(?![0-9]))?")
#: Characters per token above which a long word is taken for natural language, and the share of an
#: identifier's letters and digits that lies in words.
NATURAL_RATIO, NAME_SHARE = 2.4, 0.6
#: Runs are encoded in stretches of so many characters.
_ENCODED = 4096
_MARKS = str.maketrans("", "", "_-/+=")

_ENCODINGS: dict[str, object] = {}


def rank_encoding(path: str):
    """A tiktoken encoding of a file of ranks, made once in each worker."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _ENCODINGS[path]


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _tokens(run: str, encoding) -> int:
    return sum(len(encoding.encode_ordinary(run[i : i + _ENCODED])) for i in range(0, len(run), _ENCODED))


def _is_word(word: str, encoding) -> bool:
    """Whether the vocabulary holds a word whole, or breaks a long one into few tokens as it does natural language."""
    if len(word) < 3:
        return False
    tokens = _tokens(" " + word.lower(), encoding)
    return tokens == 1 or (len(word) >= 8 and len(word) > NATURAL_RATIO * tokens)


def _is_name(run: str, encoding) -> bool:
    """Whether most of a run is words, short numbers and short parts, or it counts through the alphabet."""
    plain = run.translate(_MARKS)
    if 2 * sum(abs(ord(a) - ord(b)) <= 1 for a, b in zip(plain, plain[1:])) >= len(plain):
        return True
    covered = 0
    for part in _PART.findall(run):
        if _SHORT_PART.fullmatch(part):
            covered += len(part)
        else:
            covered += sum(len(m[0]) for m in _WORD.finditer(part) if _is_word(m[1], encoding))
    return covered >= NAME_SHARE * len(plain)


def _is_dense(run: str, encoding, min_length: int, max_ratio: float) -> bool:
    if len(run) < min_length or run.translate(_MARKS).isdigit() or _DIGESTS.fullmatch(run) or _UUID.fullmatch(run):
        return False
    return len(run) <= max_ratio * _tokens(run, encoding) and not _is_name(run, encoding)


def _stretches(scores: list[float]) -> list[tuple[int, int]]:
    """(first, last) of the maximal stretches of positive sum (Ruzzo and Tompa), in linear time."""
    held: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum after
    closed: list[tuple[int, int]] = []
    total = 0.0
    for i, score in enumerate(scores):
        first, low, total = i, total, total + score
        if score <= 0:
            continue
        passed: list[tuple[int, int]] = []
        while held and (held[-1][2] >= low or held[-1][3] < total):
            one = held.pop()
            if one[2] >= low:  # nothing later starts there, as it sums to more from here
                passed.append(one[:2])
            else:
                first, low = one[0], one[2]
                passed.clear()
        closed += passed
        held.append((first, i, low, total))
    out: list[tuple[int, int]] = []
    for one in sorted([*closed, *(h[:2] for h in held)], key=lambda x: (x[0], -x[1])):
        if not out or one[0] > out[-1][1]:
            out.append(one)
    return out


def _dense_spans(run: str, encoding, min_length: int, max_ratio: float) -> list[tuple[int, int]]:
    """The run as a whole, or else the stretches of its parts that are dense; known digests and UUIDs divide it."""
    if _is_dense(run, encoding, min_length, max_ratio):
        return [(0, len(run))]
    out, at = [], 0
    for start, end in [*(m.span() for m in _KNOWN.finditer(run)), (len(run), len(run))]:
        parts = [m.span() for m in _PART.finditer(run, at, start)]
        at = end
        if not parts or parts[-1][1] - parts[0][0] < min_length:
            continue
        scores = [
            float(i - j) if _is_name(run[i:j], encoding) else max_ratio * _tokens(run[i:j], encoding) - (j - i)
            for i, j in parts
        ]
        for first, last in _stretches(scores):
            i, j = parts[first][0], parts[last][1]
            if _is_dense(run[i:j], encoding, min_length, max_ratio):
                out.append((i, j))
    return out


def _outside(start: int, end: int, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """What the spans of ``base``, ordered by start, leave of start .. end."""
    out, at = [], start
    for _, s, e in base:
        if s < end and at < e:
            out.append((at, s))
            at = e
    return [(i, j) for i, j in [*out, (at, end)] if i < j]


def find_spans(text: str, encoding, min_length: int, max_ratio: float) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and kind."""
    found = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    if any(len(w) >= min_length for w in text.split()):
        base = sorted(found, key=lambda x: x[1])
        for m in _LONG_RUN.finditer(text):
            if m.end() - m.start() < min_length:
                continue
            for start, end in _outside(*m.span(), base):
                while start < end and start > m.start() and text[start] in "_-/+=":
                    start += 1
                while start < end < m.end() and text[end - 1] in "_-/+=":
                    end -= 1
                found += [
                    ("dense", start + i, start + j)
                    for i, j in _dense_spans(text[start:end], encoding, min_length, max_ratio)
                ]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str | None = None,
    min_length: int = 20,
    max_ratio: float = 2.2,
) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans`` array<struct<kind, start, end>>.

    Kinds ``assign``, ``access`` and ``hex`` are the leftmost non-overlapping matches of fixed
    patterns, each kind on its own; ``dense`` are runs of at least ``min_length`` token characters
    outside the spans of the other kinds, or stretches of their parts between separators, at or below
    ``max_ratio`` characters per token under the ranks at ``ranks`` (by default those of the public
    byte-level vocabulary).

    Whole texts are scanned. Null and empty texts have no spans; repeated rows and null ids stay
    as they are; other columns are ignored; no rows give no rows.
    """
    path = ranks or default_ranks()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoding(path)
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t or "", encoding, min_length, max_ratio)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], [id_col, "spans"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, spans array<struct<kind: string, start: bigint, `end`: bigint>>"
    )


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def redact_secrets(
    docs: DataFrame,
    text_col: str = "text",
    length_col: str | None = "n_chars",
    mask: str = "[SECRET]",
    ranks: str | None = None,
    min_length: int = 20,
    max_ratio: float = 2.2,
) -> DataFrame:
    """``docs`` with every run of overlapping spans replaced by ``mask``; same columns and rows.

    ``length_col``, where the table has it, is set to the new number of code points of texts that
    changed. Null texts stay null. Texts without spans, and so their rows, are unchanged.
    """
    path = ranks or default_ranks()
    names = docs.columns
    at = names.index(text_col)
    length_at = names.index(length_col) if length_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = rank_encoding(path)
        for batch in batches:
            columns = list(batch.columns)
            texts = columns[at].to_pylist()
            changed = {}
            for i, text in enumerate(texts):
                spans = find_spans(text, encoding, min_length, max_ratio) if text else []
                if spans:
                    out, last = [], 0
                    for _, start, end in spans:
                        if start >= last:
                            out += [text[last:start], mask]
                        last = max(last, end)
                    changed[i] = "".join([*out, text[last:]])
            if changed:
                columns[at] = pa.array([changed.get(i, t) for i, t in enumerate(texts)], columns[at].type)
                if length_at is not None:
                    kind = columns[length_at].type
                    new = pa.array([len(changed[i]) if i in changed else None for i in range(len(texts))], kind)
                    columns[length_at] = pc.coalesce(new, columns[length_at])
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
