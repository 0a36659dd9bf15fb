"""Every operator against brute force on small tables with nulls, empty and long texts, ties,
repeated rows and extra columns; and on empty tables."""

import base64
import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clinchline.llm import chat, decontamination, fingerprints, near_duplicates, packing
from clinchline.llm import quality, queries, secrets, suffix_dedup, token_counts, warc
from clinchline.llm.common import new_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, id long, n int"


def words(rng, n, size=400):
    word = lambda i: rng.choice(["the", "und", "la"]) if i % 4 == 1 else f"w{rng.randrange(size)}{rng.choice('.,! ').strip()}"
    return " ".join(map(word, range(n)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [words(rng, rng.randrange(20, 200)) for _ in range(20)]
    out = [None, "", " \n\t ", "one", "Two Words", "é漢\U0001f600 \\ x", "a" * 3000, "la " * 2000]
    out += base + base[:6] + [base[0].upper(), base[1] + " tail"]
    for i, text in enumerate(base[:12]):  # near copies
        parts = text.split()
        for k in rng.sample(range(len(parts)), max(1, len(parts) // 60)):
            parts[k] = f"new{i}"
        out.append(" ".join(parts))
    out += [base[2][:200] + base[3][50:400] + base[2], words(rng, 30_000, 5000)]
    out += [f"password = 'abc{i}DEF123' AKIA{'B' * 16 * i} deadbeef{'0' * 16} end" for i in range(3)]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    spark.sparkContext.environment.setdefault("PYTHONPATH", queries._ROOT)
    rows = [(7 * i - 40, t, None, f"s{i % 3}" if i % 5 else None, len(t or ""), "x", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[10:12], DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def by_id(texts):
    return {7 * i - 40: t or "" for i, t in enumerate(texts)}


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("block", [1024, 3])
def test_near_duplicates(docs, by_id, block, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    sets = {i: shingle_set(t, 3) for i, t in by_id.items()}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    found = near_duplicates.near_duplicates(docs, shingle_words=3, threshold=(85, 100)).collect()
    assert len(found) == len(by_id) + 2
    for r in found:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), find(r.doc_id))
        assert r.kept == (r.doc_id == r.component_id)


def test_a_crowd_of_unlinked_likenesses_meets_inside_tasks(spark):
    rng = random.Random(3)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(150):
        parts = list(base)
        for k in rng.sample(range(120), rng.randrange(0, 9)):
            parts[k] = f"x{i}_{k}"
        rows.append((i, " ".join(parts)))
    sets = {i: shingle_set(t, 5) for i, t in rows}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in sets:
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: find(i) for i in sets}


def test_posterior_bounds_drop_few_pairs_at_the_threshold():
    least = near_duplicates.least_matches(0.85, 1e-3, 120)
    rng = np.random.default_rng(1)
    assert (rng.binomial(120, 0.85, 20_000) < least[120]).mean() < 3e-3
    assert (rng.binomial(120, 0.5, 20_000) < least[120]).mean() > 0.99


def test_repeats(docs, by_id):
    seen, want = set(), {}
    for i in sorted(by_id):
        raw = by_id[i].encode()
        gone = bytearray(len(raw))
        for q in range(len(raw) - 99):
            if raw[q : q + 100] in seen:
                gone[q : q + 100] = b"\1" * 100
            seen.add(raw[q : q + 100])
        want[i] = bytes(c for c, g in zip(raw, gone) if not g), len(re.findall(b"\1+", bytes(gone)))
    for r in suffix_dedup.remove_repeats(docs).collect():
        assert (bytes(r.kept), len(r.removed)) == want[r.doc_id]
        assert r.n_bytes == len(by_id[r.doc_id].encode())


def test_repeats_in_crowds_and_cut_texts(docs, monkeypatch):
    whole = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(docs).collect()}
    monkeypatch.setattr(suffix_dedup, "CROWD", 1)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
    assert whole == {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(docs).collect()}


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(2)
    runs, everything = [], []
    for _ in range(7):
        strings = sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))) for _ in range(rng.randrange(0, 40)))
        out, last = b"", b""
        for s in strings:
            common = suffix_dedup.common_prefix(last, s, 0)
            out += suffix_dedup.pack_entry(1, 2, 3, 4, common, len(s) - common, 0) + s[common:]
            last = s
        runs.append(out)
        everything += strings
    merged = list(suffix_dedup.LoserTree(runs))
    assert [m[1] for m in merged] == sorted(everything)
    for a, b in zip(merged, merged[1:]):
        assert b[0] == suffix_dedup.common_prefix(a[1], b[1], 0)


def test_secrets(docs, by_id):
    assign = re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for r in secrets.scan_secrets(docs).collect():
        text = by_id[r.doc_id]
        want = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
        want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        assert sorted((s.kind, s.start, s.end) for s in r.spans if s.kind != "dense") == sorted(want)


def test_dense_strings_are_found_and_names_and_digests_are_not():
    enc = secrets.rank_encoding(secrets.default_ranks())
    find = lambda t: [(k, t[s:e]) for k, s, e in secrets.find_spans(t, enc, 20, 2.2)]
    rng = random.Random(9)
    for _ in range(20):
        key = "x7" + "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(38))
        assert find(f"see {key} here") == [("dense", key)]
    digest = hashlib.sha256(b"x").hexdigest().upper()
    for clean in (digest, "123e4567-e89b-42d3-a456-426614174000", "some_long_identifier_name_v2", "international-standards-2024-edition", "1" * 30):
        assert not [k for k, _ in find(f"see {clean} here") if k == "dense"]
    assert find("token=token:abcdef") == []  # the failing match is passed over whole


def dense(text):
    enc = secrets.rank_encoding(secrets.default_ranks())
    return [text[s:e] for k, s, e in secrets.find_spans(text, enc, 20, 2.2) if k == "dense"]


def test_dense_strings_without_digits_or_with_few_are_found():
    rng = random.Random(4)
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for letters, n in ((lower, 32), (lower + upper, 40), (upper + "234567", 20), (upper + "234567", 32), (lower + "0123456789", 40)):
        for _ in range(50):
            key = "".join(rng.choice(letters) for _ in range(n))
            assert dense(f"see {key} here") == [key]
    for clean in (
        "Donaudampfschifffahrtsgesellschaft", "anticonstitutionnellement", "MAX_RETRY_COUNT_PER_HOST", "getElementsByTagNameNSImplementation",
        "ctx_ptr_idx_buf_len_str_cfg", "abcdefghijklmnopqrstuvwxyz", "img_20240102_123456_001", "org/apache/spark/sql/execution/UnsafeRow",
    ):
        assert dense(f"see {clean} here") == []


def test_keys_beside_other_spans_and_inside_paths_are_found():
    secret = "wJvlrXUtnFQMIqK7MDQNGqbPxRfiCYzXzMqLzKzY"
    assert dense(f"AKIA{'Q7' * 8}/{secret} x") == [secret]
    path = "international/standards/department/documents/publication/information/"
    for key in (secret, "wJvlrXUtnFQMI/K7MDQNG/bPxRfiCYzXzMqLzKzY"):
        assert dense(f"{path}{key}/{path} x") == [key]
    assert dense(f"{path}{hashlib.sha256(b'x').hexdigest().upper()}/{path} x") == []


def test_stretches_are_the_maximal_ones():
    def brute(x, at=0):
        best = max(((sum(x[i:j]), i - j, i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return brute(x[:i], at) + [(at + i, at + j - 1)] + brute(x[j:], at + j)

    rng = random.Random(6)
    for _ in range(300):
        x = [rng.uniform(-1, 1) for _ in range(rng.randrange(12))]
        assert secrets._stretches(x) == brute(x)


def test_redaction_changes_only_texts_with_secrets(docs, by_id):
    out = secrets.redact_secrets(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        text = by_id[r.doc_id]
        if "password" in text or text.startswith("aaaa"):  # a run of hex digits too
            assert "[SECRET]" in r.text and "DEF123" not in r.text and r.n_chars == len(r.text)
        else:
            assert (r.text or "") == text


def test_token_counts_equal_the_tokenizer(docs, by_id):
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.Unigram(token_counts.unigram_pieces(token_counts.default_pieces()), unk_id=0))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always")]
    )
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    for r in token_counts.count_tokens(docs).collect():
        assert r.n_tokens == count(by_id[r.doc_id])
    counts = token_counts.WordCounts(token_counts.unigram_pieces(token_counts.default_pieces()))
    rng = random.Random(4)
    for _ in range(500):
        word = "".join(rng.choice("abetr▁é漢\U0001f600") for _ in range(rng.randrange(1, 60)))
        assert counts[word] == count(word), word


def test_a_long_word_is_counted_in_little_memory(monkeypatch):
    import tracemalloc

    counts = token_counts.WordCounts(token_counts.unigram_pieces(token_counts.default_pieces()))
    rng = random.Random(8)
    word = "".join(rng.choice("abetré漢😀") for _ in range(150_000))
    tracemalloc.start()
    few = counts.pieces_of(word)
    assert tracemalloc.get_traced_memory()[1] < 8 << 20
    tracemalloc.stop()
    monkeypatch.setattr(token_counts, "KEPT_POSITIONS", 10**9)
    assert counts.pieces_of(word) == few
    monkeypatch.setattr(token_counts, "KEPT_POSITIONS", 1)
    assert counts.pieces_of(word) == few


def test_packing_is_whole_and_gapless(docs, by_id):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in by_id.items()}
    for shares, window in ((None, 65536), ({"s1": 3, "s2": 1}, 512), ({"s0": 1}, 100)):
        rows = packing.pack_documents(docs, shares=shares, window_tokens=window).collect()
        at = 0
        for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
            assert r.sequence_id * 1024 + r.offset == at
            at += r.length
            own = ids[r.doc_id]
            piece = np.array(own[r.start : r.start + r.length], dtype="<u4")
            assert (r.doc_tokens, r.ids_crc32) == (len(own), zlib.crc32(piece.tobytes()))
        twice = {7 * i - 40 for i in (10, 11)}
        assert at == sum(len(x) * (2 if i in twice else 1) for i, x in ids.items())


def test_windows_hold_the_mixture():
    totals = {"a": 60_000, "b": 30_000, "c": 10_000}
    for shares, want in ((None, {"a": 600, "b": 300, "c": 100}), ({"a": 1, "b": 1}, {"a": 500, "b": 500})):
        first = packing.plan_phases(totals, shares, 1000)[0]
        for w in range(first.count):
            got = {s: first.delivered(s, w + 1) - first.delivered(s, w) for s in first.names}
            assert all(abs(got[s] - want[s]) <= 1 for s in got)
    phases = packing.plan_phases(totals, {"a": 1, "b": 1}, 1000)
    done = {}
    for p in phases:
        for s in p.names:
            assert p.before[s] == done.get(s, 0)
            done[s] = p.delivered(s, p.count)
    assert done == totals
    schedule, seen = packing.Schedule(phases), set()
    for s, n in totals.items():
        at = 0
        while at < n:
            stream, run = schedule.place(s, at)
            seen.update(range(stream, stream + run))
            at += run
    assert seen == set(range(100_000))


def brute_bm25(items, passages, threshold):
    tokens = {i: re.findall(r"\S+", f"{q}\n{a}".lower()) for i, q, a in items}
    n, mean = len(tokens), np.mean([len(t) for t in tokens.values()])
    df = {w: sum(w in t for t in tokens.values()) for t in tokens.values() for w in t}

    def weight(w, t):
        tf = t.count(w)
        return np.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t) / mean))

    out = {}
    for p, passage in enumerate(passages):
        for i, t in tokens.items():
            score = sum(weight(w, t) for w in set(t) & set(passage)) / sum(weight(w, t) for w in set(t))
            if score >= threshold:
                out[p, i] = score
    return out


def test_search_retrieves_all_above_the_threshold():
    rng = random.Random(8)
    items = [(i, words(rng, 20, 150).lower(), words(rng, 4, 150).lower()) for i in range(60)]
    index = decontamination.Index(items)
    passages = [re.findall(r"\S+", words(rng, 60, 150).lower()) for _ in range(40)]
    passages += [re.findall(r"\S+", f"{q} {a}") + passages[0][:20] for _, q, a in items[:20]]
    held = decontamination.Words([" ".join(p) for p in passages])
    term = index.term_ids(held.hash)
    for threshold in (0.2, 0.6):
        p, item, score = index.search(held.doc[term >= 0], term[term >= 0], len(passages), threshold)
        got = {(int(a), int(index.ids[b])): s for a, b, s in zip(p, item, score)}
        want = brute_bm25(items, passages, threshold)
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_contaminated_documents(spark, docs, empty):
    rng = random.Random(11)
    items = [(i, words(rng, 25) + ".", words(rng, 5) + ".") for i in range(30)] + [(99, None, ""), (98, "Short.", "")]
    table = spark.createDataFrame(items, "item_id long, question string, answer string")
    long = words(rng, 900, 100_000)
    planted = [(1, f"{long} {items[3][1]} {items[3][2]} {long}"), (2, items[4][1].upper() + "\n" + items[4][2]), (3, long), (4, None), (4, "")]
    found = decontamination.contaminated(spark.createDataFrame(planted, "doc_id long, text string"), table).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 3), (2, 4)}
    assert decontamination.contaminated(empty, table).count() == 0
    none = spark.createDataFrame([], table.schema)
    assert decontamination.contaminated(docs, none).count() == 0


def test_contaminated_documents_in_any_case_and_unicode_form(spark):
    items = [
        (1, "Ñora la niña corazón mañana está aquí árbol único.", "Señor ñandú."),
        (2, "Élève français déjà été où œuvre hôtel noël garçon.", "Été reçu."),
        (3, "Über die Straße führen größere Äste schöner Bäume hinüber.", "Grüße Öl."),
    ]
    table = spark.createDataFrame(items, "item_id long, question string, answer string")
    copies = [
        str.upper,
        lambda t: unicodedata.normalize("NFD", t.upper()),
        lambda t: t.replace(" ", "\u00a0"),
        lambda t: " ".join(f"«{w.strip('.')}»," for w in t.split()),
    ]
    rows = [(10 * i + k, f"x y {copy(q + ' ' + a)} z") for i, q, a in items for k, copy in enumerate(copies)]
    found = decontamination.contaminated(spark.createDataFrame([*rows, (0, "x y z")], "doc_id long, text string"), table)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(10 * i + k, i) for i in (1, 2, 3) for k in range(4)]


def test_normalised_keeps_words_of_punctuation_and_inner_marks():
    n = decontamination.normalised
    assert n("(¿Don't, STOP!) ... -- x+=1; \u0915\u0940").split() == ["don't", "stop", "...", "--", "x+=1", "\u0915\u0940"]
    assert n(None) == n("") == ""
    assert n("STRASSE").split() == n("straße").split() and n("A\u0303").split() == n("ã").split()


def test_split_item():
    assert decontamination.split_item("Is it so? It is. Yes.") == ("Is it so? It is.", "Yes.")
    assert decontamination.split_item("One only.") == ("One only.", "")
    assert decontamination.split_item(None) == ("", "")


def test_quality(spark, docs):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(600):
        good = i % 3 > 0
        text = words(rng, 40) if good else " ".join(f"{w}###$$$" for w in words(rng, 40).split())
        rows.append((i, text))
        marks += [(i, int(good))] * (1 + i % 2)
    rows += [(None, "x"), (1000, None), (1001, "")]
    marks += [(None, 1), (5, None), (77777, 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.quality_scores(table, labels).collect()}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found.values())
    held = [r for i, r in found.items() if i is not None and i < 600 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in held)
    assert np.mean([r.predicted == (r.doc_id % 3 > 0) for r in held]) > 0.97
    assert all(r.predicted == (r.score >= 0.5) for r in found.values())
    flipped = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.quality_scores(table, flipped).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in found.items())
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_isotonic_pools_violators():
    x, v = quality.isotonic(np.arange(4.0), np.ones(4), np.array([0, 1, 0, 1.0]))
    assert list(v) == [0, 0.5, 1] and list(x) == [0, 1.5, 3]


def spots(text):
    w = re.findall(r"[^\W_]+", text.lower())
    out = set()
    for i, a in enumerate(w):
        chain = []
        for b in w[i + 1 : i + 3]:
            if b in fingerprints.ANCHORS:
                break
            chain.append(b)
        if a in fingerprints.ANCHORS and chain:
            out.add((a, *chain))
    edges = sorted({0, len(w), *(i for i, a in enumerate(w) if a in fingerprints.ANCHORS)})
    for first, end in zip(edges, edges[1:]):
        if end - first > 12:
            out |= {tuple(w[i : i + 3]) for i in range(first, end - 2)}
    return out or {tuple(w)}


def test_anchors_as_one_expression():
    for some in (fingerprints.ANCHORS, ["a"], ["an", "a", "and", "on"]):
        one = re.compile(fingerprints.any_of(some))
        tried = {w[:k] + tail for w in fingerprints.ANCHORS for k in range(len(w) + 1) for tail in ("", "n", "x")}
        assert {w for w in tried if one.fullmatch(w)} == tried & set(some)


def test_sparse_texts_are_alike_after_an_edit(spark):
    rng = random.Random(9)
    lists = [" | ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)] + ["Ating. " * 90, "the cat sat " * 50]
    lists += [" ".join(f"q{rng.randrange(10**6)}" for _ in range(100)) + " the end of it all"]
    table = spark.createDataFrame(list(enumerate(lists)), "doc_id long, text string")
    for r in fingerprints.fingerprint_changes(table).collect():
        assert r.near_edited > (0.5 if r.doc_id < 5 else 0), r.doc_id


def test_fingerprints(spark, docs, by_id):
    order = sorted(by_id)
    for r in fingerprints.fingerprint_changes(docs).collect():
        text, following = by_id[r.doc_id], by_id[order[(order.index(r.doc_id) + 1) % len(order)]]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        assert (r.n_chars, r.edited) == (len(text), edited)
        a, b, c = spots(text), spots(edited), spots(following)
        assert len(r.sigs) == len(a)
        assert r.near_edited == pytest.approx(len(a & b) / len(a | b))
        assert r.near_next == pytest.approx(len(a & c) / len(a | c))


def test_alike_fingerprints_lose_no_link(spark):
    rng = random.Random(6)
    make = lambda n: " ".join(x for _ in range(n) for x in ("the", f"c{rng.randrange(300)}", f"d{rng.randrange(300)}"))
    base = [make(rng.randrange(5, 60)) for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(base + base[:2] + [b + " " + make(k) for k, b in enumerate(base * 3)])] + [(90, None), (91, "")]
    membership, links = fingerprints.alike_fingerprints(spark.createDataFrame(rows, "doc_id int, text string"))
    sets = {i: spots(t or "") for i, t in rows}
    classes = {i: min(j for j in sets if sets[j] == s) for i, s in sets.items()}
    assert {r.id: r.class_id for r in membership.collect()} == classes
    heads = sorted(set(classes.values()))
    want = {(a, b) for a in heads for b in heads if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert want and {(r.a, r.b) for r in links.collect()} == want


def test_warc(spark, tmp_path):
    pages = [(i, f"http://h/{i} \r\n%", "<p>é</p>" * (i % 5)) for i in range(40)] + [(50, None, None), (51, "u", "x" * 100_000)]
    table = spark.createDataFrame(pages + [pages[3]], "page_id int, url string, html string")
    digest = lambda p: base64.b32encode(hashlib.sha1(p).digest()).decode()
    first = {}
    for i, _, html in pages:
        first.setdefault((html or "").encode(), i)
    manifests = []
    for least in (0, 10**6):
        folder = new_folder(spark, "warc")
        manifest = warc.write_warc(table.repartition(3), folder, shards=4, roll_bytes=600, revisit_from=least)
        rows = warc.read_warc(spark, folder, manifest).collect()
        assert len(rows) == len(pages) + 1 and all(r.digest_ok for r in rows)
        for r in rows:
            _, url, html = next(p for p in pages if p[0] == r.page_id)
            payload = (html or "").encode()
            assert (r.payload_bytes, r.payload_digest, r.url) == (len(payload), digest(payload), url or "")
            if least or (first[payload] == r.page_id and r.page_id != 3):
                assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, payload)
            elif r.page_id != 3:
                assert (r.record_type, r.refers_to) == ("revisit", first[payload])
        manifests.append(sorted(tuple(m) for m in manifest.collect()))
    again = warc.write_warc(table.repartition(2), new_folder(spark, "warc"), shards=4, roll_bytes=600, revisit_from=10**6)
    assert sorted(tuple(m) for m in again.collect()) == manifests[1]
    none = warc.write_warc(table.limit(0), folder := new_folder(spark, "warc"))
    assert none.count() == 0 and warc.read_warc(spark, folder, none).count() == 0


def test_chats_round_trip(spark):
    rows = [(-7, t, r, "\\### Assistant: </turn> ok") for t, r in ((0, "user"), (1, "assistant"))]
    rows += [(1, 0, "us:er\\", "\\\\/#:c\\c\n</turn>\n### x: y\\"), (1, 1, "assistant", ""), (1, 2, None, None), (1, 2, "assistant", "é\U0001f600#")]
    rows += [(2, None, "", None), (None, 0, "user", "x"), (3, 0, "system", "a"), (3, 1, "user", "b"), (3, 2, "assistant", "c")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = chat.format_chats(chat.records_of_rows(table, "conv_id", "turn", "role", "text")).select(
        "*", chat.read_chats(F.col("formatted")).alias("back"), chat.learned_texts(F.col("formatted"), F.col("loss_spans")).alias("learned")
    )
    for r in out.collect():
        want = [(b or "", c or "") for _, b, c in sorted(((t if t is not None else -1, b or "", c or "") for i, t, b, c in rows if i == r.conv_id))]
        assert [(t.role, t.text) for t in r.back] == want
        assert r.learned == [c for b, c in want if b == "assistant"]
    assert chat.format_chats(chat.records_of_rows(table.limit(0), "conv_id", "turn", "role", "text")).count() == 0


def test_layouts_are_selected_by_fingerprint(spark):
    records = [
        ('{"prompt":"p","completion":"c"}', [("user", "p"), ("assistant", "c")]),
        ('{"completion":null,"prompt":"p"}', [("user", "p"), ("assistant", "")]),
        ('{"instruction":"i","input":"n","output":"o"}', [("system", "i"), ("user", "n"), ("assistant", "o")]),
        ('{"answer":"a","question":"q"}', [("user", "q"), ("assistant", "a")]),
        ('{"conversations":[{"from":"user","value":"v"}]}', [("user", "v")]),
        ('{"messages":[{"content":"m","role":"user"},{"role":"assistant","content":"n"}]}', [("user", "m"), ("assistant", "n")]),
        ('{"other":1}', None), ("no json", None), (None, None), ("", None), ("[]", None),
    ]
    table = spark.createDataFrame([(i, r, "clash") for i, (r, _) in enumerate(records)], "i int, record string, turns string")
    for r in chat.format_chats(table).collect():
        want = records[r.i][1]
        assert (r.turns and [(t.role, t.text) for t in r.turns]) == want
        assert (r.formatted is None) == (want is None)


def test_mixed_and_deeper_records_have_no_layout(spark):
    records = [
        ('{"messages":[{"role":"user","content":"a"},{"from":"assistant","value":"b"}]}', None),
        ('{"messages":[{"role":"user","content":[{"type":"text","text":"a"}]}]}', None),
        ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":{"text":"b"}}]}', None),
        ('{"messages":[{"role":"user","content":"a"},"b"]}', None),
        ('{"messages":[{"role":"user","content":"a"},["b"]]}', None),
        ('{"prompt":"p","completion":["c"]}', None),
        ('{"prompt":"p","completion":{"x":{"y":1}}}', None),
        ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":5},{"role":"user","content":null}]}', [("user", "a"), ("assistant", "5"), ("user", "")]),
        ('{"prompt":"{\\"x\\":1}","completion":"[{\\"y\\":2}]"}', [("user", '{"x":1}'), ("assistant", '[{"y":2}]')]),
    ]
    found = chat.canonical_turns(spark.createDataFrame([(i, r) for i, (r, _) in enumerate(records)], "i int, record string"))
    for r in found.collect():
        assert (r.turns and [(t.role, t.text) for t in r.turns]) == records[r.i][1]
        assert (r.layout is None) == (records[r.i][1] is None) and r.fingerprint is not None


def test_paths_of_long_records_see_all_list_elements(spark):
    records = [
        ('{"messages":[{"role":"user","content":"a"},{"role":"user","content":"b"}]}', ["messages", "messages.content", "messages.role"]),
        ('{"messages":[{"role":"user"},{"from":"b"}]}', ["messages", "messages.from", "messages.role"]),
        ('{"prompt":"p","completion":"c"}', ["completion", "prompt"]),
    ]
    table = spark.createDataFrame([(i, r) for i, (r, _) in enumerate(records)], "i int, record string")
    for r in table.select("i", F.array_sort(chat._long_paths(F.col("record"))).alias("p")).collect():
        assert r.p == records[r.i][1]


def test_empty_tables(empty):
    assert near_duplicates.near_duplicates(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert secrets.scan_secrets(empty).count() == 0
    assert token_counts.count_tokens(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0
    assert fingerprints.fingerprint_changes(empty).count() == 0
    assert quality.quality_scores(empty, empty.selectExpr("doc_id", "n AS quality")).count() == 0


def test_near_duplicates_of_other_ids(spark, docs, by_id):
    named = docs.selectExpr("CASE WHEN doc_id % 5 <> 0 THEN concat('d', doc_id) END AS name", "text", "doc_id AS number")
    found = near_duplicates.near_duplicates(named, "name")
    plain = near_duplicates.near_duplicates(docs.selectExpr("CASE WHEN doc_id % 5 <> 0 THEN doc_id END AS doc_id", "text"))
    groups = {}
    for r in plain.collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    smallest = {f"d{i}": min(f"d{j}" for j in g) for c, g in groups.items() if c is not None for i in g}
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.component_id == smallest.get(r.name)
        assert r.kept == (r.name is None or r.name == r.component_id)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_pipeline_stages_decide_by_row_whatever_the_id(spark, kind):
    """Null and repeated ids: every row is judged by its own text, and exact repeats stay once."""
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents").where("length(text) > 300").orderBy("doc_id").limit(120)
    ids = f"CAST(CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 7 ELSE doc_id END AS {kind}) AS doc_id"
    names = [c for c in docs.columns if c != "doc_id"]
    mixed = docs.selectExpr(ids, *names, "1 AS number", "2 AS place")
    mixed = corpus_pipeline.staged(mixed.union(mixed.limit(9)), "mixed")

    scores = {r.number: r.predicted for r in quality.quality_scores(
        mixed.withColumn("number", F.sha2("text", 256)), queries.table(spark, sf, "labels"), carried=("number",)
    ).collect()}
    good = corpus_pipeline.reject_low_quality(spark, mixed, sf)
    digests = lambda df: sorted(r[0] for r in df.select(F.sha2("text", 256)).collect())
    assert good.columns == mixed.columns
    assert digests(good) == [d for d in digests(mixed) if scores[d]]

    kept = corpus_pipeline.drop_near_duplicates(spark, mixed, sf)
    assert kept.columns == mixed.columns
    texts = [r.text for r in kept.collect()]
    sets = [shingle_set(t, 5) for t in texts]
    for i, a in enumerate(sets):
        assert all(5 * len(a & b) < 4 * len(a | b) for b in sets[:i])
    for r in mixed.collect():
        own = shingle_set(r.text, 5)
        assert any(5 * len(own & b) >= 4 * len(own | b) for b in sets)

    item = queries.table(spark, sf, "benchmark").orderBy("item_id").first().text
    leak = mixed.limit(2).withColumn("text", F.concat("text", F.lit(" " + item)))
    clean = corpus_pipeline.drop_contaminated(spark, kept.union(leak), sf)
    assert not any(item in r.text for r in clean.collect())
    assert set(digests(clean)) <= set(digests(kept))
    free = [t for t in texts if not any(b.text in t for b in queries.table(spark, sf, "benchmark").collect())]
    assert clean.count() >= len(free) - 2

    masked = corpus_pipeline.mask_secrets(spark, clean, sf)
    assert masked.columns == clean.columns and masked.count() == clean.count()
    packed = corpus_pipeline.pack(spark, masked, sf)
    assert packed.where("start = 0").count() == masked.count()


def test_pipeline_of_an_empty_table(spark, empty):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_pipeline_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = queries.table(spark, sf, "documents")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = corpus_pipeline.staged(stage(spark, before, sf), name)
        assert kept.columns == docs.columns
        assert kept.join(before, "doc_id", "left_anti").count() == 0
    texts = {r.doc_id: r.text for r in kept.collect()}
    sets = {i: shingle_set(t, 5) for i, t in texts.items()}
    for i in sets:
        for j in sets:
            assert i >= j or not sets[i] or 5 * len(sets[i] & sets[j]) < 4 * len(sets[i] | sets[j])
    for item in queries.table(spark, sf, "benchmark").collect():
        assert not any(item.text in (t or "") for t in texts.values())
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(texts)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_check_sql(spark, name):
    from checks.compare import connect, differences

    sf = "/root/testdata/sf0.001"
    assert differences(queries.queries()[name](spark, sf), connect(sf), queries.oracle_sql()[name]) == []


def test_pipeline_stages_do_not_shuffle_texts_for_a_few_ids(spark, monkeypatch):
    docs = corpus_pipeline.table(spark, "/root/testdata/sf0.001", "documents")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    given = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "1")  # as if the list of ids were over the cluster's limit
        for stage in (corpus_pipeline.reject_low_quality, corpus_pipeline.drop_near_duplicates):
            kept = stage(spark, docs, "/root/testdata/sf0.001")
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan
        few = sorted(tuple(r) for r in kept.collect())
        monkeypatch.setattr("clinchline.llm.common.BROADCAST_IDS", 0)
        many = corpus_pipeline.drop_near_duplicates(spark, docs, "/root/testdata/sf0.001")
        assert few == sorted(tuple(r) for r in many.collect()) and len(few) < docs.count()
    finally:
        spark.conf.set(limit, given)
