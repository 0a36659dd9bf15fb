"""Fill-in-middle, nearest neighbours and periodic runs against brute force, on tables with nulls, empty
and long texts, ties, repeated rows and extra columns; and on empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinchline.llm import fill_in_middle, nearest, periodic_runs, queries

DOCS = "doc_id long, text string, output string, form string, id long, runs int"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", queries._ROOT)


# ---- fill in the middle ----------------------------------------------------------------------


def fim_expected(doc_id, text):
    """The arrangement said plainly: slices of code points."""
    text = text or ""
    hashed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hashed[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    rng = random.Random(2)
    out = [None, "", "a", "é", "\U0001f600", "has <P> in it", "<M>", "<S", "P><", "<<S<P<M>>"[:8], "a<" * 50, ">S<P" * 40]
    out += ["".join(rng.choice("ab é漢\U0001f600<>PSM\n") for _ in range(rng.randrange(1, 90))) for _ in range(150)]
    return out + ["漢字\U0001f600x" * 70_000]


def test_fill_in_middle(spark):
    texts = fim_texts()
    rows = [(7 * i - 30, t, "x", "y", 1, 2) for i, t in enumerate(texts)]
    rows += rows[3:5] + [(rows[20][0], "another text under the same id", "x", "y", 1, 2), (None, "no id " * 30, "x", "y", 1, 2)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    arranged = fill_in_middle.fill_in_middle(docs)
    found = sorted((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in arranged.where("doc_id is not null").collect())
    assert found == sorted((r[0], *fim_expected(r[0], r[1])) for r in rows if r[0] is not None)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    nameless = arranged.where("doc_id is null").first()
    assert (nameless["n"], nameless["form"], nameless["prefix_chars"], nameless["middle_chars"], nameless["output"]) == fim_expected(None, rows[-1][1])
    back = fill_in_middle.restore(arranged)
    assert back.columns[-2:] == ["text", "restored_sha256"]
    got = sorted((r["doc_id"] or 0, r["text"], r["restored_sha256"], r["output_sha256"]) for r in back.collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted((r[0] or 0, r[1] or "", sha(r[1] or ""), sha(fim_expected(r[0], r[1])[4])) for r in rows)


def test_pieces_describe_the_output(spark):
    docs = spark.createDataFrame([(i, f"text {i} of é some \U0001f600 words " * 5) for i in range(40)], "doc_id string, text string")
    marks = b"".join(fill_in_middle.SENTINELS)
    rows = fill_in_middle.fill_in_middle(docs, seed=9, kept_percent=0, spm_percent=50).join(docs, "doc_id").collect()
    assert {r["form"] for r in rows} == {"psm", "spm"}
    for r in rows:
        buffers = (r["text"].encode(), marks)
        joined = b"".join(buffers[p["buffer"]][p["start"] : p["start"] + p["length"]] for p in r["pieces"])
        assert joined.decode() == r["output"]


def test_cuts_and_permutations():
    whole = [fill_in_middle.Piece(0, 0, 10)]
    parts = fill_in_middle.cut(fill_in_middle.cut(whole, 7), 3)
    assert [tuple(p) for p in parts] == [(0, 0, 3), (0, 3, 4), (0, 7, 3)]
    assert [p.length for p in fill_in_middle.cut(whole, 0)] == [0, 10]
    for order in fill_in_middle.FORMS.values():
        there = fill_in_middle.permuted(parts, order)
        assert fill_in_middle.permuted(there, fill_in_middle.inverse(order)) == parts
    with pytest.raises(ValueError):
        fill_in_middle.cut(whole, 11)
    text = "a\U0001f600é" * 50_000  # several chunks
    points = fill_in_middle.CodePoints(memoryview(text.encode()))
    assert points.count == len(text)
    for k in (0, 1, 2, 65_535, 65_536, 99_999, len(text) - 1, len(text)):
        assert points.byte(k) == len(text[:k].encode())


# ---- nearest neighbours ------------------------------------------------------------------------


def nearest_expected(rows, query_ids, k=10):
    """Distances to every other row."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in query_ids:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        other = np.flatnonzero(ids != q)
        order = other[np.lexsort((ids[other], d[other]))][:k]
        out[q] = [(int(ids[j]), float(d[j])) for j in order]
    return out


def found_lists(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("kind", ["clusters", "random", "lengths"])
def test_nearest_neighbours_recall(spark, kind, monkeypatch):
    monkeypatch.setattr(nearest, "LEAST_SHARD_ROWS", 500)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    if kind == "clusters":
        x = rng.normal(size=(40, 24))[rng.integers(0, 40, 3000)] + 0.2 * x
    if kind == "lengths":
        x *= rng.lognormal(size=(3000, 1))
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    found = found_lists(nearest.nearest_neighbours(df, F.col("id") % 50 == 0, sample_rows=800))
    expected = nearest_expected(rows, range(0, 3000, 50))
    assert set(found) == set(expected)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits >= 0.95 * 10 * len(expected)
    true = dict(rows)
    for q, listed in found.items():
        for i, score in listed:
            assert score == pytest.approx(np.linalg.norm(np.array(true[i]) - np.array(true[q])), abs=1e-12)


def test_few_vectors_come_back_whole(spark):
    """Ties, copies, vectors that take no part, other lengths, extra columns with the names used inside."""
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (7, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [2.0, 1.0]), (-300, [1.0, 3.0])]
    bad = [(1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (200, [-inf, 2.0]), (10, [])]
    rows = [(i, v, 5, "v", 1.0) for i, v in good + bad + good[:2]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int, shard string, score double")
    found = found_lists(nearest.nearest_neighbours(df, F.col("id") % 100 == 0, k=10))
    assert found == nearest_expected(good, [0, 100, -300])
    assert [i for i, _ in found[0]][:2] == [7, 100]
    two = found_lists(nearest.nearest_neighbours(df, F.col("id") % 100 == 0, k=2))
    assert two == nearest_expected(good, [0, 100, -300], k=2)


def test_a_crowd_of_copies_is_exact(spark):
    """A third of the rows hold one vector: of equal distances the smallest ids come first."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16))
    x[::3] = x[0]
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(1500), x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = found_lists(nearest.nearest_neighbours(df, F.col("id") % 100 == 0))
    crowd = {i for i, v in rows if v == rows[0][1]}
    expected = nearest_expected(rows, [q for q in range(0, 1500, 100) if q in crowd])
    assert expected and {q: found[q] for q in expected} == expected


def test_empty_and_unusable_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None), (100, [0.0, 0.0])]):
        out = nearest.nearest_neighbours(spark.createDataFrame(rows, schema), F.col("id") % 100 == 0)
        assert out.collect() == [] and out.columns == ["query_id", "rank", "vec_id", "score"]
    alone = spark.createDataFrame([(100, [1.0, 2.0])], schema)
    assert nearest.nearest_neighbours(alone, F.col("id") % 100 == 0).collect() == []


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(5)
    x = np.unique(rng.normal(size=(700, 20)).astype(np.float32), axis=0)
    model = nearest.learn(x.astype(np.float64), 0.98)
    shard = nearest.Shard(x, np.arange(len(x)), model, 5)
    assert shard.parts > 1
    code = int(shard.code[3])
    seen = np.zeros(len(x), dtype=bool)
    for r in range(model.rotation.shape[1] + 1):
        seen[shard._probe(code, r % shard.parts, r // shard.parts)] = True
        assert seen[np.bitwise_count(shard.code ^ np.uint64(code)) <= r].all()
    assert np.all(np.diff(model.radius) >= 0)


# ---- periodic runs ---------------------------------------------------------------------------


def runs_expected(words, least=12):
    """All runs by comparing the words at every lag; a smaller period of a stretch rules a lag out."""
    w = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.zeros(0)
    out = []
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate(([0], w[q:] == w[:-q], [0]))
        edges = np.diff(same)
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
            part = w[a : b + q]
            if len(part) >= max(least, 2 * q) and not any(np.array_equal(part[d:], part[:-d]) for d in range(1, q)):
                out.append((int(a), len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_texts():
    rng = random.Random(6)
    say = lambda numbers: " ".join(f"w{x}" for x in numbers)
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    out = [None, "", " \n\t ", "one", "la " * 11, "la " * 12, "La la " * 9, "x" * 5000, say(fib[-1])]
    out.append(say([0, 1] * 40 + [0]) + " " + say([0, 1] * 40 + [0]))  # runs across two runs of a shorter period
    out.append(say(bin(i).count("1") % 2 for i in range(300)))
    for _ in range(25):
        period = [rng.randrange(rng.choice([2, 3, 50])) for _ in range(rng.randrange(1, 120))]
        body = (period * 9)[: rng.randrange(1, 500)]
        out.append(say([9] * rng.randrange(4) + body + [8] + body[: rng.randrange(200)]))
    for _ in range(15):
        out.append(say(x for _ in range(rng.randrange(1, 9)) for x in [rng.randrange(2) for _ in range(rng.randrange(1, 7))] * rng.randrange(1, 30)))
    out += [say(rng.randrange(400) for _ in range(rng.randrange(300))) for _ in range(10)]
    return out + ["a b é　c " * 20]


@pytest.mark.parametrize("least", [12, 5, 30])
def test_periodic_runs(spark, least):
    texts = run_texts()
    rows = [(3 * i - 9, t, "x", "y", 1, 2) for i, t in enumerate(texts)] + [(None, "ha " * 40, "", "", 0, 0), (0, "hm " * 50, "", "", 0, 0)]
    rows += rows[8:9]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = periodic_runs.periodic_runs(docs, least=least).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    found = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got), key=key)
    expected = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
        runs = runs_expected(words, least)
        dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
        expected.append((r[0], len(words), runs, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert found == sorted(expected, key=key)
    assert sum(len(r[2]) for r in found) > 100


def test_a_block_of_texts_equals_each_alone(monkeypatch):
    texts = run_texts()
    together = periodic_runs._block(texts, 12)
    monkeypatch.setattr(periodic_runs, "_SLICE", 7)  # texts read in slices that end between words
    for text, (n, runs, kept) in zip(texts, together):
        (alone,) = periodic_runs._block([text], 12)
        assert (n, runs.tolist(), kept) == (alone[0], alone[1].tolist(), alone[2])


def test_long_runs_at_every_scale():
    """One planted period a text, short and long, of words that do not recur inside it."""
    rng = np.random.default_rng(7)
    for q in (17, 18, 19, 35, 36, 71, 72, 500, 1151, 4000):
        period = rng.integers(0, 50, q)
        period[0] = 999
        body = np.tile(period, 3)[: 2 * q + q // 3]
        ids = np.concatenate((rng.integers(1000, 2000, 300), body, rng.integers(2000, 3000, 200), [5000]))
        runs = periodic_runs.find_runs(ids, np.array([len(ids) - 1]))
        assert [300, 300 + len(body), q] in runs.tolist()


def test_op13_on_the_smallest_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    expected = {}
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        h = zlib.crc32(str(d["doc_id"]).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        if n > 1500:
            continue  # the plain way takes n * n / 4 steps
        runs = runs_expected(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        expected[d["doc_id"]] = (len(runs), *best, 1000 * best[1] // best[2] if runs else None) + (
            sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))
    rows = queries.queries()["op13_periodic_runs"](spark, sf_dir)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = {r[0]: tuple(r)[1:] for r in rows.collect()}
    assert len(found) == len(docs) and len(expected) > 150
    assert {i: found[i] for i in expected} == expected


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert fill_in_middle.restore(fill_in_middle.fill_in_middle(empty)).collect() == []
    assert periodic_runs.periodic_runs(periodic_runs.with_repeated_tails(empty)).collect() == []


# ---- earlier operators: repeated and other ids, parts, many sources ----------------------------------


def repeats_expected(rows, length=100):
    """(kept, spans) of each (id, text) in the given order, by all strings seen so far."""
    seen, out = set(), []
    for key, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for q in range(len(raw) - length + 1):
            if raw[q : q + length] in seen:
                gone[q : q + length] = b"\1" * length
            seen.add(raw[q : q + length])
        out.append((key, bytes(c for c, g in zip(raw, gone) if not g), len(re.findall(b"\1+", bytes(gone)))))
    return out


@pytest.mark.parametrize("kind", ["long", "string"])
def test_repeats_with_repeated_and_other_ids(spark, kind):
    from clinchline.llm import suffix_dedup

    rng = random.Random(12)
    base = " ".join(f"w{rng.randrange(500)}" for _ in range(120))
    rows = [(1, "x" * 150 + "abc"), (1, base + " one"), (2, base + " two"), (2, base + " two"), (10, "x" * 150 + "abc"), (3, None), (3, ""), (None, base)]
    if kind == "string":
        rows = [(None if i is None else f"id{i}", t) for i, t in rows]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)
    found = sorted((r.doc_id, bytes(r.kept), len(r.removed)) for r in suffix_dedup.remove_repeats(df).collect() if r.doc_id is not None)
    named = [r for r in rows if r[0] is not None]
    orders = [sorted(set((i, t or "") for i, t in named), key=lambda r: (r[0], back * (len(r[1]) or 0))) for back in (1, -1)]
    wanted = []
    for order in orders:  # texts of one id may come in either order
        once = repeats_expected(order)
        copies = [x for (i, t), x in zip(order, once) for _ in range(sum((a, b or "") == (i, t) for a, b in named))]
        wanted.append(sorted(copies))
    assert found in wanted
    nameless = [r for r in suffix_dedup.remove_repeats(df).collect() if r.doc_id is None]
    assert [(bytes(r.kept).decode(), len(r.removed)) for r in nameless] == [(base, 0)]


def items_of(rng, n):
    say = lambda k: " ".join(f"t{rng.randrange(300)}" for _ in range(k))
    return [(i, say(rng.randrange(12, 40)), say(rng.randrange(2, 6))) for i in range(n)]


def test_contamination_does_not_depend_on_parts_or_on_long_items(spark, monkeypatch):
    from clinchline.llm import decontamination

    rng = random.Random(14)
    items = items_of(rng, 40)
    noise = lambda k: " ".join(f"n{rng.randrange(9000)}" for _ in range(k))
    texts = [f"{noise(rng.randrange(300))} {q} {a} {noise(rng.randrange(300))}" for _, q, a in items[:15]]
    texts += [f"{q} {noise(200)} {a}" for _, q, a in items[15:22]]  # the answer lies far from the question
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts + [noise(500)])], "doc_id string, text string")
    schema = "item_id string, question string, answer string"

    def found(rows):
        table = spark.createDataFrame([(None if i is None else f"i{i}", q, a) for i, q, a in rows], schema)
        got = decontamination.contaminated(docs, table).collect()
        return {(r.doc_id, r.item_id): (round(r.score, 9), r.question_overlap, r.answer_overlap, r.passages) for r in got}

    whole = found(items)
    assert {k for k in whole} == {(f"d{i}", f"i{i}") for i in range(15)}
    monkeypatch.setattr(decontamination, "INDEX_ITEMS", 7)
    assert found(items) == whole
    monkeypatch.undo()
    with_long = found([*items, (77, noise(3000), "never")])
    assert with_long.keys() == whole.keys()
    assert all(with_long[k][1:] == whole[k][1:] for k in whole)
    nameless = [(None if i == 3 else i, q, a) for i, q, a in items]
    assert found(nameless).keys() == {(d, None if i == "i3" else i) for d, i in whole}


def test_packing_takes_any_number_of_sources(spark, monkeypatch):
    from clinchline.llm import packing

    rng = random.Random(15)
    rows = [(i, "some words " * rng.randrange(1, 30), f"host{rng.randrange(60)}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    sizes = {r.doc_id: r.doc_tokens for r in packing.pack_documents(docs).collect()}
    monkeypatch.setattr(packing, "OWN_QUEUES", 7)
    monkeypatch.setattr(packing, "TAIL_QUEUES", 3)
    for shares in (None, {"host1": 2, "host2": 1}):
        at, seen = 0, {}
        for r in sorted(packing.pack_documents(docs, shares=shares, window_tokens=500).collect(), key=lambda r: (r.sequence_id, r.offset)):
            assert r.sequence_id * 1024 + r.offset == at
            at += r.length
            seen.setdefault(r.doc_id, []).append((r.start, r.length))
        assert at == sum(sizes.values())
        for i, pieces in seen.items():
            ends = [0, *np.cumsum([n for _, n in sorted(pieces)]).tolist()]
            assert [a for a, _ in sorted(pieces)] == ends[:-1] and ends[-1] == sizes[i]


def test_warc_of_pages_without_ids_and_of_uneven_sizes(spark):
    from clinchline.llm import warc
    from clinchline.llm.common import new_folder

    big = "x" * 200_000
    rows = [(None, "u1", "only here"), (None, "u2", "shared"), (5, "u3", "shared"), (None, None, None), (None, "u4", "twice"), (None, "u5", "twice")]
    rows += [(i, f"p{i}", f"{i} " + (big if i < 110 else "small")) for i in range(100, 400)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, shard string, kind int").repartition(4)
    folder = new_folder(spark, "warc")
    manifest = warc.write_warc(table, folder, shards=6, level=0)
    read = warc.read_warc(spark, folder, manifest).collect()
    assert all(r.digest_ok for r in read)
    got = sorted(((r.page_id or 0), r.url, r.record_type, r.refers_to or 0, r.payload_bytes) for r in read)
    want = []
    for page, url, html in rows:
        revisit = html == "shared" and page is None
        want.append((page or 0, url or "", "revisit" if revisit else "response", 5 if revisit else 0, len(html or "")))
    assert got == sorted(want)
    # shards are of about equal bytes: ten pages hold nearly all of them
    sizes = {}
    for m in manifest.collect():
        sizes[m["shard"]] = sizes.get(m["shard"], 0) + m["bytes"]
    assert len(sizes) == 6 and max(sizes.values()) < 2.2 * sum(sizes.values()) / 6


def test_a_crowd_meets_those_outside_it_only(spark, monkeypatch):
    """One bucket of many copies and a few likenesses outside: rows are dealt once per outside block."""
    from clinchline.llm import near_duplicates

    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    rng = random.Random(17)
    base = [f"w{rng.randrange(10_000)}" for _ in range(200)]
    rows = [(i, " ".join([*base[:-1], f"end{i}"])) for i in range(60)]  # linked with each other
    far = lambda i: [f"z{i}_{k}" if k % 9 == 0 else w for k, w in enumerate(base)]
    rows += [(100 + i, " ".join(far(i))) for i in range(12)] + [(200, " ".join([*far(3)[:-1], "copy"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = {i: {tuple(t.split()[k : k + 3]) for k in range(198)} for i, t in rows}
    low = {i: min(j for j in sets if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])) for i in sets}
    found = near_duplicates.near_duplicates(df, shingle_words=3, threshold=(85, 100)).collect()
    assert {r.doc_id: r.component_id for r in found} == low and low[59] == 0 and low[200] == 103
