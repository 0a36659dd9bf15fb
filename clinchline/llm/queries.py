"""Registered queries of the operators, each over its whole table, and check SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinchline.llm import chat, decontamination, fill_in_middle, fingerprints, near_duplicates, nearest
from clinchline.llm import packing, periodic_runs, quality, secrets, suffix_dedup, token_counts, warc
from clinchline.llm.common import new_folder, partitions

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers must find this package wherever the driver was started
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    # rows hold whole texts: small Arrow batches keep workers and their executor small
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = chat.format_chats(chat.records_of_rows(rows, "conv_id", "turn", "role", "text"))
    read = chats.select(
        "conv_id",
        "layout",
        "formatted",
        chat.read_chats(F.col("formatted")).alias("turns"),
        F.array_join(chat.learned_texts(F.col("formatted"), F.col("loss_spans")), "").alias("learned"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "layout",
    )


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(
        table(spark, sf_dir, "documents"), shingle_words=3, threshold=(85, 100)
    )


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_changes(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sigs")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sigs")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op4_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    manifest = warc.write_warc(table(spark, sf_dir, "pages"), folder, shards=partitions(spark))
    return warc.read_warc(spark, folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions and answers of the benchmark, whose items are one text each: see ``split_item``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            parts = [decontamination.split_item(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), *(pa.array([p[k] for p in parts], pa.string()) for k in (0, 1))],
                ["item_id", "question", "answer"],
            )

    return (
        table(spark, sf_dir, "benchmark")
        .select(F.col("item_id").cast("long"), "text")
        .mapInArrow(run, "item_id long, question string, answer string")
    )


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), benchmark_items(spark, sf_dir)
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "dense")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    arranged = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return fill_in_middle.restore(arranged).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"
    )


def op12_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeated_tails(table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs).withColumn("longest", periodic_runs.longest_run(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_QUERIES = (
    op1_chat_formatting, op2_minhash_near_dedup, op3_spotsigs, op4_warc_writer, op5_quality_classifier,
    op6_token_counts, op7_benchmark_decontamination, op8_suffix_dedup, op9_mixture_packing, op10_secret_scan,
    op11_fill_in_middle, op12_multi_index_hashing, op13_periodic_runs,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP1 = r"""
WITH turns AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *,
    replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ':', '\c') AS r,
    replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>') AS t
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(r) + length(t) + 14) AS BIGINT) AS formatted_chars,
  CASE string_agg(role, '|' ORDER BY turn, role, text)
    WHEN 'user|assistant' THEN 'prompt' WHEN 'system|user|assistant' THEN 'instruction' ELSE 'messages' END AS layout
FROM escaped GROUP BY conv_id
"""

_OP2 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3
      THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, chr(10))] ELSE [] END) AS s FROM words),
sizes AS MATERIALIZED (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
inverted AS MATERIALIZED (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM inverted x JOIN inverted y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
sym AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(root, node) AS (
  SELECT DISTINCT a, a FROM sym UNION SELECT root, b FROM reach JOIN sym ON node = a),
low AS (SELECT node, min(root) AS c FROM reach GROUP BY node)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id, doc_id = coalesce(c, doc_id) AS kept
FROM sizes LEFT JOIN low ON node = doc_id
"""

_OP3 = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
nexts AS (
  SELECT doc_id, t, coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id,
    coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS u FROM docs),
edits AS MATERIALIZED (
  SELECT doc_id, next_id, t, substring(t, 1, length(t) - length(t) // 4) || substring(u, 1, length(t) // 4) AS e FROM nexts),
pair AS (SELECT doc_id, false AS edited, t FROM edits UNION ALL SELECT doc_id, true, e FROM edits),
listed AS MATERIALIZED (
  SELECT doc_id, edited, string_split(trim(regexp_replace(lower(t), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS l FROM pair),
words AS (SELECT doc_id, edited, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS i FROM listed),
marked AS (SELECT *, w IN ({", ".join(repr(a) for a in sorted(set(fingerprints.ANCHORS)))}) AS anchor FROM words),
parts AS (SELECT *, sum(CAST(anchor AS INT)) OVER (PARTITION BY doc_id, edited ORDER BY i) AS part FROM marked),
chains AS (
  SELECT doc_id, edited, anchor, w, lead(w) OVER near AS x, lead(w, 2) OVER near AS y, count(*) OVER (PARTITION BY doc_id, edited, part) AS n
  FROM parts WINDOW near AS (PARTITION BY doc_id, edited, part ORDER BY i)),
spots AS (
  SELECT DISTINCT doc_id, edited, concat_ws(' ', w, x, y) AS s FROM chains
  WHERE (anchor AND x IS NOT NULL) OR (n > {fingerprints.SPARSE} AND y IS NOT NULL)),
sets AS (SELECT doc_id, edited, list_sort(list_distinct(list(substr(md5(s), 1, 12)))) AS k FROM spots GROUP BY ALL),
prints AS MATERIALIZED (
  SELECT listed.doc_id, listed.edited, coalesce(k, [substr(md5(array_to_string(l, ' ')), 1, 12)]) AS k
  FROM listed LEFT JOIN sets ON sets.doc_id = listed.doc_id AND sets.edited = listed.edited)
SELECT d.doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(e) AS edited_sha256, array_to_string(a.k, '') AS fingerprint,
  array_to_string(b.k, '') AS edited_fingerprint,
  CAST(len(list_intersect(a.k, b.k)) AS DOUBLE) / len(list_distinct(a.k || b.k)) AS near_edited,
  CAST(len(list_intersect(a.k, c.k)) AS DOUBLE) / len(list_distinct(a.k || c.k)) AS near_next
FROM edits d JOIN prints a ON a.doc_id = d.doc_id AND NOT a.edited JOIN prints b ON b.doc_id = d.doc_id AND b.edited
JOIN prints c ON c.doc_id = next_id AND NOT c.edited
"""

_OP4 = r"""
WITH raw AS (SELECT page_id, encode(coalesce(html, '')) AS p FROM pages),
digests AS (SELECT page_id, octet_length(p) AS n, sha1(p) AS h FROM raw),
firsts AS (SELECT h, min(page_id) AS first FROM digests GROUP BY h),
bits AS (
  SELECT page_id, n, digests.h, first,
    array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111',
      4 * (strpos('0123456789abcdef', substr(digests.h, i, 1)) - 1) + 1, 4)), '') AS b
  FROM digests JOIN firsts ON digests.h = firsts.h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT)
      + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT) + CAST(substr(b, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM bits
"""

_OP8 = r"""
WITH raw AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT doc_id, b, unnest(range(0, greatest(octet_length(b) - 99, 0))) AS q FROM raw),
windows AS MATERIALIZED (SELECT doc_id, q, md5(array_slice(b, q + 1, q + 100)) AS h FROM starts),
ranked AS (SELECT doc_id, q, row_number() OVER (PARTITION BY h ORDER BY doc_id, q) AS k FROM windows),
gone AS (SELECT doc_id, q, q + 100 AS e FROM ranked WHERE k > 1),
marked AS (SELECT *, coalesce(q > max(e) OVER (PARTITION BY doc_id ORDER BY q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new FROM gone),
numbered AS (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY q) AS span FROM marked),
spans AS MATERIALIZED (SELECT doc_id, span, min(q) AS s, max(e) AS e FROM numbered GROUP BY ALL),
parts AS (
  SELECT doc_id, s, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS before, e FROM spans),
kept AS (
  SELECT p.doc_id, string_agg(hex(array_slice(b, before + 1, s)), '' ORDER BY s) AS k, max(p.e) AS e, sum(p.e - p.s) AS n, count(*) AS m
  FROM parts p JOIN raw ON raw.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT raw.doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(m, 0) AS BIGINT) AS n_spans,
  sha256(CASE WHEN n IS NULL THEN b ELSE unhex(k || hex(array_slice(b, e + 1, octet_length(b)))) END) AS kept_sha256
FROM raw LEFT JOIN kept ON kept.doc_id = raw.doc_id
"""


_OP11 = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
numbers AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM hashed),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (
  SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": _OP1,
        "op2_minhash_near_dedup": _OP2,
        "op3_spotsigs": _OP3,
        "op4_warc_writer": _OP4,
        "op8_suffix_dedup": _OP8,
        "op11_fill_in_middle": _OP11,
    }
