"""A deterministic sharded WARC writer, and a reader of what it wrote.

Records are range-sorted by id into shards of about equal bytes, whose bounds are ids of a fixed hash
sample, so a table always gives the same shards. A task writes one shard: its records in order as gzip members, starting another file when the compressed size passes ``roll_bytes``. Headers, record ids and
digests are made anew from the payload. Files are written under a temporary name of the attempt
and moved to their final name when complete; the manifest, which Spark commits after all tasks,
lists the files that count. A task that is run again writes the same bytes to the same names.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from clinchline.llm.common import staged

#: Ids of the hash sample that shard bounds are taken from.
SAMPLED_IDS = 10_000
#: What a record counts beside its payload when shards are sized.
RECORD_BYTES = 500
#: The date of all records, so that the same pages give the same bytes.
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"

_MANIFEST = "file string, shard int, part int, records long, bytes long, sha256 string"
_RECORDS = (
    "page_id long, url string, record_type string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to long, digest_ok boolean"
)


def record_id(page: int | None, digest: str, url: str = "") -> str:
    """Named by id and payload; a page without an id by its url and payload."""
    name = f"page::{url}:{digest}" if page is None else f"page:{page}:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def record_bytes(page: int | None, url: str, payload: bytes, digest: str, first: int | None) -> bytes:
    """One WARC/1.1 record: a response, or a revisit of page ``first`` without the payload."""
    http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(payload)}{CRLF}{CRLF}".encode()
    block = http if first is not None else http + payload
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page, digest, url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header(url)}",
        *([] if page is None else [f"WARC-Page-ID: {page}"]),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{block_digest}",
    ]
    if first is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(first, digest)}",
            f"WARC-Refers-To-Page-ID: {first}",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return CRLF.join(lines).encode() + block + (CRLF + CRLF).encode()


def _header(value: str | None) -> str:
    """A header value on one line: line breaks, percent signs and control characters as %XX."""
    return "".join(c if c > " " and c not in "%\x7f" else f"%{ord(c):02X}" for c in value or "")


def _from_header(value: str) -> str:
    parts = value.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def shard_bounds(source: DataFrame, shards: int) -> list[int]:
    """Ascending ids that split the pages in ``shards`` parts of about equal bytes.

    The bounds are ids of a fixed hash sample; the bytes between each two of them are summed over all
    pages. A range between two sampled ids is not split.
    """
    ids = source.where("page is not null").select("page").orderBy(F.xxhash64("page"), "page").limit(SAMPLED_IDS)
    edges = np.array(sorted({r.page for r in ids.collect()}), dtype=np.int64)
    if not len(edges):
        return []

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(edges, batch.column(0).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column(1)], ["range", "size"])

    sizes = source.where("page is not null").select("page", (F.length("payload") + RECORD_BYTES).cast("long"))
    held = sizes.mapInArrow(ranges, "range int, size long").groupBy("range").agg(F.sum("size").alias("size"))
    per_range = np.zeros(len(edges) + 1, dtype=np.int64)
    for r in held.collect():
        per_range[r["range"]] = r["size"]
    before = np.cumsum(per_range)[:-1]  # bytes of ids below each edge
    wanted = [before[-1] + per_range[-1]] * np.arange(1, shards) / shards
    at = np.searchsorted(before, wanted)
    return sorted({int(edges[k]) for k in at if k < len(edges)})


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    shards: int = 16,
    roll_bytes: int = 64 << 20,
    revisit_from: int = 0,
    level: int = 6,
) -> DataFrame:
    """Write one record per row below ``folder`` and return the manifest (file, shard, part, ...).

    Of records with equal payloads of at least ``revisit_from`` bytes the one with the smallest id
    is a response, the others are revisits of it; smaller payloads are always responses. Null
    payloads are empty, null urls are empty. Repeated rows of an id: the first by url is the response,
    the others revisit it. A page with a null id has a record named by its url and payload and without a
    page id; it revisits a page with an id, or else is a response. Other columns are
    ignored; no rows give a manifest without files. Ids are whole numbers.
    """
    source = pages.select(
        F.col(id_col).cast("long").alias("page"),
        F.coalesce(F.col(url_col), F.lit("")).alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    bounds = np.array(shard_bounds(source, shards), dtype=np.int64)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("page")
            at = np.searchsorted(bounds, pages.fill_null(0).to_numpy(), side="right")
            for i in np.flatnonzero(pages.is_null().to_numpy(zero_copy_only=False)):
                # pages without an id are dealt out by their payload, with what they revisit
                raw = batch.column("payload")[int(i)].as_py()
                raw = hashlib.sha1(raw).digest() if batch.column("kind")[int(i)].as_py() else raw
                at[i] = int.from_bytes(raw[:4], "big") % (len(bounds) + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), *batch.columns], ["shard", *batch.schema.names]
            )

    digests = source.select("page", F.sha1("payload").alias("digest"), F.length("payload").alias("size"))
    firsts = (
        digests.join(digests.groupBy("digest").agg(F.min("page").alias("first")), "digest")
        .where((F.col("size") >= revisit_from) & F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page")))
        .select("page", "digest", "first")
        .distinct()
    )
    rows = source.select("page", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("first")).union(
        firsts.select("page", F.lit(0), F.lit(""), F.unhex("digest"), "first")
    )
    layout = "shard int, page long, kind int, url string, payload binary, first long"
    dealt = (
        rows.mapInArrow(shard, layout)
        .repartitionById(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", "page", "kind", "url", "payload")
    )
    manifest = staged(dealt.mapInArrow(_writer(folder, roll_bytes, revisit_from, level), _MANIFEST), "manifest")
    _remove_unfinished(folder)
    return manifest


def _remove_unfinished(folder: str) -> None:
    """Remove the temporary files of attempts that failed; all tasks are done."""
    from pyarrow.fs import FileSelector

    fs, root = _filesystem(folder)
    for found in fs.get_file_info(FileSelector(root, allow_not_found=True)):
        if found.base_name.startswith(".part-") and found.base_name.endswith(".tmp"):
            fs.delete_file(found.path)


class _File:
    """One archive file under its temporary name."""

    def __init__(self, fs, root: str, shard: int, part: int):
        self.fs, self.shard, self.part, self.records, self.size = fs, shard, part, 0, 0
        self.name = f"part-{shard:05d}-{part:05d}.warc.gz"
        self.final, self.temp = f"{root}/{self.name}", f"{root}/.{self.name}.{uuid.uuid4().hex}.tmp"
        self.out, self.sha = fs.open_output_stream(self.temp, compression=None), hashlib.sha256()

    def add(self, record: bytes, level: int) -> None:
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        for piece in (packer.compress(record), packer.flush()):
            self.out.write(piece)
            self.sha.update(piece)
            self.size += len(piece)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        self.fs.move(self.temp, self.final)
        return self.name, self.shard, self.part, self.records, self.size, self.sha.hexdigest()


def _writer(folder: str, roll_bytes: int, revisit_from: int, level: int):
    names = ["file", "shard", "part", "records", "bytes", "sha256"]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        file, done = None, []
        at: tuple = (None, None)
        earlier: dict[bytes, int] = {}  # of one page: digest -> the response's page
        for batch in batches:
            shards, pages, kinds_, firsts = (batch.column(c).to_pylist() for c in ("shard", "page", "kind", "first"))
            for i, (shard, page, kind, first) in enumerate(zip(shards, pages, kinds_, firsts)):
                if at != (shard, page):
                    at, earlier = (shard, page), {}
                payload = batch.column("payload")[i].as_py()
                if kind == 0:
                    earlier[payload] = first
                    continue
                raw = hashlib.sha1(payload).digest()
                refers = earlier.get(raw)
                if page is not None and len(payload) >= revisit_from:
                    earlier.setdefault(raw, page)
                if file is not None and (file.shard != shard or file.size >= roll_bytes):
                    part = file.part + 1 if file.shard == shard else 0
                    done.append(file.close())
                    file = _File(fs, root, shard, part)
                elif file is None:
                    file = _File(fs, root, shard, 0)
                url = batch.column("url")[i].as_py()
                file.add(record_bytes(page, url, payload, base64.b32encode(raw).decode(), refers), level)
        if file is not None:
            done.append(file.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    return run


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """One row per record of the files that the manifest lists.

    Payload size and digest of a response are computed from its bytes and held against the header
    (``digest_ok``); a revisit, which has no payload, states those of the full payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out: list[tuple] = []
                size = 0
                for record in _members(fs, f"{root}/{name}"):
                    out.append(_parsed(record))
                    size += len(record)
                    if size > 4 << 20:
                        yield _batch(out)
                        out, size = [], 0
                if out:
                    yield _batch(out)

    files = manifest.select("file")
    return files.repartition(max(1, manifest.select("file").count()), "file").mapInArrow(run, _RECORDS)


def _members(fs, path: str) -> Iterator[bytes]:
    """The gzip members of a file, one after the other."""
    with fs.open_input_stream(path, compression=None) as stream:
        data, ended = b"", False
        while True:
            unpacker, parts = zlib.decompressobj(31), []
            while not unpacker.eof:
                if not data:
                    data = stream.read(1 << 20)
                    if not data:
                        if parts:
                            raise ValueError(f"{os.path.basename(path)} ends inside a record")
                        return
                parts.append(unpacker.decompress(data))
                data = unpacker.unused_data
            yield b"".join(parts)


def _parsed(record: bytes) -> tuple:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split(CRLF)[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    page = int(fields["WARC-Page-ID"]) if "WARC-Page-ID" in fields else None
    url = _from_header(fields["WARC-Target-URI"])
    if fields["WARC-Type"] == "revisit":
        size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))[15:])
        return page, url, "revisit", None, size, stated, int(fields["WARC-Refers-To-Page-ID"]), True
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return page, url, "response", payload, len(payload), digest, None, digest == stated


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "digest_ok"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
