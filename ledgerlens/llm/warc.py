"""WARC archives with a two-level capture index.

Writing: every task attempt writes gzip-member-per-record archives of its own
name to the shared folder (a temporary name, then a rename) and hands out one
index line per record. Only the lines of committed attempts are kept, so the
files of a lost or doubled attempt are never read. Index: lines are
sorted by reversed-host URL key over range partitions and packed into
compressed blocks; each index file ends with its sparse block directory.
Reading: a key's file is found by the files' bounds, its block by binary
search in the directory, and its record by one range read of the archive.

Files go through ``pyarrow.fs``, so the folder may be local or in an object
store; URIs of Hadoop's ``s3a`` are read as ``s3``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from bisect import bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import Stages, ready
from ledgerlens.operators.joins import join_per_key
from ledgerlens.session import scratch_path

#: an archive is closed when it is so long
ARCHIVE_BYTES = 1 << 30
#: index lines of one compressed block
BLOCK_LINES = 1000
#: blocks that one task reads back
TASK_BLOCKS = 4
_DATE = "2024-01-01T00:00:00Z"
_TAIL = "<QI"  # place and length of an index file's directory


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://Www.A.example.com:80/x?q#f`` ->
    ``com,example,a,www)/x?q``. A null or hostless URL is its own key."""
    if not url:
        return ")"
    try:
        p = urlsplit(url)
        host = (p.hostname or "").lower()
        port = p.port
    except ValueError:
        return ")" + url
    if not host:
        return ")" + url
    tail = f":{port}" if port and port not in (80, 443) else ""
    return ",".join(reversed(host.split("."))) + tail + ")" + (p.path or "/") + (f"?{p.query}" if p.query else "")


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    uri = uri.replace("s3a://", "s3://", 1)
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:") if uri.startswith("file:") else "file://" + uri
    return fs.FileSystem.from_uri(uri)


def record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit has no payload: its
    profile, digest and referred record stand for it."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
            ("WARC-Date", _DATE), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", "text/html; charset=utf-8"), ("WARC-Target-URI", _line(url))]
    body = payload
    if kind == "revisit":
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
        body = b""
    head.append(("Content-Length", str(len(body))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v is not None) + "\r\n"
    return gzip.compress(text.encode() + body + b"\r\n\r\n", 1, mtime=0)


def _line(url: str | None) -> str | None:
    """A header value: line ends would end it, so they are percent-coded."""
    return None if url is None else url.replace("%0D", "%250D").replace("%0A", "%250A").replace("\r", "%0D").replace("\n", "%0A")


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of a record."""
    data = gzip.decompress(member)
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    return head, data[end + 4:end + 4 + int(head["Content-Length"])]


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plan_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_bytes: int) -> DataFrame:
    """``page_id, url, html, refers_to``: of pages with equal payloads of at
    least ``min_bytes``, the one with the largest id is a response (null
    ``refers_to``) and others refer to it. Only ids and digests are grouped
    and joined; a payload travels once."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("html"))
    thin = rows.select("page_id", F.sha1("html").alias("digest"), F.octet_length("html").alias("n"))
    leaders = (thin.where((F.col("n") >= min_bytes) & F.col("page_id").isNotNull())
               .groupBy("digest").agg(F.max("page_id").alias("lead"), F.count("*").alias("copies")).where("copies > 1"))
    # both sides are dealt for the join, so the copies of a hot payload can be split
    revisits = (join_per_key(thin.where("page_id is not null"), leaders, "digest").where("page_id < lead")
                .select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), F.col("lead").alias("refers_to"))
                .distinct())
    return rows.withColumn("digest", F.sha1("html")).join(
        revisits, (F.col("page_id") == F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left"
    ).select("page_id", "url", "html", "refers_to")


LINES = "key string, page_id long, kind string, digest string, archive string, place long, length long"


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """Writes one record per row of ``pages`` under ``folder`` and returns the
    index lines (run once: stage it). Null html is an empty payload; a null
    id is written as a response with an empty record id; rows that repeat id
    and payload are written each."""
    ready(pages.sparkSession)

    def write(batches):
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        out, name, place, n = None, None, 0, 0
        for b in batches:
            lines = []
            for page_id, url, html, refers in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    name, place = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{n:04d}.warc.gz", 0
                    temp = f"{root}/_{name}.{uuid.uuid4().hex}"
                    out, n = files.open_output_stream(temp, compression=None), n + 1
                digest = sha1_base32(html)
                kind = "response" if refers is None else "revisit"
                member = record(page_id, url, html, digest, kind, refers)
                out.write(member)
                lines.append((url_key(url), page_id, kind, digest, name, place, len(member)))
                place += len(member)
                if place >= ARCHIVE_BYTES:
                    out.close()
                    files.move(temp, f"{root}/{name}")
                    out = None
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*lines), _LINE_TYPES)], _LINE_NAMES)
        if out is not None:
            out.close()
            files.move(temp, f"{root}/{name}")

    return plan_records(pages, id_col, url_col, html_col, min_bytes).mapInArrow(write, LINES)


_LINE_NAMES = ["key", "page_id", "kind", "digest", "archive", "place", "length"]
_LINE_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]


def write_index(lines: DataFrame, folder: str) -> DataFrame:
    """Sorts index lines by key into block files; returns ``file, first_key,
    last_key, n_lines`` of each file, in no order (run once: stage it)."""
    ready(lines.sparkSession)

    def pack(batches):
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"index-{task.partitionId():06d}-{task.taskAttemptId()}.cdx"
        temp = f"{root}/_{name}.{uuid.uuid4().hex}"
        out, place, block, directory, total, first, last = None, 0, [], [], 0, None, None

        def flush():
            nonlocal place, block
            data = zlib.compress("\n".join(json.dumps(r) for r in block).encode(), 6)
            out.write(data)
            directory.append((block[0][0], place, len(data)))
            place, block = place + len(data), []

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out, first = files.open_output_stream(temp, compression=None), row[0]
                block.append(row)
                last, total = row[0], total + 1
                if len(block) == BLOCK_LINES:
                    flush()
        if out is None:
            return
        if block:
            flush()
        data = zlib.compress(json.dumps(directory).encode(), 6)
        out.write(data + struct.pack(_TAIL, place, len(data)))
        out.close()
        files.move(temp, f"{root}/{name}")
        yield pa.RecordBatch.from_pydict({"file": [name], "first_key": [first], "last_key": [last], "n_lines": [total]})

    ordered = lines.select(*_LINE_NAMES).repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return ordered.mapInArrow(pack, "file string, first_key string, last_key string, n_lines long")


class IndexFile:
    """One index file: its directory in memory, its blocks by range read."""

    def __init__(self, files: fs.FileSystem, path: str):
        self.f = files.open_input_file(path)
        size = self.f.size()
        tail = struct.calcsize(_TAIL)
        at, n = struct.unpack(_TAIL, self.f.read_at(tail, size - tail))
        self.directory = json.loads(zlib.decompress(self.f.read_at(n, at)))
        self.keys = [d[0] for d in self.directory]

    def block(self, i: int) -> list[list]:
        _, at, n = self.directory[i]
        return [json.loads(x) for x in zlib.decompress(self.f.read_at(n, at)).decode().split("\n")]

    def lookup(self, key: str) -> list[list]:
        """Lines of a key: binary search in the directory, then in blocks."""
        i = max(0, bisect_right(self.keys, key) - 1)
        while i > 0 and self.keys[i] == key:  # the key may begin in the block before
            i -= 1
        out = []
        while i < len(self.keys) and self.keys[i] <= key:
            out += [r for r in self.block(i) if r[0] == key]
            i += 1
        return out


def _read_lines(files, root, archives: dict, lines):
    """Records of index lines, by range reads."""
    for key, page_id, kind, digest, archive, place, length in lines:
        if archive not in archives:
            if len(archives) > 64:
                archives.clear()
            archives[archive] = files.open_input_file(f"{root}/{archive}")
        yield key, page_id, parse(archives[archive].read_at(length, place))


RECORDS = "key string, page_id long, record_type string, digest string, refers_to long, payload binary"


def _record_row(key, page_id, head, body):
    refers = head.get("WARC-Refers-To")
    return (key, page_id, head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"),
            int(refers.removeprefix("<urn:page:").removesuffix(">")) if refers else None, body)


def _record_batch(rows):
    types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      ["key", "page_id", "record_type", "digest", "refers_to", "payload"])


def read_all(spark: SparkSession, bounds: DataFrame, archives: str, index: str) -> DataFrame:
    """Every record, block by block through the index."""
    ready(spark)

    def blocks(batches):
        files, root = open_folder(index)
        for b in batches:
            for name in b.column(0).to_pylist():
                n = len(IndexFile(files, f"{root}/{name}").directory)
                yield pa.RecordBatch.from_pydict({"file": [name] * n, "block": list(range(n))})

    def read(batches):
        files, root = open_folder(index)
        a_files, a_root = open_folder(archives)
        open_index, open_archives = {}, {}
        for b in batches:
            for name, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if name not in open_index:
                    open_index = {name: IndexFile(files, f"{root}/{name}")}
                rows, size = [], 0
                for key, page_id, (head, body) in _read_lines(a_files, a_root, open_archives, open_index[name].block(i)):
                    rows.append(_record_row(key, page_id, head, body))
                    size += len(body)
                    if size > 1 << 23:
                        yield _record_batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _record_batch(rows)

    total = bounds.agg(F.sum(F.ceil(F.col("n_lines") / BLOCK_LINES))).first()[0] or 0
    # a fixed number of partitions: by the size of their names Spark would read all blocks in one task
    return (bounds.select("file").mapInArrow(blocks, "file string, block long")
            .repartition(max(1, -(-total // TASK_BLOCKS)), "file", "block").mapInArrow(read, RECORDS))


#: index files whose bounds may be broadcast to look keys up
MAX_INDEX_FILES = 100_000


def lookup(urls: DataFrame, bounds: DataFrame, archives: str, index: str, url_col: str = "url") -> DataFrame:
    """``url`` and its records: the URL's index files by their bounds (a
    checked number of them), then binary search and range reads. URLs without
    a capture give no row; a null URL finds the records without one."""
    spark = urls.sparkSession
    ready(spark)
    files = bounds.limit(MAX_INDEX_FILES + 1).collect()
    if len(files) > MAX_INDEX_FILES:
        raise ValueError(f"more than {MAX_INDEX_FILES} index files: pack the index into fewer")
    spans = sorted((r["first_key"], r["last_key"], r["file"]) for r in files)

    def find(batches):
        idx_files, idx_root = open_folder(index)
        a_files, a_root = open_folder(archives)
        opened, open_archives = {}, {}
        firsts = [s[0] for s in spans]
        for b in batches:
            out, rows = [], []
            for url in b.column(0).to_pylist():
                key = url_key(url)
                i = bisect_right(firsts, key) - 1
                while i >= 0 and spans[i][1] >= key:
                    name = spans[i][2]
                    if name not in opened:
                        if len(opened) > 64:
                            opened.clear()
                        opened[name] = IndexFile(idx_files, f"{idx_root}/{name}")
                    for k, page_id, (head, body) in _read_lines(a_files, a_root, open_archives, opened[name].lookup(key)):
                        out.append(url)
                        rows.append(_record_row(k, page_id, head, body))
                    i -= 1
            if rows:
                batch = _record_batch(rows)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *batch.columns], ["url", *batch.schema.names])

    return urls.select(F.col(url_col).cast("string").alias("url")).mapInArrow(find, f"url string, {RECORDS}")


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` to archives and an index in the shared folder, reads
    every record back through the index: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``. A revisit's length is that of
    the response it refers to, the digest is computed anew from the payload
    read (a revisit's is compared by the join)."""
    spark = pages.sparkSession
    base = scratch_path(spark, f"warc-{uuid.uuid4().hex[:12]}")
    st = Stages(spark, "warc-index")
    lines = st.write(write_archives(pages, f"{base}/archives", min_bytes=min_bytes), "lines")
    bounds = st.write(write_index(lines, f"{base}/index"), "bounds")

    def measure(batches):
        for b in batches:
            bodies = b.column(5).to_pylist()
            kinds = b.column(2).to_pylist()
            digests = [sha1_base32(x) if k == "response" else d for x, k, d in zip(bodies, kinds, b.column(3).to_pylist())]
            sizes = [len(x) if k == "response" else None for x, k in zip(bodies, kinds)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                                              b.column(2), b.column(4)], names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    got = st.write(read_all(spark, bounds, f"{base}/archives", f"{base}/index").mapInArrow(
        measure, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"), "records")
    st.drop(lines)
    responses = got.where("record_type = 'response'").select(
        F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n")).distinct()
    revisits = got.where("record_type = 'revisit'").drop("payload_bytes").join(
        responses, F.col("payload_digest") == F.col("d")).withColumnRenamed("n", "payload_bytes").select(*names)
    return got.where("record_type = 'response'").unionByName(revisits)
