"""CSV exports in mixed character sets (UTF-8, UTF-8 with BOM, GBK family).

A large file is read by many tasks. Spark's text source cuts it into byte
ranges at line feeds, which no character of UTF-8 or GB18030 contains (nor a
comma or a quote), and hands on the lines' bytes as they are. Each range is
packed into chunks of whole lines, written once, with what the rest needs to
know of them: whether they are valid UTF-8, and in which state, inside or
outside a quoted cell, a chunk ends for either state it may begin in. These
small maps are composed in file order, so every chunk learns its true
beginning; what it holds of a record begun earlier goes to the chunk where
that began. Chunks are then parsed on their own, by the charset and header of
their file; neither paths nor rows reach the driver.
"""

from __future__ import annotations

import csv
import io
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.align import clean_name
from ledgerlens.session import scratch_path, ship_package

_BATCH_ROWS = 5000
#: bytes of lines in a chunk (one longer line is a chunk of its own)
CHUNK_BYTES = 1 << 20
#: characters of one cell (a whole text may stand in it)
_CELL = (1 << 31) - 1
_OPENS = re.compile(rb'[,\r\n]"')


def quoted_after(line: bytes, quoted: bool) -> bool:
    """Whether a quoted cell is open at the end of ``line``, given whether one
    was at its start. A quote opens a cell only as its first character; a
    doubled one inside stands for itself."""
    at = 0
    if not quoted:
        if line[:1] == b'"':
            at, quoted = 1, True
        else:
            m = _OPENS.search(line)
            if m is None:
                return False
            at, quoted = m.end(), True
    while True:
        at = line.find(b'"', at)
        if at < 0:
            return True
        if line[at + 1:at + 2] == b'"':
            at += 2
            continue
        m = _OPENS.search(line, at + 1)
        if m is None:
            return False
        at = m.end()


def _chunks(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Written chunks: ``file, start, seq`` (range and place in it),
    ``content`` (the reader takes a BOM away), ``valid`` (UTF-8), ``q0``/``q1``
    (ends inside quotes when it begins outside / inside) and ``lead`` (bytes
    up to the first record end when it begins inside)."""
    ship_package(spark)
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("lineSep", "\n")
             .text(path).select(F.col("_metadata.file_path").alias("file"),
                                F.col("_metadata.file_block_start").alias("start"),
                                F.col("value").cast("binary").alias("line"), F.is_valid_utf8("value").alias("valid")))
    schema = "file string, start long, seq int, content binary, valid boolean, q0 boolean, q1 boolean, lead long"
    names = [c.split()[0] for c in schema.split(", ")]

    def pack(batches):
        place, seq, held, size, valid, state, lead = None, 0, [], 0, True, (False, True), -1

        def chunk():
            content = b"\n".join(held) + b"\n"
            return pa.RecordBatch.from_pylist([dict(zip(names, (
                *place, seq, content, valid, *state, len(content) if lead < 0 else lead)))], schema=arrow)

        for b in batches:
            for file, start, line, ok in zip(*(c.to_pylist() for c in b.columns)):
                if held and ((file, start) != place or size >= CHUNK_BYTES):
                    yield chunk()
                    seq, held, size, valid, state, lead = seq + 1, [], 0, True, (False, True), -1
                if (file, start) != place:
                    place, seq = (file, start), 0
                held.append(line)
                size += len(line) + 1
                valid = valid and ok
                if b'"' in line:
                    state = quoted_after(line, state[0]), quoted_after(line, state[1])
                if lead < 0 and not state[1]:
                    lead = size
        if held:
            yield chunk()

    arrow = pa.schema([("file", pa.string()), ("start", pa.int64()), ("seq", pa.int32()), ("content", pa.binary()),
                       ("valid", pa.bool_()), ("q0", pa.bool_()), ("q1", pa.bool_()), ("lead", pa.int64())])
    out = scratch_path(spark, f"csv-chunks-{uuid.uuid4().hex[:12]}")
    lines.mapInArrow(pack, schema).write.parquet(out)
    return spark.read.schema(schema).parquet(out)


def _profile(spark: SparkSession, path: str, glob: str, chunks: DataFrame) -> DataFrame:
    """``file, path, charset, has_bom`` of every file (Spark's scans leave
    out those of no bytes). Only a BOM makes a file two or three bytes longer
    than its lines with their line feeds."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
             .load(path).select("path", "length", F.col("_metadata.file_path").alias("file")))
    judged = chunks.groupBy("file").agg(F.bool_and("valid").alias("valid"),
                                        F.sum(F.octet_length("content").cast("long")).alias("size"))
    bom = F.col("length") - F.coalesce("size", F.lit(0)) >= 2
    charset = F.when(bom | F.coalesce("valid", F.lit(True)), "UTF-8").otherwise("GB18030")
    return files.join(judged, "file", "left").select("file", "path", charset.alias("charset"), bom.alias("has_bom"))


def charset_profile(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(path, charset, has_bom) per file: 'UTF-8' when a BOM is present or
    the whole content is valid UTF-8, else 'GB18030' (a superset of GBK,
    GB2312 and CP936). All ranges of a file are judged; the verdict is an
    aggregate."""
    return _profile(spark, path, glob, _chunks(spark, path, glob)).drop("file")


def _placed(chunks: DataFrame) -> DataFrame:
    """The chunks' places without their content: ``inside`` (begins inside
    quotes), ``first`` (of its file), ``body`` (a record begins in it) and
    ``owner`` (place of the last chunk before in which one does). One small row per chunk, so a
    file of a terabyte is a million rows in its window."""
    order = Window.partitionBy("file").orderBy("start", "seq")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # a chunk fixes its end state, keeps it or turns it round: the state is the last fixed one, turned since
    turns = F.sum((F.col("q0") & ~F.col("q1")).cast("long"))
    rows = (chunks.select("file", "start", "seq", "q0", "q1", "lead", F.octet_length("content").alias("size"))
            .withColumns({"upto": F.coalesce(turns.over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)),
                          "ahead": F.coalesce(turns.over(before), F.lit(0))}))
    fixed = F.when(F.col("q0") == F.col("q1"), F.pmod(F.col("q0").cast("long") + F.col("upto"), F.lit(2)))
    rows = rows.withColumn("fixed", F.coalesce(F.last(fixed, ignorenulls=True).over(before), F.lit(0)))
    rows = rows.withColumn("inside", F.pmod(F.col("fixed") + F.col("ahead"), F.lit(2)) == 1)
    rows = rows.withColumn("body", ~F.col("inside") | (F.col("lead") < F.col("size")))
    place = F.struct("start", "seq")
    return rows.select("file", "start", "seq", "lead", "inside", "body",
                       (F.row_number().over(order) == 1).alias("first"),
                       F.last(F.when(F.col("body"), place), ignorenulls=True).over(before).alias("owner"))


def _pieces(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Runs of whole records: ``file, path, charset, first, content``."""
    chunks = _chunks(spark, path, glob)
    key = ["file", "start", "seq"]
    placed = _placed(chunks)
    begun = (placed.where("inside").join(chunks.select(*key, "content"), key)
             .select("file", "owner.start", "owner.seq", F.struct(
                 F.col("start").alias("s"), F.col("seq").alias("q"),
                 F.expr("substring(content, 1, CAST(lead AS INT))").alias("b")).alias("part")))
    ends = begun.groupBy(*key).agg(F.array_sort(F.collect_list("part")).alias("parts"))
    tail = F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["b"]))
    own = F.expr("CASE WHEN inside THEN substring(content, CAST(lead AS INT) + 1) ELSE content END")
    of_file = _profile(spark, path, glob, chunks).drop("has_bom")
    return (chunks.select(*key, "content").join(placed.where("body").join(of_file, "file"), key)
            .join(ends.select(*key, tail.alias("tail")), key, "left")
            .select("file", "path", "charset", "first", F.concat(own, F.coalesce("tail", F.lit(b""))).alias("content")))


def _records(content: bytes, charset: str):
    csv.field_size_limit(_CELL)
    return csv.reader(io.TextIOWrapper(io.BytesIO(content), charset, errors="replace", newline=""))


def _heads(pieces: DataFrame) -> DataFrame:
    """``h_file, head``: the cleaned titles of each file's first record."""
    def heads(batches):
        for b in batches:
            for file, charset, content in zip(*(c.to_pylist() for c in b.columns)):
                head = [clean_name(t) for t in next(_records(content, charset), [])]
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([head], pa.list_(pa.string()))], ["h_file", "head"])

    return pieces.where("first").select("file", "charset", "content").mapInArrow(heads, "h_file string, head array<string>")


def _titles(heads: DataFrame) -> list[str]:
    return sorted(r["t"] for r in heads.select(F.explode("head").alias("t")).distinct().collect() if r["t"])


def csv_titles(spark: SparkSession, path: str, glob: str = "*.csv") -> list[str]:
    """Sorted union of the files' cleaned titles (only distinct ones are collected)."""
    return _titles(_heads(_pieces(spark, path, glob)))


def read_csv_any_charset(spark: SparkSession, path: str, glob: str = "*.csv",
                         titles: list[str] | None = None) -> DataFrame:
    """Every CSV under ``path``, read with its own charset and header; all
    columns as text (empty cells null), plus ``source_file`` and ``charset``.

    ``titles`` names the wanted columns (default: the union of all headers).
    Columns are aligned by cleaned title; a file lacking one gives nulls, of a
    repeated title the last column wins. Quoted cells may hold line ends; one
    left open ends with its file. A file is as many tasks' work as Spark cuts
    it into ranges (``spark.sql.files.maxPartitionBytes``), and again by its
    chunks."""
    pieces = _pieces(spark, path, glob)
    heads = _heads(pieces)
    titles = _titles(heads) if titles is None else list(titles)
    names = [*titles, "source_file", "charset"]

    def parse(batches):
        for b in batches:
            for path, charset, first, content, head in zip(*(c.to_pylist() for c in b.columns)):
                records = _records(content, charset)
                if first:
                    next(records, None)
                place = {t: i for i, t in enumerate(head)}
                picks = [place.get(t) for t in titles]
                rows = []
                for r in records:
                    if r:
                        rows.append([r[i] or None if i is not None and i < len(r) else None for i in picks] + [path, charset])
                    if len(rows) >= _BATCH_ROWS:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names)

    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return (pieces.join(heads, F.col("file") == F.col("h_file"))
            .select("path", "charset", "first", "content", "head").mapInArrow(parse, schema))
