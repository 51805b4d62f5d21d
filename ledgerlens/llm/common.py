"""Shared helpers of the training-data operators: reading, staging, word and
shingle hashing, connected components."""

from __future__ import annotations

import gc
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path, ship_package

#: a word of a text: what ``bytes.split()`` yields on its UTF-8 bytes
WORD = r"[^\x20\x09-\x0D]+"

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


#: bytes of one Arrow batch handed to a Python worker: bounds its memory when texts are long
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession) -> None:
    """Ship the package to the workers and bound the session's Arrow batches."""
    ship_package(spark)
    spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    ready(spark)
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


class Stages:
    """Stage tables of one operator call, written as Parquet under the shared
    checkpoint folder (they cut lineage and survive lost executors)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
        self.n = 0
        self.live: list[DataFrame] = []

    def write(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n:04d}-{name}"
        df.write.parquet(path, compression=compression)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        self.live.append(out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove stage tables that no later result reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for f in frames:
            path = jvm.org.apache.hadoop.fs.Path(f._stage_path)
            path.getFileSystem(conf).delete(path, True)
            self.live = [x for x in self.live if x is not f]

    def drop_since(self, mark: int, *keep: DataFrame) -> None:
        """Remove the tables written after ``self.n`` was ``mark``, but those
        that the result reads."""
        late = [f for f in self.live if int(f._stage_path.rsplit("/", 1)[1].split("-")[0]) > mark]
        self.drop(*[f for f in late if all(f is not k for k in keep)])


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files behind tables that are
    written: it does so when the JVM collects the frames that made them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: slots of a broadcast bitmap: 8 MB, whatever the input
SLOT_BITS = 26


def slot_bitmap(slots: DataFrame, slot_bits: int = SLOT_BITS) -> np.ndarray:
    """Bitmap of a ``slot`` column (0 to 2**slot_bits - 1). Spark builds it in
    pieces of 4 KB; the driver joins at most 2**slot_bits bits."""
    maps = (slots.groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")).toArrow())
    out = np.zeros((1 << slot_bits) // 8, dtype=np.uint8)
    # bit 0 of Spark's bucket b > 0 is slot (b - 1) * 32768 + 1; slot 0 alone is in bucket 0
    for bucket, bits in zip(maps["bucket"].to_pylist(), maps["bits"].to_pylist()):
        found = np.flatnonzero(np.unpackbits(np.frombuffer(bits, dtype=np.uint8), bitorder="little"))
        at = found + (bucket - 1) * 32768 + 1 if bucket else found * 0
        np.bitwise_or.at(out, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return out


def in_bitmap(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


class WordHashes(dict):
    """word bytes -> 64-bit hash, memoised up to a bound."""

    BOUND = 400_000

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        h = self[w] = xxhash.xxh3_64_intdigest(w)
        return h


_HASHES = WordHashes()


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_LOWER)


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


_P = 0x9E3779B97F4A7C15


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(h: np.ndarray, n: int, base: int = _P) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries of ``h`` (empty when
    there are fewer): polynomial hashes joined by doubling, then mixed."""
    if n < 1 or len(h) < n:
        return np.empty(0, dtype=np.uint64)
    out, length, power, cur = None, 0, 1, h
    mask = (1 << 64) - 1
    power_base, bits = base | 1, n
    p = power_base
    while bits:
        if bits & 1:
            if out is None:
                out, length = cur, power
            else:  # (cur of `power` entries) followed by (out of `length`)
                m = len(h) - (length + power) + 1
                mult = np.uint64(pow(power_base, length, mask + 1))
                out = cur[:m] * mult + out[power:power + m]
                length += power
        bits >>= 1
        if bits:
            m = len(cur) - power
            cur = cur[:m] * np.uint64(p) + cur[power:power + m]
            p = (p * p) & mask
            power *= 2
    return mix64(out)


def by_key(batches, column: int):
    """(key, rows) of runs of equal keys in Arrow batches that are sorted by
    that column; a run may cross batches."""
    key, rows = None, []
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for row in zip(*cols):
            if rows and row[column] != key:
                yield key, rows
                rows = []
            key = row[column]
            rows.append(row)
    if rows:
        yield key, rows


def binary_text(col) -> F.Column:
    """UTF-8 bytes of a text column (Arrow then hands over bytes, not str)."""
    return (F.col(col) if isinstance(col, str) else col).cast("binary")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every id has one smaller neighbour at most and those with one
    are no one's smaller neighbour: then the neighbour is the component."""
    ends = edges.select(F.col("u").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("k").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1")
    return odd.isEmpty()


def connected_components(edges: DataFrame, stages: Stages) -> DataFrame:
    """(u, v) links between long ids -> (node, component): the smallest id
    reachable, for every id in a link.

    Alternating large-star / small-star steps: each is a min-aggregation
    (map-side partial, so a hub node is no hot task) and a join AQE can
    split; every round is written to the shared folder, which cuts lineage.
    Rounds grow with the logarithm of the longest path.
    """
    cur = stages.write(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                       .distinct(), "cc-edges")
    while not _are_stars(cur):
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select("k", F.least("k", "m").alias("m"))
        large = (both.join(low, F.col("u") == F.col("k")).where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low2 = large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        small = large.join(low2, F.col("u") == F.col("k"))
        nxt = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(low2.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct())
        nxt = stages.write(nxt, "cc-edges")
        stages.drop(cur)
        cur = nxt
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
