"""Sharding by minimax contiguous partition, in DataFrame operations only.

Rows are grouped into atomic units in a fixed order: the unit of a row is
the upper half of its text's CRC-32, so equal texts are always in one unit
and there are at most ``UNITS`` = 65,536 units whatever the input. Their
sizes (65,536 numbers at most) go to the driver, where a binary search finds
the smallest capacity for which greedy cutting needs no more than the given
shards. The units are cut there, within that capacity and as near to equal
sizes as it allows. Slots come from counts: units before the row's unit,
then row chunks before its chunk, then its place in the chunk, so neither a
shard nor a unit is sorted in one task.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Stages

UNITS = 1 << 16
#: rows of a unit that are numbered by one task, about
CHUNK_ROWS = 50_000


def _shards_needed(prefix: list[int], start: int, capacity: int, most: int) -> int:
    """Greedy number of shards of at most ``capacity`` for the units from
    ``start`` on; ``most + 1`` if more are needed."""
    n, last = 0, len(prefix) - 1
    while start < last:
        if n == most:
            return most + 1
        end = bisect_right(prefix, prefix[start] + capacity) - 1
        if end == start:
            return most + 1
        start, n = end, n + 1
    return n


def minimax_cuts(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """The smallest capacity, and the first unit of each shard (``shards``
    numbers, non-decreasing; a shard may be empty)."""
    prefix = [0]
    for s in sizes:
        prefix.append(prefix[-1] + s)
    low, high = max(sizes, default=0), prefix[-1]
    while low < high:
        mid = (low + high) // 2
        if _shards_needed(prefix, 0, mid, shards) <= shards:
            high = mid
        else:
            low = mid + 1
    cuts, start, last = [], 0, len(sizes)
    for left in range(shards, 0, -1):
        cuts.append(start)
        if start == last:
            continue
        most = bisect_right(prefix, prefix[start] + low) - 1
        even = prefix[start] + (prefix[-1] - prefix[start]) / left
        end = min(most, max(start + 1, bisect_right(prefix, even) - 1))
        if end < most and prefix[end + 1] - even < even - prefix[end]:
            end += 1
        if left == 1:
            end = last
        # what is left must fit the shards that are left
        while end < most and _shards_needed(prefix, end, low, left - 1) > left - 1:
            end += 1
        start = end
    return low, cuts


def shard(docs: DataFrame, stages: Stages, id_col: str = "doc_id", text_col: str = "text", shards: int = 40,
          keep: list[str] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, or the
    columns ``keep`` of ``docs`` with ``shard, slot``, one row per input row.

    ``size`` is the text's UTF-8 bytes (null: none) plus 16; the law is
    ``bytes``: shard sizes are as near equal as whole groups of equal texts
    allow. ``slot`` counts a shard's rows from 0 without a gap. A null text
    counts as empty. Ids may be null or repeat: ties of equal rows are
    numbered in any order. An empty table gives an empty result.
    """
    keep = keep or []
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 16
    crc = F.coalesce(F.crc32(F.col(text_col).cast("binary")), F.lit(0)).cast("long")
    rows = docs.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col(id_col).alias("doc_id"), size.alias("size"),
                       crc.alias("text_crc32")).withColumn("unit", F.shiftright("text_crc32", 16).cast("int"))
    if not keep:
        rows = stages.write(rows, "rows")
    units = rows.groupBy("unit").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    units.sort(key=lambda r: r["unit"])
    _, cuts = minimax_cuts([r["bytes"] for r in units], shards)
    place, at, base = {}, 0, 0
    for i, r in enumerate(units):
        while at + 1 < shards and cuts[at + 1] <= i:
            at, base = at + 1, 0
        place[r["unit"]] = (at, base, max(1, -(-r["n"] // CHUNK_ROWS)))
        base += r["n"]
    plan = docs.sparkSession.createDataFrame([(u, *p) for u, p in place.items()],
                                             "unit int, shard int, base long, chunks int")
    rows = rows.join(F.broadcast(plan), "unit")  # at most UNITS rows
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("chunks")).cast("int"))
    chunks = rows.groupBy("unit", "chunk").agg(F.count("*").alias("n"))
    chunks = chunks.select("unit", "chunk", F.coalesce(
        F.sum("n").over(Window.partitionBy("unit").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("ahead"))
    number = F.row_number().over(Window.partitionBy("unit", "chunk").orderBy("doc_id", "text_crc32", "size")) - 1
    return rows.withColumn("number", number).join(chunks, ["unit", "chunk"]).select(
        *([F.col(f"k_{c}").alias(c) for c in keep] or ["doc_id", "size", "text_crc32", F.lit("bytes").alias("law")]),
        "shard", (F.col("base") + F.col("ahead") + F.col("number")).cast("long").alias("slot"),
        *([] if keep else [F.lit(None).cast("int").alias("grown_shard")]))
