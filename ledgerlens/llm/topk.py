"""Exact top-k inner-product search by Fagin's threshold algorithm.

Candidates are cut into blocks; a block holds its vectors and, per dimension,
the list of its rows sorted by that component. Queries are cut into groups.
Every pair of a query group and a block is one cell, one row on each side of
a join by the cell's number, so that a task holds one block and one group
whatever the table's size, and a lost executor costs its cells only.

In a cell, a query reads each list from the end that its component's sign
favours. Rows met in any list are scored at once (random access). No row that
all lists place beyond depth ``t`` can score more than
``bound(t) = sum_i q_i * (component i at depth t of list i)``, and the query
stops at the first depth whose bound is below its k-th score so far; an equal
bound does not stop it, so ties are all met. The bounds of all depths on a
geometric grid come from the lists alone: after a first shallow read, which
gives a k-th score, the depth to read is known, and where the lists would be
read nearly to their ends, all rows of the block are scored in one product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Stages
from ledgerlens.llm.vectors import integer_vectors

#: rows of a block or query group, at most
BLOCK_ROWS = 8192
#: bytes of the vectors of a block or query group, at most (wide vectors make shorter blocks)
BLOCK_BYTES = 4 << 20
#: queries scored together in a cell
CHUNK = 64
#: entries read from every list before the depth to read is decided
FIRST_DEPTH = 4
#: components beyond this count as this: 64 products of two still fit a long
BOUND = 1 << 28

_NONE = np.iinfo(np.int64).min


def _matrix(rows: list[bytes]) -> np.ndarray:
    """Vectors as rows of one matrix, shorter ones filled with zeros."""
    width = max((len(r) for r in rows), default=0) // 4
    out = np.zeros((len(rows), width), dtype=np.int32)
    for i, r in enumerate(rows):
        out[i, :len(r) // 4] = np.frombuffer(r, dtype="<i4")
    return out


class Block:
    """Vectors in the order of tie-breaking, with a sorted list per dimension."""

    def __init__(self, vectors: np.ndarray, lists: np.ndarray):
        self.x = vectors.astype(np.float64)
        self.exact = vectors.astype(np.int64)
        self.lists = lists  # (dimensions, rows): row numbers by rising component
        n = len(vectors)
        grid = []
        depth = FIRST_DEPTH
        while depth * max(1, vectors.shape[1]) < n:
            grid.append(depth)
            depth *= 2
        self.grid = np.array(grid, dtype=np.int64)
        # component at each depth of the grid, from the upper and from the lower end
        if grid:
            dims = np.arange(vectors.shape[1])[:, None]
            self.high = self.x[lists[:, n - self.grid], dims]
            self.low = self.x[lists[:, self.grid - 1], dims]

    @staticmethod
    def sorted_lists(vectors: np.ndarray) -> np.ndarray:
        return np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32)

    def scores(self, q: np.ndarray, rows=None) -> np.ndarray:
        """Inner products; in floating point where that is exact."""
        safe = np.abs(q).sum(axis=1).max(initial=0) * np.abs(self.x).max(initial=0) < float(1 << 52)
        x = (self.x if safe else self.exact) if rows is None else (self.x if safe else self.exact)[rows]
        out = q.astype(x.dtype) @ x.T
        return out.astype(np.int64) if safe else out

    def met(self, q: np.ndarray, depth: int) -> np.ndarray:
        """Rows among the first ``depth`` of any list, read from the end that
        the sign of ``q`` favours (a dimension with 0 adds nothing to any score)."""
        up, down = self.lists[q > 0], self.lists[q < 0]
        return np.unique(np.concatenate([up[:, len(self.x) - depth:].ravel(), down[:, :depth].ravel()]))

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """``(query, row, score)`` of the k best rows of every query, without
        its ``own`` row (-1: not here), and the number of rows scored."""
        found, scored = [], 0
        rest = []  # queries that read their lists to the end, with what the first read proved
        for i, q in enumerate(queries):
            kth, depth = _NONE, None
            if len(self.grid):
                rows = self.met(q, FIRST_DEPTH)
                rows = rows[rows != own[i]]
                s = self.scores(q[None, :], rows)[0]
                scored += len(rows)
                if len(s) >= k:
                    kth = np.partition(s, len(s) - k)[len(s) - k]
                    qf = q.astype(np.float64)
                    bound = np.where(qf > 0, qf, 0) @ self.high + np.where(qf < 0, qf, 0) @ self.low
                    # the relative margin covers the rounding of the bound's sum
                    enough = np.flatnonzero(bound + 1e-9 * np.abs(bound) + 1e-9 < kth)
                    if len(enough):
                        depth = int(self.grid[enough[0]])
            if depth is None:
                rest.append((i, kth))
                continue
            if depth > FIRST_DEPTH:
                rows = self.met(q, depth)
                rows = rows[rows != own[i]]
                s = self.scores(q[None, :], rows)[0]
                scored += len(rows)
            best = np.lexsort((rows, -s))[:k]
            found.append((np.full(len(best), i), rows[best], s[best]))
        for at in range(0, len(rest), CHUNK):
            part = rest[at:at + CHUNK]
            number = np.array([i for i, _ in part])
            kth = np.array([t for _, t in part], dtype=np.int64)
            s = self.scores(queries[number])
            scored += s.size
            here = np.flatnonzero(own[number] >= 0)
            s[here, own[number][here]] = _NONE
            r, c = np.nonzero((s >= kth[:, None]) & (s != _NONE))
            v = s[r, c]
            order = np.lexsort((c, -v, r))
            r, c, v = r[order], c[order], v[order]
            first = np.searchsorted(r, r, side="left")
            best = np.arange(len(r)) - first < k
            found.append((number[r[best]], c[best], v[best]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), scored
        return (*(np.concatenate([f[j] for f in found]).astype(np.int64) for j in range(3)), scored)


def _packed(df: DataFrame, n: int, with_lists: bool) -> DataFrame:
    """``df`` (rid, vec_id, v) in ``n`` rows, one per partition: row and vector
    ids, the matrix and, for blocks, the sorted lists."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, ids, rows = [], [], []
        for b in batches:
            rid += b.column(0).to_pylist()
            ids += b.column(1).to_pylist()
            rows += b.column(2).to_pylist()
        if not rows:
            return
        order = sorted(range(len(rows)), key=lambda i: (ids[i] is None, ids[i] or 0, rid[i]))
        matrix = _matrix([rows[i] for i in order])
        yield pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId()], pa.int32()),
            pa.array([[rid[i] for i in order]], pa.list_(pa.int64())),
            pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
            pa.array([matrix.shape[1]], pa.int32()), pa.array([matrix.tobytes()], pa.binary()),
            pa.array([Block.sorted_lists(matrix).tobytes() if with_lists else b""], pa.binary())],
            ["part", "rid", "ids", "width", "matrix", "lists"])

    return df.repartition(n).mapInArrow(pack, "part int, rid array<long>, ids array<long>, width int, matrix binary, lists binary")


def _search_cells(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for cell in b.to_pylist():
            c, q = cell["c"], cell["q"]
            width = min(c["width"], q["width"])  # components that one side lacks are zeros there
            x = np.frombuffer(c["matrix"], dtype=np.int32).reshape(len(c["rid"]), -1)[:, :width]
            lists = np.frombuffer(c["lists"], dtype=np.int32).reshape(-1, len(c["rid"]))[:width]
            queries = np.frombuffer(q["matrix"], dtype=np.int32).reshape(len(q["rid"]), -1)[:, :width].astype(np.int64)
            at = {r: i for i, r in enumerate(c["rid"])}
            own = np.array([at.get(r, -1) for r in q["rid"]], dtype=np.int64)
            i, j, s, _ = Block(x, lists).search(queries, own, k)
            yield pa.RecordBatch.from_arrays([
                pa.array([q["rid"][n] for n in i], pa.int64()), pa.array([q["ids"][n] for n in i], pa.int64()),
                pa.array([c["ids"][n] for n in j], pa.int64()), pa.array([c["rid"][n] for n in j], pa.int64()),
                pa.array(s, pa.int64())], ["query_rid", "query_id", "vec_id", "rid", "score"])


def top_k(vectors: DataFrame, stages: Stages, is_query: Column, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row that ``is_query`` (an
    expression over ``vec_id``, the id as long) selects, the ``k`` rows of
    highest inner product among all rows but itself (all rows, if fewer).

    Components are ``floor(scale * x)``; ones beyond 2**28 count as 2**28.
    Ties go to the smaller id, null ids last, then to the earlier row.
    Vectors that are null or hold null or non-finite components take no part;
    of vectors of unequal length the shorter counts as filled with zeros (an
    empty one scores 0 with every other). A repeated id is several rows: each
    is a query of its own and a candidate for the others. A row with a null
    id is a candidate, and a query only if ``is_query`` is true of null. An
    empty table gives no rows. Ids must be integers.
    """
    rows = stages.write(integer_vectors(vectors, id_col, vec_col, scale, BOUND)
                        .withColumn("rid", F.monotonically_increasing_id()), "vectors").select("rid", "vec_id", "v")
    asked = rows.where(is_query)
    sizes = rows.agg(F.count("rid"), F.count(F.when(is_query, 1)), F.max(F.length("v"))).first()
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(sizes[2] or 0, 1)))
    n_blocks, n_groups = (max(1, math.ceil(n / most)) for n in sizes[:2])
    blocks = stages.write(_packed(rows, n_blocks, True), "blocks")
    groups = stages.write(_packed(asked, n_groups, False), "groups")
    cells = n_blocks * n_groups
    number = (F.col("block").cast("long") * n_groups + F.col("grp")).alias("cell")

    def dealt(side: DataFrame, own: str, other: str, n_other: int, name: str) -> DataFrame:
        return (side.select(F.col("part").alias(own), F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
                            F.struct("rid", "ids", "width", "matrix", "lists").alias(name))
                .select(number, name).repartition(min(4 * cells, 100_000), "cell"))  # spare partitions keep cells apart

    found = (dealt(blocks, "block", "grp", n_groups, "c").join(dealt(groups, "grp", "block", n_blocks, "q"), "cell")
             .select("c", "q").mapInArrow(lambda batches: _search_cells(batches, k),
                                          "query_rid long, query_id long, vec_id long, rid long, score long"))
    best = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
