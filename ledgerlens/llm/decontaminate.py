"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks.

For every benchmark item of ``m`` words, the windows of ``m`` consecutive
words of every document are compared with it:

1. A window at the wanted similarity shares a word shingle with its item, so
   only windows around a shared shingle are built (no loss: a similarity
   above 0 needs one).
2. Each such window gets a 64-bit SimHash of its shingles, weighted by how
   often they occur, from running sums over the document.
3. Fingerprints of equal-length items are split into 8 blocks of 8 bits. Two
   fingerprints within ``RADIUS`` = 23 bits differ by at most 2 bits in some
   block, so looking every block up among the values within 2 bits finds all
   items within the radius (pigeonhole).
4. Each candidate is verified by the exact weighted Jaccard similarity of
   the two shingle multisets.

The benchmark is a stated query set: it is read in blocks of bounded size
(``BLOCK_BYTES``, so short items are bounded too), each block is broadcast and met by one scan
of the documents, which are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import binary_text, hash_words, ready, window_hashes

#: bytes of a block of items: their texts, and 64 more for each item
BLOCK_BYTES = 8 << 20
#: items whose fingerprints are compared with a stretch of windows at once
TILE = 1024
RADIUS = 23
_PUNCT = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
#: A-Z lower-cased, ASCII punctuation to space
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + _PUNCT, bytes(range(97, 123)) + b" " * len(_PUNCT))
_POP = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_NEAR = _POP[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= RADIUS // 8


def word_hashes(text: bytes | None) -> np.ndarray:
    return hash_words(text.translate(_PLAIN).split()) if text else np.empty(0, dtype=np.uint64)


def _signs(shingles: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as 8 bytes a row."""
    return np.packbits(sums > 0, axis=1)


class BenchmarkIndex:
    """Fingerprints and shingle multisets of one block of items, as flat
    arrays: about 32 bytes a shingle and 60 an item."""

    def __init__(self, items: list[tuple], n: int):
        self.n, self.ids, self.whole = n, [], defaultdict(list)
        by_length = defaultdict(list)
        values, counts, lengths, prints = [], [], [], []
        for item_id, text in items:
            h = word_hashes(text)
            if not len(h):
                continue
            if len(h) < n:  # no shingle: it leaks as a whole document only
                self.whole[h.tobytes()].append(item_id)
                continue
            s = window_hashes(h, n)
            v, c = np.unique(s, return_counts=True)
            by_length[len(h)].append(len(self.ids))
            self.ids.append(item_id)
            values.append(v)
            counts.append(c.astype(np.int32))
            lengths.append(len(h))
            prints.append(_pack(_signs(s).sum(axis=0)[None, :])[0])
        none = np.empty(0, dtype=np.uint64)
        self.values, self.counts = np.concatenate([none, *values]), np.concatenate([none.astype(np.int32), *counts])
        sizes = np.array([len(v) for v in values], dtype=np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.total = np.array(lengths, dtype=np.int64) - n + 1
        # of every length: its items and their fingerprints
        self.lengths = {m: (np.array(at), np.stack([prints[i] for i in at])) for m, at in by_length.items()}
        # shingle -> lengths of the items that hold it
        pairs = np.unique(np.stack([self.values, np.repeat(np.array(lengths, dtype=np.uint64), sizes)]), axis=1)
        self.seeds, start = np.unique(pairs[0], return_index=True)
        self.seed_start = np.append(start, pairs.shape[1]).astype(np.int64)
        self.seed_lengths = pairs[1].astype(np.int64)
        self.sieve = np.zeros(1 << 20, dtype=bool)
        self.sieve[(self.seeds >> np.uint64(44)).astype(np.int64)] = True

    def leaks(self, text: bytes | None, threshold: float):
        """``(item_id, similarity, start, words)`` of the best window of every
        item that the text contains."""
        h = word_hashes(text)
        if not len(h):
            return []
        if len(h) < self.n:
            return [(i, 1.0, 0, len(h)) for i in self.whole.get(h.tobytes(), ())]
        s = window_hashes(h, self.n)
        maybe = np.flatnonzero(self.sieve[(s >> np.uint64(44)).astype(np.int64)])
        if not len(maybe) or not len(self.seeds):
            return []
        found = np.searchsorted(self.seeds, s[maybe])
        found[found == len(self.seeds)] = 0
        real = self.seeds[found] == s[maybe]
        spans = defaultdict(list)
        for p, k in zip(maybe[real].tolist(), found[real].tolist()):
            for m in self.seed_lengths[self.seed_start[k]:self.seed_start[k + 1]].tolist():
                spans[m].append(p)
        best: dict[int, tuple] = {}
        for m, places in spans.items():
            self._windows(h, s, m, places, threshold, best)
        return [(self.ids[i], *v) for i, v in sorted(best.items())]

    def _windows(self, h, s, m, places, threshold, best):
        words = min(m, len(h))  # a shorter document is one window
        width = words - self.n + 1
        last = len(h) - words
        wanted = np.zeros(last + 2, dtype=np.int64)
        p = np.array(places)
        np.add.at(wanted, np.clip(p - width + 1, 0, last), 1)
        np.add.at(wanted, np.minimum(p, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(wanted[:-1]))
        if not len(starts):
            return
        members, prints = self.lengths[m]
        for cut in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
            for at in range(0, len(cut), 4096):  # running sums over bounded stretches
                part = cut[at:at + 4096]
                low = part[0]
                sums = np.zeros((part[-1] - low + width + 1, 64), dtype=np.int32)
                np.cumsum(_signs(s[low:part[-1] + width]), axis=0, out=sums[1:])
                fp = _pack(sums[part - low + width] - sums[part - low])
                for t in range(0, len(members), TILE):  # bounded numbers of items
                    tile = prints[t:t + TILE]
                    cand = np.zeros((len(part), len(tile)), dtype=bool)
                    for b in range(8):
                        cand |= _NEAR[fp[:, b]][:, tile[:, b]]
                    for w, i in zip(*np.nonzero(cand)):
                        if int(_POP[fp[w] ^ tile[i]].sum()) > RADIUS:
                            continue
                        item, start = int(members[t + i]), int(part[w])
                        sim = self._similarity(item, s[start:start + width])
                        if sim >= threshold and (item not in best or sim > best[item][0]):
                            best[item] = (sim, start, words)

    def _similarity(self, item: int, shingles: np.ndarray) -> float:
        here = slice(self.first[item], self.first[item + 1])
        values, counts, total = self.values[here], self.counts[here], int(self.total[item])
        own, n = np.unique(shingles, return_counts=True)
        at = np.searchsorted(values, own)
        at[at == len(values)] = 0
        shared = int(np.minimum(counts[at], n)[values[at] == own].sum())
        return shared / (total + len(shingles) - shared)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    block, size = [], 0
    for r in benchmark.select(F.col(item_col), binary_text(text_col)).toLocalIterator():
        text = bytes(r[1]) if r[1] is not None else b""
        block.append((r[0], text))
        size += len(text) + 64
        if size > BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", n: int = 5,
               threshold: float = 0.8) -> DataFrame:
    """``doc_id, item_id, similarity, start_word, n_words``: for every input
    row and benchmark item it contains, the most similar item-sized window
    (the first of equal ones).

    Words are compared with A-Z lower-cased and ASCII punctuation ignored. A
    document shorter than the item is one window. An item of fewer than ``n``
    words has no shingle and is found only as a whole document. Null or blank
    texts and items match nothing; null ids of documents and items are
    carried, and ids may be of any simple type; a repeated row gives
    its leaks again; other columns are ignored.
    """
    spark = docs.sparkSession
    ready(spark)
    kind = benchmark.schema[item_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), binary_text(text_col).alias("text"))
    doc_kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {kind}, similarity double, start_word long, n_words long"
    item_type = benchmark.select(item_col).limit(0).toArrow().schema.field(0).type
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, item_text_col):
        index = spark.sparkContext.broadcast(BenchmarkIndex(block, n))
        def scan(batches, index=index):
            for b in batches:
                at, rows = [], []
                for k, t in enumerate(b.column(1).to_pylist()):
                    for leak in index.value.leaks(t, threshold):
                        at.append(k)
                        rows.append(leak)
                if rows:
                    item, sim, start, words = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(at)), pa.array(item, item_type), pa.array(sim, pa.float64()),
                         pa.array(start, pa.int64()), pa.array(words, pa.int64())],
                        ["doc_id", "item_id", "similarity", "start_word", "n_words"])

        out = out.union(texts.mapInArrow(scan, schema))
    return out


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", n: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that hold no window as
    similar to a benchmark item (see ``find_leaks``; null texts stay)."""
    spark = docs.sparkSession
    ready(spark)
    for block in _blocks(benchmark, item_col, item_text_col):
        index = spark.sparkContext.broadcast(BenchmarkIndex(block, n))
        place = docs.columns.index(text_col)

        def keep(batches, index=index, place=place):
            for b in batches:
                clean = [not t or not index.value.leaks(t.encode(), threshold) for t in b.column(place).to_pylist()]
                yield b.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
