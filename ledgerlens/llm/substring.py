"""Removal of repeated word spans by De Bruijn compaction.

Every run of ``k`` consecutive words (a window) is an edge of the corpus'
word-level De Bruijn graph; an edge walked from two places is repeated.

1. Every window is represented by its *minimizer*, the smallest hash among
   the short word runs inside it. Equal windows have equal minimizers, so a
   window whose minimizer occurs once in the corpus is unique. Occurrences
   are counted over the whole corpus into slots of a bitmap of fixed size
   (a slot shared by chance only lets a few more windows through; when a
   corpus fills the bitmap, all windows pass and the result is the same).
2. Consecutive windows with one minimizer are a locally compacted path. A
   path equal to one of the documents before it in the task's batch refers
   to that one at once. The others are shuffled by minimizer; sorted runs of equal paths refer to the
   first one, and only paths that share a minimizer with a different path
   are taken apart into windows, which one more shuffle by window compares.
   Windows of a minimizer with ``HOT`` places or more skip the shuffle by
   minimizer: a common passage is reduced per batch, then dealt by window.
3. Each reference carries its *source coordinates*, the first place found.
   Per document, references whose source coordinates advance together are a
   nonbranching path and are compacted to one span.
4. A span is verified: a 128-bit digest of its words and of the words at its
   source coordinates, each read from the document itself, must be equal
   (a join of the two digests). Only then both places are removed. What
   hashes alone put together (80 bits for a window, 104 for a path) stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (
    Stages, binary_text, free_shuffles, hash_words, in_bitmap, mix64, ready, slot_bitmap, window_hashes)

#: slots of the minimizer bitmap: 16 MB when broadcast, whatever the input
SLOT_BITS = 27
#: words of the runs among which a window's minimizer is chosen
SHORT = 8
_POS_BITS = 24
#: bytes kept of a window's hash beside its 40-bit minimizer
_KEPT = 5
#: places of a slot from which its paths are dealt by window
HOT = 1 << 17
#: bytes of windows among which a task finds repeats by itself
REDUCED = 4 << 20
#: kinds of rows: a path, a reference to its source, a single window
_PATH, _REFERENCE, _WINDOW = 0, 1, 2
#: stands for a null id inside the spans
NO_ID = -(1 << 63)


def _slide_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries."""
    m, span = a, 1
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = width - span
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def minimizers(h: np.ndarray, k: int) -> np.ndarray:
    """For every window of ``k`` words: minimizer hash and place, packed."""
    short = min(SHORT, k)
    runs = window_hashes(h, short)
    place = np.arange(len(runs), dtype=np.uint64) & np.uint64((1 << _POS_BITS) - 1)
    packed = (runs >> np.uint64(_POS_BITS) << np.uint64(_POS_BITS)) | place
    return _slide_min(packed, k - short + 1)


def _slot(packed: np.ndarray) -> np.ndarray:
    return (packed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def repeated_slots(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmap of the slots that two or more minimizer places fall into, and
    the slots with ``HOT`` places or more."""
    def places(batches):
        for b in batches:
            found = []
            for t in b.column(0).to_pylist():
                words = t.split() if t else []
                if len(words) >= k:
                    m = minimizers(hash_words(words), k)
                    found.append(_slot(m[np.flatnonzero(np.diff(m, prepend=~m[:1]))]))
            if found:
                slots, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(n)], ["slot", "n"])

    twice = (texts.select("text").mapInArrow(places, "slot long, n long")
             .groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1"))
    size = 1 << SLOT_BITS  # hot slots are in a second bitmap behind the first
    slots = twice.select(F.explode(F.when(F.col("n") >= HOT, F.array("slot", F.col("slot") + size))
                                   .otherwise(F.array("slot"))).alias("slot"))
    both = slot_bitmap(slots, SLOT_BITS + 1)
    hot = both[size // 8:]
    bytes_ = np.flatnonzero(hot)
    bits = np.unpackbits(hot[bytes_], bitorder="little").reshape(-1, 8)
    row, bit = np.nonzero(bits)
    return both[:size // 8].copy(), bytes_[row] * 8 + bit


def _paths(h: np.ndarray, k: int, bitmap: np.ndarray):
    """The locally compacted paths of one document that may repeat: minimizer,
    digest, start, number of windows, and the kept bytes of their windows."""
    packed = minimizers(h, k)
    start = np.flatnonzero(np.diff(packed, prepend=~packed[:1]))
    slot = _slot(packed[start])
    pick = in_bitmap(bitmap, slot)
    if not pick.any():
        return None
    count = np.diff(np.append(start, len(packed)))
    w = window_hashes(h, k)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w)])
    flagged = np.repeat(pick, count)
    start, count = start[pick], count[pick]
    digest = mix64((total[start + count] - total[start]) + w[start] * np.uint64(0x9E3779B97F4A7C15)
                   + w[start + count - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + count.astype(np.uint64))
    body = np.ascontiguousarray(w[flagged].view(np.uint8).reshape(-1, 8)[:, :_KEPT])
    return ((packed[start] >> np.uint64(_POS_BITS)).view(np.int64), digest.view(np.int64),
            start.astype(np.int32), count.astype(np.int32), body)


def _window_keys(raw: np.ndarray) -> np.ndarray:
    w = np.zeros((len(raw), 8), dtype=np.uint8)
    w[:, :_KEPT] = raw
    return w.view(np.int64)[:, 0]


_ROWS = "kind byte, m long, w long, doc_id long, th long, pos int, windows int, s_doc long, s_th long, s_pos int"
_TYPES = (np.int8, np.int64, np.int64, np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, np.int32)
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]


def _rows(kind, m, w, doc, th, pos, windows, s_doc, s_th, s_pos, body=None) -> pa.RecordBatch:
    n = len(pos)
    columns = [pa.array(np.broadcast_to(np.asarray(x), n).astype(t))
               for x, t in zip((kind, m, w, doc, th, pos, windows, s_doc, s_th, s_pos), _TYPES)]
    if body is None:
        return pa.RecordBatch.from_arrays(columns, _NAMES)
    return pa.RecordBatch.from_arrays([*columns, body], [*_NAMES, "body"])


def _no_bodies(n: int) -> pa.Array:
    return pa.nulls(n, pa.binary())


def _first_equal(m: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Of every entry the first one with equal ``m`` and ``key`` (itself, if
    it is the first, or if another ``m`` has the first equal key)."""
    _, first, back = np.unique(key, return_index=True, return_inverse=True)
    at = first[back]
    return np.where(m[at] == m, at, np.arange(len(m)))


def _batch_rows(found: list[tuple], hot_slots: np.ndarray):
    """Rows of some documents, each ``(doc, th, m, digest, start, count,
    body)``: paths, windows of hot paths, and references of those that
    occurred before among these documents."""
    sizes = [len(f[2]) for f in found]
    doc, th = (np.repeat(np.array([f[j] for f in found], dtype=np.int64), sizes) for j in (0, 1))
    m, digest, start, count, body = (np.concatenate([f[j] for f in found]) for j in range(2, 7))
    hot = np.isin(m >> (64 - SLOT_BITS - _POS_BITS), hot_slots)
    src = _first_equal(m, digest)
    again = src != np.arange(len(m))
    if again.any():
        yield _references(doc[again], th[again], start[again], count[again], doc[src[again]], th[src[again]], start[src[again]], True)
    fresh = ~again & ~hot
    if fresh.any():
        raw = body[np.repeat(fresh, count)]
        offsets = np.concatenate([[0], np.cumsum(count[fresh] * _KEPT)]).astype(np.int32)
        bodies = pa.Array.from_buffers(pa.binary(), int(fresh.sum()), [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])
        yield _rows(_PATH, m[fresh], digest[fresh], doc[fresh], th[fresh], start[fresh], count[fresh], 0, 0, 0, bodies)
    apart = ~again & hot
    if apart.any():
        n = count[apart]
        at = np.repeat(np.flatnonzero(apart), n)
        pos = start[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        w, mw, d, t = _window_keys(body[np.repeat(apart, count)]), m[at], doc[at], th[at]
        src = _first_equal(mw, w)
        again = src != np.arange(len(w))
        if again.any():
            yield _references(d[again], t[again], pos[again], 1, d[src[again]], t[src[again]], pos[src[again]], True)
        new = ~again
        yield _rows(_WINDOW, mw[new], w[new], d[new], t[new], pos[new], 0, 0, 0, 0, _no_bodies(int(new.sum())))


def _columns(b: pa.RecordBatch):
    return [c.to_numpy(zero_copy_only=False) for c in b.columns[:len(_NAMES)]]


def _references(doc, th, pos, windows, s_doc, s_th, s_pos, with_body: bool = False) -> pa.RecordBatch:
    return _rows(_REFERENCE, np.asarray(th) ^ np.asarray(doc), 0, doc, th, pos, windows, s_doc, s_th, s_pos,
                 _no_bodies(len(doc)) if with_body else None)


def _windows(b: pa.RecordBatch) -> pa.RecordBatch:
    """The single windows of paths."""
    _, m, _, doc, th, start, count, *_ = _columns(b)
    w = _window_keys(np.frombuffer(b"".join(b.column(len(_NAMES)).to_pylist()), dtype=np.uint8).reshape(-1, _KEPT))
    at = np.repeat(np.arange(len(m)), count)
    step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    return _rows(_WINDOW, m[at], w, doc[at], th[at], start[at] + step, 0, 0, 0, 0)


def _settle(batches):
    """Rows by minimizer, sorted: a path equal to the one before it refers to
    the first of its run; paths that differ under one minimizer are taken
    apart, with an example of each repeated one among them. References and
    single windows go on as they are."""
    held = src = None
    went = False  # the held path equals one before it
    under = False  # a different path under its minimizer went before
    for b in batches:
        others = pa.compute.not_equal(b.column(0), pa.scalar(_PATH, pa.int8()))
        passed = b.filter(others)
        if passed.num_rows:
            yield pa.RecordBatch.from_arrays(passed.columns[:len(_NAMES)], _NAMES)
        b = b.filter(pa.compute.invert(others))
        if held is not None:
            b = pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(held.columns, b.columns)], schema=b.schema)
        if b.num_rows == 0:
            continue
        _, m, digest, doc, th, start, count, *_ = _columns(b)
        same_m = np.zeros(len(m) + 1, dtype=bool)
        same = np.zeros(len(m) + 1, dtype=bool)
        same_m[1:-1] = m[1:] == m[:-1]
        same[1:-1] = same_m[1:-1] & (digest[1:] == digest[:-1])
        same_m[0], same[0] = went or under, went
        first = np.maximum.accumulate(np.where(same[:-1], 0, np.arange(len(m))))
        s_doc, s_th, s_pos = doc[first], th[first], start[first]
        if went:
            own = first == 0
            s_doc[own], s_th[own], s_pos[own] = src
        last = len(m) - 1
        again = same[:-1].copy()
        apart = (same_m[:-1] & ~same[:-1]) | (same_m[1:] & ~same[1:])
        again[last] = apart[last] = False  # judged with the rows that follow
        if again.any():
            yield _references(doc[again], th[again], start[again], count[again], s_doc[again], s_th[again], s_pos[again])
        if apart.any():
            yield _windows(b.filter(pa.array(apart)))
        held, src = b.slice(last), (s_doc[last], s_th[last], s_pos[last])
        went, under = bool(same[last]), bool(same_m[last] and not same[last])
    if held is not None:
        if went:
            _, _, _, doc, th, start, count, *_ = _columns(held)
            yield _references(doc, th, start, count, *(np.array([x]) for x in src))
        elif under:
            yield _windows(held)


def _repeated(batches):
    """Rows by window, sorted: a window equal to the one before it refers to
    the first of its run."""
    before = src = None
    for b in batches:
        if not b.num_rows:
            continue
        kind, m, w, doc, th, pos, windows, s_doc, s_th, s_pos = (c.copy() for c in _columns(b))
        window = kind == _WINDOW
        same = np.zeros(len(m), dtype=bool)
        same[1:] = window[1:] & window[:-1] & (m[1:] == m[:-1]) & (w[1:] == w[:-1])
        same[0] = bool(window[0]) and before == (m[0], w[0])
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(m))))
        own = same & (first == 0) if same[0] else np.zeros(len(m), dtype=bool)
        s_doc[same], s_th[same], s_pos[same] = doc[first[same]], th[first[same]], pos[first[same]]
        if own.any():
            s_doc[own], s_th[own], s_pos[own] = src
        windows[same] = 1
        out = same | ~window
        if out.any():
            yield _span_batch(doc[out], th[out], pos[out], windows[out], s_doc[out], s_th[out], s_pos[out])
        if window[-1]:
            src = (s_doc[-1], s_th[-1], s_pos[-1]) if same[-1] else (doc[-1], th[-1], pos[-1])
            before = (m[-1], w[-1])
        else:
            before = None


_SPAN = "doc_id long, th long, pos int, windows int, s_doc long, s_th long, s_pos int"


def _span_batch(*columns) -> pa.RecordBatch:
    kinds = (np.int64, np.int64, np.int32, np.int32, np.int64, np.int64, np.int32)
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x).astype(t)) for x, t in zip(columns, kinds)],
                                      ["doc_id", "th", "pos", "windows", "s_doc", "s_th", "s_pos"])


def repeated_spans(texts: DataFrame, k: int) -> DataFrame:
    """``doc_id, th, start, words, src_doc, src_th, src_start`` of the
    compacted repeated paths by their hashes, each source as a span of its
    own; ``texts`` has ``doc_id, th, text`` (``NO_ID`` for a null id)."""
    found = linked_spans(texts, k)
    sources = found.select("src_doc", "src_th", "src_start", "words").distinct()
    return found.union(sources.select("src_doc", "src_th", "src_start", "words", "src_doc", "src_th", "src_start"))


def linked_spans(texts: DataFrame, k: int) -> DataFrame:
    """The spans of ``repeated_spans`` that lie at another place than their source."""
    bits, hot = repeated_slots(texts, k)
    bitmap = texts.sparkSession.sparkContext.broadcast((bits, hot))

    def paths(batches):
        bits, hot = bitmap.value
        found, size = [], 0
        for b in batches:
            for doc, th, t in zip(*(c.to_pylist() for c in b.columns)):
                words = t.split() if t else []
                own = _paths(hash_words(words), k, bits) if len(words) >= k else None
                if own is not None:
                    found.append((doc, th, *own))
                    size += own[4].size
                    if size > REDUCED:
                        yield from _batch_rows(found, hot)
                        found, size = [], 0
        if found:
            yield from _batch_rows(found, hot)

    def compact(batches):
        for b in batches:
            doc, th, pos, count, s_doc, s_th, s_pos = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            if not len(doc):
                continue
            new = np.ones(len(doc), dtype=bool)  # a path starts here
            new[1:] = ~((doc[1:] == doc[:-1]) & (th[1:] == th[:-1]) & (pos[1:] == pos[:-1] + count[:-1])
                        & (s_doc[1:] == s_doc[:-1]) & (s_th[1:] == s_th[:-1]) & (s_pos[1:] == s_pos[:-1] + count[:-1]))
            at = np.flatnonzero(new)
            end = np.append(at[1:], len(doc)) - 1
            words = (pos[end] + count[end] - pos[at] + k - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[at], th[at], pos[at], words, s_doc[at], s_th[at], s_pos[at])],
                                             ["doc_id", "th", "start", "words", "src_doc", "src_th", "src_start"])

    # references are spread by their document (m), windows of hot minimizers by their hash (w)
    found = (texts.mapInArrow(paths, _ROWS + ", body binary")
             .repartition(F.when(F.col("kind") == _WINDOW, F.col("w")).otherwise(F.col("m"))).sortWithinPartitions("kind", "m", "w", "doc_id", "th", "pos")
             .mapInArrow(_settle, _ROWS)
             .repartition("m", "w").sortWithinPartitions("kind", "m", "w", "doc_id", "th", "pos")
             .mapInArrow(_repeated, _SPAN))
    return (found.repartition("doc_id", "th").sortWithinPartitions("doc_id", "th", "s_doc", "s_th", "pos", "windows")
            .mapInArrow(compact, "doc_id long, th long, start int, words int, src_doc long, src_th long, src_start int"))


_CUT = "doc_id long, th long, n_words long, n_removed long, kept_text string, start int, words int, digest binary"


def _cut(batches):
    """Sorted rows of texts (start -1), each followed by the spans asked of
    it: a digest row per span, and the text without the spans once for every
    equal row."""
    types = [pa.int64()] * 4 + [pa.string(), pa.int32(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in _CUT.split(", ")]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def kept(key, texts):
        for words, edge, copies in texts:
            if edge is None:
                row = (*key, len(words), 0, b" ".join(words).decode(), None, None, None)
            else:
                keep = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
                row = (*key, len(words), len(words) - len(keep), b" ".join([words[i] for i in keep]).decode(), None, None, None)
            for _ in range(copies):
                yield row

    key, texts, rows, size = None, [], [], 0  # texts: of one key, different ones only where their hashes clash
    for b in batches:
        for doc, th, start, n, text in zip(*(c.to_pylist() for c in b.columns)):
            if (doc, th) != key:
                for row in kept(key, texts):
                    rows.append(row)
                    size += len(row[4]) + 64
                    if size > 1 << 22:
                        yield batch(rows)
                        rows, size = [], 0
                key, texts, last = (doc, th), [], None
            if start < 0:
                if texts and last == text:
                    texts[-1][2] += 1
                else:
                    texts.append([text.split() if text else [], None, 1])
                    last = text
                continue
            for t in texts:
                words = t[0]
                digest = hashlib.blake2b(b" ".join(words[start:start + n]), digest_size=16).digest()
                rows.append((doc, th, None, None, None, start, n, digest))
                size += 100
                if start + n <= len(words):
                    if t[1] is None:
                        t[1] = np.zeros(len(words) + 1, dtype=np.int32)
                    t[1][start] += 1
                    t[1][start + n] -= 1
        if size > 1 << 22:
            yield batch(rows)
            rows, size = [], 0
    rows += kept(key, texts)
    if rows:
        yield batch(rows)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 35,
                   stages: Stages | None = None) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``: every input row with the
    words outside all repeated ``k``-word windows, joined by one space.

    Words are runs without ASCII white space, compared unchanged; windows are
    judged on the input. A window repeats when its word sequence starts at
    another place of any document, the same one included. Rows that repeat
    (same id and text) are places of their own, so their windows go. Null,
    blank and short texts lose nothing (null: no words, empty kept text);
    a null id is allowed, and rows of one id (or of null) are told apart by a
    64-bit hash of their texts; spans that such a clash would mix up fail the
    comparison of their words and stay. Ids must be integers. Other columns
    are ignored.
    """
    ready(docs.sparkSession)
    stages = stages or Stages(docs.sparkSession, "substring")
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                        F.xxhash64(text_col).alias("th"), binary_text(text_col).alias("text"))
    spans = stages.write(linked_spans(texts, k), "spans")
    free_shuffles(docs.sparkSession)
    own, source = ["doc_id", "th", "start", "words"], ["src_doc", "src_th", "src_start", "words"]
    while True:
        asked = spans.select(own).union(spans.select(source)).distinct()
        rows = (texts.select("doc_id", "th", F.lit(-1).alias("start"), F.lit(0).alias("words"), "text")
                .unionByName(asked.withColumn("text", F.lit(None).cast("binary"))))
        cut = stages.write(rows.repartition("doc_id", "th").sortWithinPartitions("doc_id", "th", "start", "words", "text")
                           .mapInArrow(_cut, _CUT), "cut", compression="zstd")
        digests = cut.where("digest is not null").select(*own, "digest")
        place = digests.select(*[F.col(a).alias(b) for a, b in zip(own, source)], F.col("digest").alias("src_digest"))
        unlike = spans.join(digests, own).join(place, source).where("digest <> src_digest").select(spans.columns).distinct()
        if unlike.isEmpty():
            break
        right = stages.write(spans.join(unlike, spans.columns, "left_anti"), "spans")
        stages.drop(cut)
        spans = right
    stages.drop(spans)
    return cut.where("digest is null").select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept_text")
