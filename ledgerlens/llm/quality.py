"""Quality rules by distribution divergence.

References are learned from the whole corpus: per language, the histogram of
character classes and the histogram of the most common words (ranked by the
number of their occurrences over all documents of the language). A document
is judged by the Jensen-Shannon distance of its own histograms to its
language's references, which need a minimum of words; short documents are not judged by a histogram they
cannot fill (minimum-length guards).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import hash_words, ready, window_hashes

#: character classes, in this order
CLASSES = ["lower", "upper", "digit", "space", "newline", "sentence", "symbol", "other_punct", "non_ascii_letter", "other"]
#: words of a language that its reference histogram names; all others are one more bin
COMMON_WORDS = 100
#: a histogram is compared only when the document has so many characters / words
MIN_CHARS, MIN_WORDS = 200, 50  # characters are counted as UTF-8 bytes
#: words behind a language's reference, at least
MIN_REFERENCE_WORDS = 5000
#: largest accepted Jensen-Shannon distances (0 to 1), above those of documents labelled good
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.35, 0.55
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"


def _byte_classes() -> np.ndarray:
    out = np.full(256, CLASSES.index("other"), dtype=np.int64)
    for i in range(128):
        c = chr(i)
        out[i] = CLASSES.index(
            "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else
            "newline" if c == "\n" else "space" if c.isspace() else "sentence" if c in ".,;:!?'\"()-" else
            "symbol" if c in "#*$%&|<>" else "other_punct" if 32 < i < 127 else "other")
    out[128:192] = -1  # continuation bytes are part of a character
    out[192:] = CLASSES.index("non_ascii_letter")
    return out


_CLASS = _byte_classes()


def char_histogram(text: bytes) -> np.ndarray:
    """Characters of each class; characters beyond ASCII count as letters."""
    by_byte = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    live = _CLASS >= 0
    return np.bincount(_CLASS[live], weights=by_byte[live], minlength=len(CLASSES))


def plain_word(word: bytes) -> bytes:
    return word.strip(b".,;:!?'\"()-").lower()


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two histograms; 0 if one is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, kl / 2)))


def base_metrics(text: bytes) -> tuple[int, int, int, int, int, list[bytes]]:
    """Words, code points in words, symbols, duplicate lines, words in
    repeated 5-word windows, and the words."""
    words = text.split()
    chars = sum(map(len, words)) - _continuation(b"".join(words))
    symbols = sum(text.count(SYMBOLS[i:i + 1]) for i in range(len(SYMBOLS)))
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        if line.strip(_SPACE):
            dup += line in seen
            seen.add(line)
    repeated = 0
    if len(words) > 5:
        w = window_hashes(hash_words(words), 5)
        order = np.sort(w)
        if (order[1:] == order[:-1]).any():
            twice = order[1:][order[1:] == order[:-1]]
            at = np.flatnonzero(np.isin(w, twice))
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + 5, -1)
            repeated = int((np.cumsum(edge[:-1]) > 0).sum())
    return len(words), chars, symbols, dup, repeated, words


def _continuation(data: bytes) -> int:
    a = np.frombuffer(data, dtype=np.uint8)
    return int(((a & 0xC0) == 0x80).sum())


def learn_references(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict:
    """language -> (character-class histogram, {common word: bin}, word
    histogram with the rest last), from all rows of languages with
    ``MIN_REFERENCE_WORDS`` words or more. Rows without a language make none."""
    def count(batches):
        chars: dict = {}
        words: dict = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                chars[lang] = chars.get(lang, 0) + char_histogram(text)
                seen = words.setdefault(lang, Counter())
                seen.update(text.split())
                if len(seen) > 300_000:
                    yield _counts(lang, seen)
                    seen.clear()
        for lang, seen in words.items():
            yield _counts(lang, seen)
        for lang, n in chars.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([b""] * len(n), pa.binary()),
                 pa.array(np.arange(len(n))), pa.array(n.astype(np.int64))], ["lang", "word", "bin", "n"])

    counts = (docs.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("text"))
              .where("lang is not null").mapInArrow(count, "lang string, word binary, bin long, n long")
              .groupBy("lang", "word", "bin").agg(F.sum("n").alias("n")))
    words = counts.where("bin < 0")
    ranked = (words.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word")))
              .where(F.col("rank") <= COMMON_WORDS).select("lang", "word", F.col("bin"), "n"))
    total = words.groupBy("lang").agg(F.sum("n").alias("n")).select("lang", F.lit(None).cast("binary").alias("word"),
                                                                    F.lit(-2).cast("long").alias("bin"), "n")
    refs: dict = {}
    for lang, word, b, n in ranked.union(total).union(counts.where("bin >= 0")).collect():
        char, common, totals = refs.setdefault(lang, (np.zeros(len(CLASSES)), {}, [0]))
        if b >= 0:
            char[b] = n
        elif b == -2:
            totals[0] = n
        else:
            common[bytes(word)] = n
    out = {}
    for lang, (char, common, totals) in refs.items():
        if totals[0] < MIN_REFERENCE_WORDS:
            continue
        names = sorted(common, key=lambda w: (-common[w], w))
        out[lang] = (char, {w: i for i, w in enumerate(names)},
                     np.array([*(common[w] for w in names), totals[0] - sum(common.values())], dtype=np.float64))
    return out


def _counts(lang, seen: Counter):
    plain: Counter = Counter()
    for w, n in seen.items():
        p = plain_word(w)
        if p:
            plain[p] += n
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(plain), pa.string()), pa.array(list(plain), pa.binary()),
         pa.array(np.full(len(plain), -1)), pa.array(np.fromiter(plain.values(), np.int64, len(plain)))],
        ["lang", "word", "bin", "n"])


class Reference:
    """One language's histograms; the bins of raw words are remembered up to a bound."""

    class _Bins(dict):
        BOUND = 300_000

        def __init__(self, common: dict[bytes, int]):
            super().__init__()
            self.common = common

        def __missing__(self, word: bytes) -> int:
            if len(self) >= self.BOUND:
                self.clear()
            b = self[word] = self.common.get(plain_word(word), len(self.common))
            return b

    def __init__(self, char: np.ndarray, common: dict[bytes, int], freq: np.ndarray):
        self.char, self.freq, self.bins = char, freq, self._Bins(common)

    def distances(self, text: bytes, words: list[bytes]) -> tuple[float | None, float | None]:
        """Distances of a document; None where a guard keeps it from counting."""
        by_char = by_word = None
        if len(text) >= MIN_CHARS:
            by_char = js_distance(char_histogram(text), self.char)
        if len(words) >= MIN_WORDS:
            bins = np.fromiter(map(self.bins.__getitem__, words), dtype=np.int64, count=len(words))
            by_word = js_distance(np.bincount(bins, minlength=len(self.freq)), self.freq)
        return by_char, by_word


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  references: dict | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept``.

    Words are runs without ASCII white space. A null text has no words. A row
    whose language is null, or has no reference because fewer than
    ``MIN_REFERENCE_WORDS`` words are of it, is judged by the closest
    reference (least word distance, then least character distance). ``kept`` is false when a base rule fails or a distance that
    counts is above its limit; with no reference at all nothing is judged.
    Other columns are ignored; ids may be null or repeat.
    """
    ready(docs.sparkSession)
    refs = docs.sparkSession.sparkContext.broadcast(
        learn_references(docs, lang_col, text_col) if references is None else references)

    def rules(batches):
        known = {lang: Reference(*r) for lang, r in refs.value.items()}
        for b in batches:
            rows = []
            for lang, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                text = text or b""
                n, chars, symbols, dup, repeat, words = base_metrics(text)
                failed = n < 10 or 100 * repeat > 20 * n
                by_char = by_word = None
                own = [known[lang]] if lang is not None and lang in known else list(known.values())
                if own:
                    by_char, by_word = min((r.distances(text, words) for r in own),
                                           key=lambda x: ((x[1] or 0.0), (x[0] or 0.0)))
                good = (by_char or 0.0) <= MAX_CHAR_DISTANCE and (by_word or 0.0) <= MAX_WORD_DISTANCE
                rows.append((n, chars, symbols, dup, repeat, failed, by_char, by_word, not failed and good))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            cols = zip(*rows) if rows else [[]] * 9
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
             "char_distance", "word_distance", "kept"]
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                         F.col(text_col).cast("binary").alias("text"))
    kinds = [source.schema["doc_id"].dataType, *[T.LongType()] * 5, T.BooleanType(), T.DoubleType(), T.DoubleType(),
             T.BooleanType()]
    return source.mapInArrow(rules, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))
