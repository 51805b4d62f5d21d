"""Language identification as multilingual mixture inference.

Training counts hashed character n-grams (1 to 3 characters, letters only,
lower-cased, words padded) per language over all labelled training rows; the
counts are summed by Spark and a model has a fixed size (``SLOTS`` per
language). A document is a bag of such n-grams drawn from a mixture of the
languages: expectation-maximisation estimates the proportions, and the set
of languages is chosen by penalised likelihood: starting from the single
best language, the one that raises the likelihood most joins while the gain
exceeds ``penalty * log(n)`` (a BIC step).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import ready


SLOTS = 1 << 15
#: added to every slot count, so that unseen n-grams have a likelihood
SMOOTH = 0.5
#: EM steps for one set of languages
STEPS = 12
UNDETERMINED = "und"

_LETTER = None


def _letters() -> np.ndarray:
    """For every code point: its slot-independent class, 0 if not a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def ngram_slots(text: str | None) -> np.ndarray:
    """Hashed 1- to 3-grams of the letters of a text; empty without a letter."""
    if not text:
        return np.empty(0, dtype=np.int64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    code = np.where(_letters()[code], code, 0)
    if not code.any():
        return np.empty(0, dtype=np.int64)
    code = np.concatenate([[0], code, [0]]).astype(np.uint64)
    code = code[np.concatenate([[True], (code[1:] > 0) | (code[:-1] > 0)])]  # one pad between words
    a, b, c = code[:-2], code[1:-1], code[2:]
    mult = np.uint64(0x9E3779B97F4A7C15)
    two = (a * np.uint64(1 << 21) + b) * mult
    three = ((a * np.uint64(1 << 42)) + b * np.uint64(1 << 21) + c + np.uint64(1 << 63)) * mult
    one = (b + np.uint64(1 << 62)) * mult
    mid = b > 0
    grams = np.concatenate([one[mid], two[(a > 0) | mid], three[mid]])
    return (grams >> np.uint64(64 - 15)).astype(np.int64)


def train(rows: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their log-likelihoods ``[slot, language]``
    from all rows with a language; null texts count for nothing."""
    ready(rows.sparkSession)

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                g = ngram_slots(text)
                if len(g):
                    if lang not in total:
                        total[lang] = np.zeros(SLOTS, dtype=np.int64)
                    total[lang] += np.bincount(g, minlength=SLOTS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])],
                                             ["lang", "slot", "n"])

    counts = (rows.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
              .mapInArrow(count, "lang string, slot long, n long")
              .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(counts["lang"].to_pylist()), key=lambda x: x.encode())
    table = np.full((SLOTS, len(langs)), SMOOTH)
    if langs:
        place = {x: i for i, x in enumerate(langs)}
        np.add.at(table, (counts["slot"].to_numpy(), np.array([place[x] for x in counts["lang"].to_pylist()])),
                  counts["n"].to_numpy())
    return langs, np.log(table / table.sum(axis=0))


def _em(p: np.ndarray, weight: np.ndarray, total: float):
    """Proportions of a mixture with component likelihoods ``p`` and its
    log-likelihood (up to the scale taken out of ``p``)."""
    share = np.full(p.shape[1], 1.0 / p.shape[1])
    for _ in range(STEPS):
        mix = p @ share
        share = share * ((weight / mix) @ p) / total
    return share, float(weight @ np.log(p @ share))


def infer(slots: np.ndarray, loglik: np.ndarray, penalty: float):
    """Indices of the chosen languages and their proportions."""
    ids, weight = np.unique(slots, return_counts=True)
    ll = loglik[ids]
    weight = weight.astype(np.float64)
    single = weight @ ll
    best = int(np.argmax(single))
    chosen, share = [best], np.ones(1)
    if ll.shape[1] == 1:
        return chosen, share
    top = ll.max(axis=1)
    p = np.exp(ll - top[:, None])
    total = weight.sum()
    score = float(weight @ (ll[:, best] - top))
    cost = penalty * np.log(total)
    while len(chosen) < ll.shape[1]:
        # the slope of the likelihood towards a language bounds what it can add at first
        mix = p[:, chosen] @ share
        slope = (weight / mix) @ p - total
        slope[chosen] = -np.inf
        nxt = int(np.argmax(slope))
        if slope[nxt] <= 0:
            break
        new_share, new_score = _em(p[:, [*chosen, nxt]], weight, total)
        if new_score - score <= cost:
            break
        chosen, share, score = [*chosen, nxt], new_share, new_score
    return chosen, share


def identify(docs: DataFrame, langs: list[str], loglik: np.ndarray, text_col: str = "text",
             penalty: float = 8.0) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the language's proportion, 0 to
    1) and ``mixture`` (language -> proportion) added.

    A null text, a text without a letter, or a model without languages gives
    ``und`` with score 0 and an empty mixture. Only the text is read; the
    other columns pass unchanged. ``lang_pred``, ``score`` and ``mixture`` of
    the input, if any, are replaced.
    """
    spark = docs.sparkSession
    ready(spark)
    model = spark.sparkContext.broadcast((langs, loglik))
    docs = docs.drop("lang_pred", "score", "mixture")
    place = docs.columns.index(text_col)
    kinds = pa.map_(pa.string(), pa.float64())

    def predict(batches):
        names, ll = model.value
        for b in batches:
            pred, score, mixture = [], [], []
            for text in b.column(place).to_pylist():
                g = ngram_slots(text)
                if not len(g) or not names:
                    pred.append(UNDETERMINED)
                    score.append(0.0)
                    mixture.append([])
                    continue
                chosen, share = infer(g, ll, penalty)
                k = int(np.argmax(share))
                pred.append(names[chosen[k]])
                score.append(float(min(1.0, share[k])))
                mixture.append([(names[c], float(s)) for c, s in zip(chosen, share)])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(mixture, kinds)],
                [*b.schema.names, "lang_pred", "score", "mixture"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("mixture", T.MapType(T.StringType(), T.DoubleType()))])
    return docs.mapInArrow(predict, schema)


def held_out(id_col: str = "doc_id"):
    """Documents kept out of training: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify_documents(docs: DataFrame, penalty: float = 8.0) -> DataFrame:
    """Trains on the labelled rows that are not held out and predicts every
    row: ``doc_id, held_out, lang_pred, score, mixture``."""
    langs, loglik = train(docs.where(~held_out()))
    out = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), langs, loglik, penalty=penalty)
    return out.drop("text")
