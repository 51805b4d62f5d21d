"""Token counts by a linear longest-match automaton.

A vocabulary of byte strings becomes a trie. Every node has a failure link
and the number of tokens popped when the walk takes it, so greedy
longest-match tokenisation of a word is one pass over its bytes, and the
number of its pieces comes out without building them. Words are counted with
the blank in front of them (the first word of a text without), the form that
byte-level vocabularies hold, so pieces that start with a blank match at the
start of a word only.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import ready


#: the vocabulary file the query uses; a parameter of ``load_vocabulary``
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: a vocabulary is broadcast, so its size is checked
MAX_VOCABULARY = 1_000_000
#: words whose counts a worker remembers
MEMO = 400_000


def load_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The byte strings of a rank file (base64 token, blank, rank per line)."""
    with open(path, "rb") as f:
        out = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    if len(out) > MAX_VOCABULARY:
        raise ValueError(f"{len(out)} tokens; at most {MAX_VOCABULARY}")
    return out


class Automaton:
    """Longest-match automaton: ``step`` maps ``node * 256 + byte`` to a node,
    ``fail`` is the node to go on from when no step fits, ``pops`` the number
    of tokens that are complete then. Every single byte is a token (one
    outside the vocabulary becomes a piece of its own), so a node other than
    the root always has a link."""

    def __init__(self, vocabulary: list[bytes]):
        self.step: dict[int, int] = {}
        parent, byte, final = [-1], [0], [False]
        for token in [*(bytes([c]) for c in range(256)), *vocabulary]:
            node = 0
            for c in token:
                nxt = self.step.get(node << 8 | c)
                if nxt is None:
                    nxt = len(parent)
                    self.step[node << 8 | c] = nxt
                    parent.append(node)
                    byte.append(c)
                    final.append(False)
                node = nxt
            if node:
                final[node] = True
        depth = [0] * len(parent)
        for v in range(1, len(parent)):
            depth[v] = depth[parent[v]] + 1
        self.fail, self.pops = [0] * len(parent), [0] * len(parent)
        for v in sorted(range(1, len(parent)), key=depth.__getitem__):
            if final[v]:  # the node's own string is one token; nothing is left of it
                self.fail[v], self.pops[v] = 0, 1
                continue
            # otherwise as the parent's, and what that leaves is walked on by this byte
            z, count = self.fail[parent[v]], self.pops[parent[v]]
            while (z << 8 | byte[v]) not in self.step:
                count += self.pops[z]
                z = self.fail[z]
            self.fail[v], self.pops[v] = self.step[z << 8 | byte[v]], count

    def count(self, word: bytes) -> int:
        """Number of pieces of a greedy longest match, in one pass."""
        step, fail, pops = self.step, self.fail, self.pops
        node = total = 0
        for c in word:
            nxt = step.get(node << 8 | c)
            while nxt is None:  # the root has a step for every byte
                total += pops[node]
                node = fail[node]
                nxt = step.get(node << 8 | c)
            node = nxt
        while node:
            total += pops[node]
            node = fail[node]
        return total


class _Memo(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = self[word] = self.automaton.count(b" " + word)
        return n


def count_tokens(docs: DataFrame, vocabulary: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens``, one row per input row.

    ``n_tokens`` is the number of greedy longest-match pieces over all words
    of the whole text. A null or blank text has 0 words and 0 tokens; ids may
    be null or repeat; other columns are ignored.
    """
    spark = docs.sparkSession
    ready(spark)
    automaton = spark.sparkContext.broadcast(Automaton(vocabulary))

    def count(batches):
        memo = _Memo(automaton.value)
        for b in batches:
            words, tokens = [], []
            for text in b.column(1).to_pylist():
                w = text.split() if text else []
                words.append(len(w))
                n = sum(map(memo.__getitem__, w))
                if w:  # the first word has no blank in front
                    n += memo.automaton.count(w[0]) - memo[w[0]]
                tokens.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             ["doc_id", "n_words", "n_tokens"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return source.mapInArrow(count, T.StructType([
        T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("n_words", T.LongType()),
        T.StructField("n_tokens", T.LongType())]))
