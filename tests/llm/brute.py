"""Plain versions of the operators, over Python lists, and fixtures."""

import collections
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text) if text else []


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n):
    w = words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(rows, n, num, den):
    """(doc_id, set size, smallest linked id) of every (doc_id, text)."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b:
                continue
            same = len(a & b)
            if den * same >= num * (len(a) + len(b) - same):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def removed_words(texts, k):
    """(words, words covered by a window that starts elsewhere too, kept words) of every text."""
    count = collections.Counter()
    for t in texts:
        w = words(t)
        count.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for t in texts:
        w = words(t)
        gone = set()
        for i in range(len(w) - k + 1):
            if count[tuple(w[i:i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def prose(seed, n, vocabulary=300):
    r = random.Random(seed)
    return " ".join(f"{r.choice('abcdefgh')}w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, share):
    """The text with a share of its words replaced."""
    r = random.Random(seed)
    return " ".join(f"edit{r.randrange(10 ** 9)}" if r.random() < share else w for w in text.split())


CLASH = ["component_id", "size", "taken", "shard", "slot", "kept", "score", "lang_pred", "th", "rep", "sid", "unit",
         "word", "target", "key", "bin", "start", "stay_id", "t_id"]

EDGE_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{c} string" for c in CLASH)


def edge_rows():
    """Nulls in every column, empty and very long texts, repeated rows, ties, extra columns."""
    base, long = prose(1, 120), prose(2, 60_000, 50_000)
    rows = [(1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \n\t\r ", None, "a", 4), (4, long, "en", "b", len(long)),
            (5, base, "en", "a", len(base)), (5, base, "en", "a", len(base)), (6, base, "de", None, len(base)),
            (None, base, "en", "a", None), (None, None, None, None, None), (7, "one", "en", "b", 3),
            (8, "Ωμέγα ΑΒΓ Äé ß", "el", "b", 14), (9, edited(base, 3, 0.01), "en", "c", 1), (10, "12 34 | # 5", "en", "c", 9),
            (11, base.upper(), "en", "c", 1), (12, "　 \x00 \x85\xa0", "en", "c", 3), (12, prose(5, 40), "en", "c", 3)]
    return [r + tuple("x" for _ in CLASH) for r in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
