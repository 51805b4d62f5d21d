"""The Merkle manifest against a plain tree that is rebuilt for every leaf."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import merkle
from ledgerlens.llm.common import Stages, ready

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, pos int, tree string, hash string, n int, block int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(fields):
    return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def climb(nodes, at):
    """Root, and all siblings of node ``at`` from the bottom up."""
    proof = ""
    while len(nodes) > 1:
        run = at // 16 * 16
        proof += "".join(x for i, x in enumerate(nodes[run:run + 16], run) if i != at)
        nodes, at = [h("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)], at // 16
    return nodes[0], proof


def lower(s):
    return None if s is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(rows):
    trees = {}
    for r in rows:
        changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        trees.setdefault(r[1], []).append((r[0], leaf(r), leaf((*r[:4], lower(r[4]))) if changed else leaf(r)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for t in trees.values():
        t.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subroots = [climb([x[1] for x in trees[s]], 0)[0] for s in order]
    root = climb(subroots, 0)[0]
    out = []
    for k, s in enumerate(order):
        leaves = [x[1] for x in trees[s]]
        for i, (doc_id, own, new) in enumerate(trees[s]):
            proof = climb(leaves, i)[1] + climb(subroots, k)[1]
            sub = climb(leaves[:i] + [new] + leaves[i + 1:], i)[0]
            folded = climb(subroots[:k] + [sub] + subroots[k + 1:], k)[0]
            out.append((doc_id, own, subroots[k], root, h(proof), folded, folded == root))
    return sorted(out, key=str)


def got(spark, rows, parts=3, **more):
    ready(spark)
    df = spark.createDataFrame([(*r, 1, "x", "y", 2, 3) for r in rows], SCHEMA).repartition(parts)
    out = merkle.manifest(df, Stages(spark, "t"), FIELDS, F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0"),
                          {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}, **more)
    return sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
                   .collect()), key=str)


def documents(n, source):
    return [(3 * i, source, "en", 10, f"Text {i} of Źródło " + "aB" * (i % 7)) for i in range(n)]


def test_edge_rows(spark):
    rows = documents(20, "a") + documents(5, "é") + documents(1, "") + documents(17, None)
    rows += [(None, "a", None, None, None), (None, "a", "en", 1, "X"), (6, "a", "en", 10, "another Text"), rows[3], rows[3],
             (40, "Z", None, None, ""), (45, "Z", "", 0, None), (50, "Z", "en", -1, "LONG " * 50_000)]
    want = brute(rows)
    assert got(spark, rows) == want
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (16, 1), (17,), (256, 3), (257, 2), (700, 15, 16, 17)])
def test_sizes_at_the_ends_of_runs_and_blocks(spark, sizes):
    rows = [r for k, n in enumerate(sizes) for r in documents(n, f"s{k}")]
    assert got(spark, rows) == brute(rows)


def test_many_levels_and_many_sources(spark):
    # blocks of 16: three distributed steps for the hot source
    rows = documents(300, "hot") + [r for k in range(40) for r in documents(2, f"s{k:02d}")]
    assert got(spark, rows, 5, block_levels=1) == brute(rows)


def test_no_rows(spark):
    assert got(spark, []) == []


def test_a_version_copies_only_the_path(spark):
    ready(spark)
    df = spark.createDataFrame([(*r, 1, "x", "y", 2, 3) for r in documents(300, "a")], SCHEMA)
    out = merkle.manifest(df, Stages(spark, "t"), FIELDS, F.expr("doc_id = 30"), {"text": F.upper("text")}).collect()
    # the leaf and its three ancestors (300 -> 19 -> 2 -> 1)
    assert {r.doc_id: r.copied for r in out if r.copied} == {30: 4}
    assert [r.doc_id for r in out if not r.verified] == [30]
