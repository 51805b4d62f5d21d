"""Number of links of every row of the n-gram join."""

import pytest

from brute import components, edge_rows, shingles
from ledgerlens.llm import common, ngram_join
from test_documents import edge_docs, edited, near_copies, prose


def with_links(rows, n, num, den):
    """(doc_id, set size, smallest linked id, other rows that link) of every (doc_id, text)."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    out = []
    low = {i: c for i, _, c in components(rows, n, num, den)}
    for k, (i, a) in enumerate(sets):
        links = sum(1 for j, (o, b) in enumerate(sets) if j != k and o is not None and a and b
                    and den * len(a & b) >= num * len(a | b))
        out.append((i, len(a), low[i], None if i is None else links))
    return sorted(out, key=str)


def got(df, n, num):
    out = ngram_join.ngram_jaccard_join(df, n=n, num=num, den=100)
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in out.collect()), key=str)


@pytest.mark.parametrize("sets", [2000, 3])
def test_links_of_groups_beyond_a_spanning_forest(spark, monkeypatch, sets):
    rows = near_copies()
    rows += [(1000 + k, rows[k][1]) for k in (0, 0, 3, 8)]  # equal texts, one id twice
    want = with_links(rows, 3, 90, 100)
    assert max(r[3] for r in want) >= 3
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    monkeypatch.setattr(common, "BATCH_BYTES", 2000)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 90) == want


@pytest.mark.parametrize("sets", [2000, 2])
def test_links_of_repeated_ids_with_other_texts(spark, monkeypatch, sets):
    a, b, c = prose(1, 300), prose(2, 100), prose(4, 60)
    rows = [(1, a), (1, b), (1, edited(b, 8, 0.012)), (2, edited(b, 4, 0.012)), (3, edited(a, 5, 0.003)), (4, prose(3, 100)),
            (5, b), (5, c), (6, edited(c, 6, 0.02)), (6, b), (6, b)]
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    assert got(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, 85) == with_links(rows, 3, 85, 100)


def test_links_of_edge_rows(spark):
    assert got(edge_docs(spark), 3, 90) == with_links([r[:2] for r in edge_rows()], 3, 90, 100)
