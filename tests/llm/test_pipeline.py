"""The pipeline: each stage against a brute-force version on its own input."""

import collections

from brute import CLASH, EDGE_SCHEMA, components, edge_docs, edge_rows, empty_docs, prose, edited
from test_documents import brute_leaks, water_fill

import corpus_pipeline
from ledgerlens.llm import language
from ledgerlens.llm.common import Stages


def small_corpus(spark, sf_small):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, *("x" for _ in CLASH))
            for r in spark.read.parquet(f"{sf_small}/documents.parquet").limit(120).collect()]
    item = spark.read.parquet(f"{sf_small}/benchmark.parquet").first()
    base = prose(77, 90)
    rows += [(9000 + i, edited(base, i, 0.01), "en", "src1", 1, *("x" for _ in CLASH)) for i in range(6)]
    rows += [(9100, f"{prose(1, 30)} {item.text} {prose(2, 30)}", "en", "src2", 1, *("x" for _ in CLASH))]
    return spark.createDataFrame(rows + [r for r in edge_rows() if r[0] != 4], EDGE_SCHEMA)


def test_stages_against_brute_force(spark, sf_small):
    st = Stages(spark, "test-pipeline")
    docs = small_corpus(spark, sf_small)
    columns = docs.columns
    (_, lang), (_, near), (_, leaks), (_, mixing), (_, shard) = corpus_pipeline.STAGES

    out = st.write(lang(spark, docs, sf_small), "a")
    assert out.columns == columns
    has_letter = collections.Counter(str((r.doc_id, r.text)) for r in docs.collect()
                                     if r.text and any(c.isalpha() for c in r.text))
    assert collections.Counter(str((r.doc_id, r.text)) for r in out.collect()) == has_letter

    docs, out = out, st.write(near(spark, out, sf_small), "b")
    assert out.columns == columns
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # rows are linked one by one: ids that come with several texts are several nodes
    of = {n: rows[n][0] for n in range(len(rows)) if rows[n][0] is not None}
    least = {}
    for n, _, c in components([(n, rows[n][1]) for n in of], 5, 80, 100):
        least[c] = min(least.get(c, of[n]), of[n])
    got = [r.doc_id for r in out.collect()]
    assert sorted(i for i in got if i is not None) == sorted(least.values())
    assert got.count(None) == [i for i, _ in rows].count(None) and len(least) < len(of)

    docs, out = out, st.write(leaks(spark, out, sf_small), "c")
    assert out.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    leaked = {d for d, _ in brute_leaks([r for r in rows if len(r[1]) < 60_000], items)}
    assert 9100 in leaked and {r.doc_id for r in out.collect()} == {i for i, _ in rows} - leaked

    docs, out = out, st.write(mixing(spark, out, sf_small), "d")
    assert out.columns == columns
    sizes = {(str(r.doc_id), r.text): len(r.text.split()) for r in docs.collect()}
    total, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in docs.collect():
        n = sizes[str(r.doc_id), r.text]
        total[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    times = collections.Counter()
    for r in out.collect():
        taken[r.source] += sizes[str(r.doc_id), r.text]
        times[str((r.doc_id, r.text))] += 1
    target = water_fill(total, [3, 1, 2], 1.5 * sum(total.values()))
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in total) and max(times.values()) <= 2

    docs, out = out, st.write(shard(spark, out, sf_small), "e")
    new = [c for c in out.columns if c not in columns]
    assert set(out.columns) == {*columns, "shard", "slot"} and len(out.columns) == len(set(out.columns)) and new == []
    assert collections.Counter(str((r.doc_id, r.text)) for r in out.collect()) == times
    slots = collections.defaultdict(list)
    for r in out.collect():
        slots[r["shard"]].append(r["slot"])
    assert all(0 <= k < 40 and sorted(v) == list(range(len(v))) for k, v in slots.items())


def test_stages_on_edges_and_empty_tables(spark, sf_small):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge_docs(spark), sf_small)
        assert set(EDGE_SCHEMA.replace(" bigint", "").replace(" string", "").split(", ")) <= set(out.columns)
        assert 0 < out.count() <= 2 * len(edge_rows()), name
        assert stage(spark, empty_docs(spark), sf_small).count() == 0, name


def test_language_stage_without_labels(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert corpus_pipeline.STAGES[0][1](spark, docs, sf_small).count() == docs.count()
    assert language.train(docs)[0] == []


def test_run(spark, sf_small):
    out = corpus_pipeline.run(spark, sf_small)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert out.count() > 100
