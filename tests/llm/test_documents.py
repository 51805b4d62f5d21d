"""Operators over documents: edge cases and brute-force versions."""

import collections
import hashlib
import math
import re
import zlib

import pytest

from brute import (
    CLASH, components, edge_docs, edge_rows, edited, empty_docs, prose, removed_words, shingles, words,
)
from ledgerlens.llm import common, decontaminate, language, mixing, ngram_join, quality, sharding, substring, tokens
from ledgerlens.llm.common import Stages
from pyspark.sql import functions as F


def small(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def near_copies():
    """Groups of near copies around the threshold, chains, and short texts."""
    rows, k = [], 0
    for g in range(6):
        base = prose(100 + g, 30 + 40 * g)
        for c in range(8):
            rows.append((k, edited(base, k, (0.0, 0.005, 0.01, 0.02, 0.03)[c % 5])))
            k += 1
    tail = prose(7, 200).split()
    rows += [(k + i, " ".join(tail[i * 4:i * 4 + 150])) for i in range(12)]  # a chain of overlapping texts
    rows += [(k + 20 + i, " ".join(["same", "few", "words"][:i % 4])) for i in range(8)]
    return rows


@pytest.mark.parametrize("n,num", [(3, 90), (5, 80)])
def test_ngram_join_against_brute_force(spark, monkeypatch, n, num):
    rows = near_copies()
    want = components(rows, n, num, 100)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")

    def got():
        out = ngram_join.ngram_jaccard_join(df, n=n, num=num, den=100)
        return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str)

    assert got() == want
    assert len({c for _, _, c in want}) < len(rows)
    # groups split by n-gram and into chunk pairs give the same components
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 3)
    monkeypatch.setattr(common, "BATCH_BYTES", 2000)
    assert got() == want


def test_ngram_join_of_repeated_ids_with_other_texts(spark):
    a, b = prose(1, 300), prose(2, 100)
    rows = [(1, a), (1, b), (2, edited(b, 4, 0.012)), (3, edited(a, 5, 0.003)), (4, prose(3, 100)), (5, b), (5, prose(4, 60)),
            (6, edited(prose(4, 60), 6, 0.02))]
    out = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string"), n=3, num=85, den=100)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str)
    assert got == components(rows, 3, 85, 100)
    assert {c for i, _, c in got if i != 4} == {1}


def test_ngram_join_edges(spark):
    out = ngram_join.ngram_jaccard_join(edge_docs(spark), n=3, num=90, den=100)
    rows = [r[:2] for r in edge_rows()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=str)
    assert got == components(rows, 3, 90, 100)
    assert ngram_join.ngram_jaccard_join(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("batch_bytes", [common.BATCH_BYTES, 700])
def test_substring_against_brute_force(spark, sf_small, monkeypatch, batch_bytes):
    monkeypatch.setattr(common, "BATCH_BYTES", batch_bytes)  # runs of equal rows cross small batches
    passage = prose(9, 45)
    rows = pairs(small(spark, sf_small))[:150]
    rows += [(10_000 + i, f"{prose(i, 20)} {passage} {prose(50 + i, i)}") for i in range(5)]
    rows += [(20_000, "again " * 90), (20_001, prose(31, 34)), (20_002, prose(31, 34))]
    rows += [r[:2] for r in edge_rows()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = substring.remove_repeats(df, k=35).collect()
    want = removed_words([t for _, t in rows], 35)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in out) == sorted(
        (str(i), *w) for (i, _), w in zip(rows, want))
    assert sum(w[1] for w in want) > 500
    assert substring.remove_repeats(empty_docs(spark)).collect() == []


def test_substring_spans_name_their_source(spark):
    common.ready(spark)
    passage = prose(9, 60)
    rows = [(i, f"{prose(i, 10 + i)} {passage} {prose(50 + i, 12)}") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = df.selectExpr("doc_id", "hash(text) AS th", "CAST(text AS BINARY) AS text")
    spans = substring.repeated_spans(texts, 35).collect()
    by_id = dict(rows)
    for s in spans:  # the words of a span are those at its source coordinates
        own, src = by_id[s.doc_id].split(), by_id[s.src_doc].split()
        assert own[s.start:s.start + s.words] == src[s.src_start:s.src_start + s.words]
    assert {s.src_doc for s in spans} == {0} and len(spans) == 4 and {s.words for s in spans} == {60}


def brute_leaks(rows, items, n=5, threshold=0.8):
    def plain(t):
        return (t or "").encode().translate(decontaminate._PLAIN).split()

    out = {}
    for item, text in items:
        v = plain(text)
        bag = collections.Counter(tuple(v[i:i + n]) for i in range(len(v) - n + 1))
        for doc, t in rows:
            w = plain(t)
            if v and len(v) < n:
                if w == v:
                    out[doc, item] = 1.0
                continue
            m = min(len(v), len(w))
            for s in range(len(w) - m + 1 if v and m >= n else 0):
                own = collections.Counter(tuple(w[i:i + n]) for i in range(s, s + m - n + 1))
                shared = sum((own & bag).values())
                sim = shared / (sum(own.values()) + sum(bag.values()) - shared)
                if sim >= threshold and sim > out.get((doc, item), 0):
                    out[doc, item] = sim
    return out


def test_leaks_against_brute_force(spark):
    items = [(i, prose(500 + i, 25 + i % 7)) for i in range(30)] + [(90, None), (91, ""), (92, "of the"), (93, prose(599, 400))]
    rows = [(i, prose(1000 + i, 80)) for i in range(40)]
    for i in range(20):  # whole, changed in case and marks, lightly and heavily edited passages
        p = items[i][1]
        p = (p, p.upper(), p.replace(" ", ", "), edited(p, i, 0.02), edited(p, i, 0.3))[i % 5]
        rows.append((100 + i, f"{prose(i, 15)} {p} {prose(70 + i, 9)}"))
    rows += [(200, "of the"), (201, "of the house"), (202, items[3][1]), (203, None), (204, ""), (None, items[4][1]),
             (205, " ".join(items[5][1].split()[:-2])), (206, items[33][1]), (206, items[33][1])]
    want = brute_leaks(rows, items)
    docs = spark.createDataFrame([(*r, *("x" for _ in CLASH)) for r in rows],
                                 "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASH))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in got} == {k: round(v, 9) for k, v in want.items()}
    assert len(want) >= 15 and len(got) == len(want) + 1  # the repeated row twice
    clean = decontaminate.remove_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert decontaminate.find_leaks(empty_docs(spark), bench).collect() == []
    none = decontaminate.remove_leaks(docs, bench.limit(0))
    assert none.count() == len(rows) and decontaminate.find_leaks(docs, bench.limit(0)).collect() == []


def test_leaks_in_several_blocks_of_items(spark, monkeypatch):
    items = [(i, prose(500 + i, 25)) for i in range(9)]
    docs = spark.createDataFrame([(i, t) for i, t in items], "doc_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    got = decontaminate.find_leaks(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in range(9)]


def test_multi_index_finds_all_within_the_radius():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 256, 8, dtype=np.uint8)
        bits = np.unpackbits(a)
        bits[rng.permutation(64)[:decontaminate.RADIUS]] ^= 1
        b = np.packbits(bits)
        assert any(decontaminate._NEAR[a[k], b[k]] for k in range(8))


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify_documents(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert len(out) == len(truth) and len(held) > 100
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def brute_slots(text):
    """Hashed 1- to 3-grams of the lower-cased letters, a pad before and after each word, gram by gram."""
    words, word = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            words.append([ord(x) for x in word])
            word = ""
    out, mask = collections.Counter(), (1 << 64) - 1

    def add(value):
        out[(value * 0x9E3779B97F4A7C15 & mask) >> 49] += 1

    # pads are shared: one between two words, one at either end
    code = [0]
    for w in words:
        code += [*w, 0]
    for a, b, c in zip(code, code[1:], code[2:]):
        add(a * (1 << 21) + b)
        if b:
            add(b + (1 << 62))
            add((a * (1 << 42) + b * (1 << 21) + c + (1 << 63)) & mask)
    return out


def brute_mixture(counts, loglik, penalty, steps):
    """Languages and proportions by the definition, n-gram by n-gram."""
    k = loglik.shape[1]
    total = sum(counts.values())

    def em(chosen):
        share = [1 / len(chosen)] * len(chosen)
        for _ in range(steps):
            new = [0.0] * len(chosen)
            for s, n in counts.items():
                p = [share[i] * math.exp(loglik[s, c]) for i, c in enumerate(chosen)]
                for i, x in enumerate(p):
                    new[i] += n * x / sum(p)
            share = [x / total for x in new]
        return share, sum(n * math.log(sum(share[i] * math.exp(loglik[s, c]) for i, c in enumerate(chosen)))
                          for s, n in counts.items())

    single = [sum(n * loglik[s, c] for s, n in counts.items()) for c in range(k)]
    chosen = [max(range(k), key=single.__getitem__)]
    share, score = [1.0], single[chosen[0]]
    while len(chosen) < k:
        slope = {c: sum(n * math.exp(loglik[s, c]) / sum(share[i] * math.exp(loglik[s, x]) for i, x in enumerate(chosen))
                        for s, n in counts.items()) - total for c in range(k) if c not in chosen}
        nxt = max(slope, key=slope.get)
        if slope[nxt] <= 0:
            break
        new_share, new_score = em([*chosen, nxt])
        if new_score - score <= penalty * math.log(total):
            break
        chosen, share, score = [*chosen, nxt], new_share, new_score
    return chosen, share


def test_language_inference_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    langs, table = language.train(docs)
    by = collections.defaultdict(list)
    for r in docs.where("length(text) > 200").orderBy("doc_id").collect():
        by[r.lang].append(r.text[:300])
    texts = [t[0] for t in by.values()] + [f"{by['en'][k]} {by['fr'][k]}" for k in range(3)]
    texts += [f"{by['en'][1]} {by['fr'][1]} {by['de'][1]}" if "de" in by else by["en"][1], "a", "Ünï c0de, 漢字 x1y", "the the"]
    several = 0
    for t in texts:
        slots = language.ngram_slots(t)
        counts = collections.Counter(slots.tolist())
        assert counts == brute_slots(t), t
        chosen, share = language.infer(slots, table, 8.0)
        want, want_share = brute_mixture(counts, table, 8.0, language.STEPS)
        assert chosen == want and all(abs(a - b) < 1e-6 for a, b in zip(share, want_share)), t
        several += len(chosen) > 1
        # the steps come near where EM ends: many more of them move no proportion by a hundredth, nor the set
        far, far_share = brute_mixture(counts, table, 8.0, 10 * language.STEPS)
        assert far == chosen and all(abs(a - b) < 0.01 for a, b in zip(share, far_share)), t
    assert several >= 3


def test_language_mixtures_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    langs, table = language.train(docs)
    by = {r.lang: r.text for r in docs.where("length(text) between 800 and 3000").collect()}
    en, fr = by["en"][:800], by["fr"][:800]
    mixed = spark.createDataFrame([(1, en + " " + fr)], "doc_id bigint, text string")
    row = language.identify(mixed, langs, table).first()
    assert set(row.mixture) == {"en", "fr"} and all(0.35 < v < 0.65 for v in row.mixture.values())
    # a mixture's likelihood is not below that of any single language
    edges = language.identify(edge_docs(spark), langs, table)
    got = edges.collect()
    assert len(got) == len(edge_rows()) and [c for c in edges.columns if c in CLASH][0] in CLASH
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    for i in (1, 2, 3, 10):
        assert by_id[i] == ("und", 0.0)
    assert by_id[8][0] in langs
    assert language.identify(empty_docs(spark), langs, table).collect() == []
    no_langs, none = language.train(empty_docs(spark))
    assert no_langs == [] and {r.lang_pred for r in language.identify(docs, no_langs, none).collect()} == {"und"}


def water_fill(sizes, weights, budget):
    """Targets by sharing, capping at twice the size and sharing the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, live = {}, budget, set(names)
    while live:
        total = sum(weight[s] for s in live)
        over = {s for s in live if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            target.update({s: left * weight[s] / total for s in live})
            break
        for s in over:
            target[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
        live -= over
    return target


@pytest.mark.parametrize("edges", [False, True])
def test_mixing(spark, sf_small, edges):
    df = edge_docs(spark) if edges else small(spark, sf_small)
    out = mixing.mix(df, Stages(spark, "t"), weights=[3, 1, 2]).collect()
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    assert sorted((str(r.doc_id), r.size) for r in out) == sorted((str(i), len(words(t))) for i, t, _ in rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want = water_fill(sizes, [3, 1, 2], 1.5 * sum(sizes.values()))
    taken = collections.Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(df.repartition(5), Stages(spark, "t"), weights=[3, 1, 2]).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert mixing.mix(empty_docs(spark), Stages(spark, "t")).collect() == []


def test_mixing_prefers_quality_and_takes_epochs_first(spark):
    rows = [(i, ("good words here " if i % 2 else "b#d w|rds h&re ") * 10, "s") for i in range(400)]
    rows += [(1000 + i, "other source text " * 20, "t") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(df, Stages(spark, "t"), weights=[1, 5], total_share=0.7, cut_last=False).collect()
    s = [r for r in out if r.source == "s"]
    good = sum(r.taken for r in s if r.doc_id % 2)
    bad = sum(r.taken for r in s if not r.doc_id % 2)
    assert 0 < good + bad < sum(r.size for r in s) and good > 2 * bad
    assert all(r.taken in (0, r.size, 2 * r.size) for r in out)
    t = [r.taken // r.size for r in out if r.source == "t"]
    assert max(t) - min(t) <= 1


@pytest.mark.parametrize("edges", [False, True])
def test_sharding(spark, sf_small, edges):
    df = edge_docs(spark) if edges else small(spark, sf_small)
    n = 4 if edges else 40
    out = sharding.shard(df.repartition(3), Stages(spark, "t"), shards=n).collect()
    texts = [(r.doc_id, r.text) for r in df.collect()]
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == want
    slots, place = collections.defaultdict(list), collections.defaultdict(set)
    for r in out:
        assert 0 <= r.shard < n and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        place[r.text_crc32].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in place.values())
    units = collections.Counter()
    for _, size, crc in want:
        units[crc >> 16] += size
    best = brute_minimax([units[u] for u in sorted(units)], n)
    load = collections.Counter()
    for r in out:
        load[r.shard] += r.size
    assert max(load.values()) == best
    assert sharding.shard(empty_docs(spark), Stages(spark, "t")).collect() == []


def brute_minimax(sizes, shards):
    """Smallest possible greatest sum of a contiguous partition, by dynamic programming."""
    prefix = [0]
    for s in sizes:
        prefix.append(prefix[-1] + s)
    best = prefix[:]  # with one shard
    for _ in range(shards - 1):
        best = [min(max(best[i], prefix[j] - prefix[i]) for i in range(j + 1)) for j in range(len(prefix))]
    return best[-1]


def test_minimax_cuts():
    import random
    r = random.Random(3)
    for _ in range(200):
        sizes = [r.choice([1, 5, 20, 300]) for _ in range(r.randrange(1, 25))]
        n = r.randrange(1, 9)
        capacity, cuts = sharding.minimax_cuts(sizes, n)
        assert capacity == brute_minimax(sizes, n)
        ends = [*cuts[1:], len(sizes)]
        assert cuts[0] == 0 and all(sum(sizes[a:b]) <= capacity for a, b in zip(cuts, ends))
    assert sharding.minimax_cuts([], 3) == (0, [0, 0, 0])
    assert max(sharding.minimax_cuts([1] * 400, 40)[1][i + 1] - 10 * (i + 1) for i in range(39)) == 0


def test_sharding_of_a_hot_text_by_chunks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", 10)
    df = spark.createDataFrame([(i, "copy") for i in range(95)] + [(100 + i, f"t{i}") for i in range(30)],
                               "doc_id bigint, text string")
    out = sharding.shard(df, Stages(spark, "t"), shards=3).collect()
    for k in range(3):
        slots = sorted(r.slot for r in out if r.shard == k)
        assert slots == list(range(len(slots)))
    assert len(out) == 125


def greedy_pieces(word, vocabulary, longest):
    n = i = 0
    while i < len(word):
        j = min(len(word), i + longest)
        while j > i + 1 and word[i:j] not in vocabulary:
            j -= 1
        i, n = j, n + 1
    return n


def test_token_automaton_against_greedy_matching():
    import random
    r = random.Random(5)
    for _ in range(60):
        voc = [bytes(r.choice(b"abc") for _ in range(r.randrange(1, 6))) for _ in range(r.randrange(0, 25))]
        a, longest = tokens.Automaton(voc), max(map(len, voc), default=1)
        for _ in range(60):
            w = bytes(r.choice(b"abcd") for _ in range(r.randrange(0, 14)))
            assert a.count(w) == greedy_pieces(w, set(voc), longest), (voc, w)


def test_token_counts(spark):
    voc = tokens.load_vocabulary()
    known, longest = set(voc), max(map(len, voc))
    rows = edge_rows()
    out = tokens.count_tokens(edge_docs(spark), voc).collect()

    def want(t):
        w = (t or "").encode().split()
        return len(w), sum(greedy_pieces((b" " if i else b"") + x, known, longest) for i, x in enumerate(w))

    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in out) == sorted((str(r[0]), *want(r[1])) for r in rows)
    assert tokens.count_tokens(empty_docs(spark), voc).collect() == []


def base(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    count = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    again = set()
    for i in range(len(w) - 4):
        if count[tuple(w[i:i + 5])] > 1:
            again.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(again),
            len(w) < 10 or 100 * len(again) > 20 * len(w))


def test_quality_base_against_brute_force(spark, sf_small):
    rows = pairs(small(spark, sf_small)) + [r[:2] for r in edge_rows()]
    rows += [(50_000, "a b c d e f\na b c d e f\n\n x \na b c d e f"), (50_001, "aa " * 40), (50_002, "l\nl\n l\n\t\n\t")]
    df = spark.createDataFrame([(*r, None) for r in rows], "doc_id bigint, text string, lang string")
    out = quality.quality_rules(df).collect()
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out)
    assert got == sorted((str(i), *base(t)) for i, t in rows)
    assert all(not r.kept for r in out if r.base_failed)


def test_quality_keeps_clean_and_drops_divergent_documents(spark):
    import random
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = random.Random(1)
    junk = ["".join(r.choice("0123456789{}[]=+~^_@/") for _ in range(6)) for _ in range(3000)]
    bad = spark.createDataFrame([(90_000 + i, " ".join(r.sample(junk, 200)), "en", "s", 0) for i in range(5)],
                                "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = {r.doc_id: r for r in quality.quality_rules(docs.union(bad)).collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good = [out[x.doc_id] for x in labels if x.quality == 1]
    assert all(x.kept for x in good if not x.base_failed) and len(good) > 200
    assert not any(out[90_000 + i].kept for i in range(5))


def test_quality_edges(spark):
    out = quality.quality_rules(edge_docs(spark)).collect()
    assert len(out) == len(edge_rows())
    assert quality.quality_rules(empty_docs(spark)).collect() == []


def test_js_distance():
    import numpy as np
    a, b = np.array([1.0, 3.0, 0.0]), np.array([0.0, 0.0, 5.0])
    assert quality.js_distance(a, a * 7) == 0.0 and abs(quality.js_distance(a, b) - 1.0) < 1e-12
    p, q = a / 4, np.array([0.5, 0.25, 0.25])
    m = (p + q) / 2
    kl = sum(x * np.log2(x / y) for x, y in zip(p, m) if x) + sum(x * np.log2(x / y) for x, y in zip(q, m) if x)
    assert abs(quality.js_distance(p, q) - np.sqrt(kl / 2)) < 1e-12
    assert shingles("A b", 3) == {("a", "b")} and hashlib.sha256(b"").hexdigest().startswith("e3b0")


def removed(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    out = substring.remove_repeats(df, k=35, **more).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in out)


def wanted(rows):
    return sorted((str(i), *w) for (i, _), w in zip(rows, removed_words([t for _, t in rows], 35)))


def test_substring_tells_rows_of_one_id_apart(spark):
    numbers = spark.range(300_000).selectExpr(
        "id", "concat_ws(' ', transform(sequence(1, 40), i -> concat('w', CAST(id * 41 + i AS STRING)))) AS text")
    clash = (numbers.selectExpr("id", "hash(text) AS h").groupBy("h").agg(F.collect_list("id").alias("ids"))
             .where("size(ids) > 1").first().ids[:2])
    a, b = (r.text for r in numbers.where(F.col("id").isin(clash)).collect())
    rows = [(None, a), (None, b), (1, a), (7, b + " " + prose(3, 50)), (7, prose(4, 80)), (7, prose(4, 80)), (None, prose(5, 70))]
    assert removed(spark, rows) == wanted(rows)
    rows = [(None, a), (None, b), (1, a)]  # unlike texts of equal 32-bit hash
    assert removed(spark, rows) == wanted(rows) and sorted(w[2] for w in wanted(rows)) == [0, 40, 40]


def test_substring_of_hot_minimizers_by_window(spark, monkeypatch):
    passage = prose(9, 50)
    rows = [(i, f"{prose(i, 20 + i % 7)} {passage} {prose(500 + i, 25)}") for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, "again " * 120), (201, passage), (None, passage), (None, rows[3][1])]
    monkeypatch.setattr(substring, "HOT", 3)
    assert removed(spark, rows) == wanted(rows)


def test_substring_spans_unlike_their_source_stay(spark, monkeypatch):
    """Hashes that put unlike words together: nothing is removed on their word."""
    rows = [(i, prose(i, 60)) for i in range(6)] + [(10, prose(70, 45)), (11, prose(70, 45))]
    right = substring.linked_spans

    def wrong(texts, k):
        found = right(texts, k)
        rows = texts.select("doc_id", "th").orderBy("doc_id").collect()
        false = [(a.doc_id, a.th, 3, 40, b.doc_id, b.th, 5) for a, b in zip(rows[:3], rows[1:4])]
        return found.union(spark.createDataFrame(false, found.schema))

    monkeypatch.setattr(substring, "linked_spans", wrong)
    assert removed(spark, rows) == wanted(rows)


def test_leaks_of_items_without_id_and_of_int_ids(spark):
    docs = spark.createDataFrame([(1, f"{prose(1, 20)} {prose(50, 30)}"), (2, prose(51, 30)), (3, prose(3, 40))], "doc_id bigint, text string")
    for kind, ids in (("int", (None, 7)), ("string", (None, "b"))):
        items = spark.createDataFrame([(ids[0], prose(50, 30)), (ids[1], prose(51, 30))], f"item_id {kind}, text string")
        got = decontaminate.find_leaks(docs, items)
        assert got.schema["item_id"].dataType.simpleString() == kind
        assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(1, ids[0]), (2, ids[1])]


def test_quality_of_null_and_rare_languages(spark):
    import random
    r = random.Random(2)
    junk = " ".join("".join(r.choice("0123456789{}[]=+~^_@/") for _ in range(6)) for _ in range(300))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    some = docs.where("doc_id % 10 = 3").withColumn("lang", F.lit(None).cast("string"))
    bad = spark.createDataFrame([(90_000, junk + " a", "zz"), (90_001, junk + " b", None), (90_002, junk + " c", "en")],
                                "doc_id bigint, text string, lang string")
    before = {x.doc_id: x.kept for x in quality.quality_rules(docs).collect()}
    out = {x.doc_id: x for x in quality.quality_rules(docs.where("doc_id % 10 <> 3").union(some).union(bad)).collect()}
    assert not any(out[i].kept for i in (90_000, 90_001, 90_002))
    assert all(out[x.doc_id].kept == before[x.doc_id] for x in some.collect())
    few = spark.createDataFrame([(1, prose(1, 100), "en"), (2, junk, None)], "doc_id bigint, text string, lang string")
    assert [x.kept for x in quality.quality_rules(few).orderBy("doc_id").collect()] == [True, True]  # no reference: not judged


def test_near_duplicates_keep_unlike_texts_of_one_id(spark, sf_small):
    from ledgerlens.llm import stages
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(1, a), (1, b), (2, edited(a, 1, 0.005)), (2, c), (3, c), (3, c), (4, ""), (4, None), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = stages.near_duplicates(spark, docs, sf_small)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, a), (1, b), (2, c), (4, ""), (4, None), (None, a)], key=str)
