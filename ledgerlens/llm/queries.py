"""Queries of the training-data operators over the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from ledgerlens.llm import (centroids, decontaminate, htmltext, language, merkle, mixing, ngram_join, quality, sharding, substring,
                            tokens, topk, warc)
from ledgerlens.llm.common import Stages, read_table
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard_join(spark, sf_dir):
    out = ngram_join.ngram_jaccard_join(read_table(spark, sf_dir, "documents", "doc_id", "text"), n=3, num=90, den=100)
    return out.select("doc_id", "n_shingles", "component_id")


ORACLE["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 2], ' ')
                                  for i in generate_series(1, greatest(len(w) - 2, 1))]) AS gram
  FROM docs WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS same FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * same >= 90 * (p.n + q.n - same)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS node, doc_id AS low FROM docs UNION SELECT e.y, r.low FROM reach r JOIN edges e ON e.x = r.node)
SELECT d.doc_id, coalesce(max(s.n), 0)::BIGINT AS n_shingles, min(r.low) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.node = d.doc_id GROUP BY d.doc_id
"""


@query
def op1_ngram_jaccard_links(spark, sf_dir):
    """Class and number of links of every document."""
    out = ngram_join.ngram_jaccard_join(read_table(spark, sf_dir, "documents", "doc_id", "text"), n=3, num=90, den=100)
    return out.select("doc_id", "component_id", "n_links")


# the same links, counted for each document
ORACLE["op1_ngram_jaccard_links"] = ORACLE["op1_ngram_jaccard_join"].split("SELECT d.doc_id, coalesce")[0].rstrip() + r""",
counts AS (SELECT x AS doc_id, count(*) AS n FROM edges GROUP BY x)
SELECT d.doc_id, min(r.low) AS component_id, coalesce(max(c.n), 0)::BIGINT AS n_links
FROM docs d LEFT JOIN counts c ON c.doc_id = d.doc_id JOIN reach r ON r.node = d.doc_id GROUP BY d.doc_id
"""


@query
def op2_benchmark_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                    read_table(spark, sf_dir, "benchmark", "item_id", "text"), n=5, threshold=0.8)


# A-Z to a-z and every ASCII punctuation mark to a blank
_PLAIN_SQL = ("regexp_extract_all(translate(regexp_replace(coalesce(text, ''), '[\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]', ' ', 'g'), "
              "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')")

ORACLE["op2_benchmark_decontamination"] = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS rid, {_PLAIN_SQL} AS w FROM documents),
items AS (SELECT item_id, {_PLAIN_SQL} AS w FROM benchmark),
doc_words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM docs),
doc_grams AS (SELECT rid, pos, g FROM (
  SELECT rid, pos, n, string_agg(word, ' ') OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g
  FROM doc_words) WHERE pos + 4 <= n),
item_words AS (SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM items),
item_grams AS (SELECT item_id, g, count(*) AS c FROM (
  SELECT item_id, pos, n, string_agg(word, ' ') OVER (PARTITION BY item_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g
  FROM item_words) WHERE pos + 4 <= n GROUP BY 1, 2),
pairs AS (SELECT DISTINCT rid, item_id FROM doc_grams JOIN item_grams USING (g)),
starts AS (
  SELECT rid, item_id, least(len(i.w), len(d.w)) AS words, len(i.w) - 4 AS total,
         unnest(generate_series(1, len(d.w) - least(len(i.w), len(d.w)) + 1)) AS s
  FROM pairs JOIN docs d USING (rid) JOIN items i USING (item_id)),
counted AS (
  SELECT t.rid, item_id, s, words, total, g, count(*) AS c FROM starts t
  JOIN doc_grams d ON d.rid = t.rid AND d.pos BETWEEN s AND s + words - 5 GROUP BY ALL),
shared AS (
  SELECT rid, item_id, s, words, total, sum(least(w.c, coalesce(i.c, 0))) AS same
  FROM counted w LEFT JOIN item_grams i USING (item_id, g) GROUP BY ALL),
ranked AS (
  SELECT rid, item_id, s, words, sim, row_number() OVER (PARTITION BY rid, item_id ORDER BY sim DESC, s) AS k
  FROM (SELECT *, same::DOUBLE / (total + words - 4 - same)::DOUBLE AS sim FROM shared))
SELECT doc_id, item_id, sim AS similarity, (s - 1)::BIGINT AS start_word, words::BIGINT AS n_words
FROM ranked JOIN docs USING (rid) WHERE k = 1 AND sim >= 0.8
UNION ALL
SELECT doc_id, item_id, 1.0, 0, len(d.w) FROM docs d JOIN items i ON d.w = i.w WHERE len(d.w) BETWEEN 1 AND 4
"""


@query
def op3_language_id(spark, sf_dir):
    return language.identify_documents(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@query
def op4_mixing(spark, sf_dir):
    out = mixing.mix(read_table(spark, sf_dir, "documents", "doc_id", "text", "source"), Stages(spark, "mixing"),
                     weights=[3, 1, 2], total_share=1.5, max_epochs=2.0)
    return out.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op4_mixing"] = r"""
WITH words AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(len(regexp_extract_all(text, '[#*$%&|<>{}]')), 0) AS symbols,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '/mix'), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents),
docs AS (
  SELECT doc_id, source, size, -ln(u) / greatest(
           size / (size + 4.0::DOUBLE * symbols + (CASE WHEN size = 0 THEN 1 ELSE 0 END)::DOUBLE), 0.05::DOUBLE) AS key
  FROM words),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY (source IS NULL), encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM docs GROUP BY source),
caps AS (SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS ratio FROM sources),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM caps WINDOW before AS (ORDER BY ratio, (source IS NULL), encode(source)
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN o.ratio IS NULL OR l.ratio < o.ratio THEN cap ELSE least(cap, weight * o.level) END AS target
  FROM levels l LEFT JOIN (SELECT ratio, level FROM levels WHERE ratio > level ORDER BY ratio, level LIMIT 1) o ON true),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets),
ahead AS (
  SELECT d.*, p.source_size, p.target, p.epochs, round(p.target - p.epochs * p.source_size)::BIGINT AS rest,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_size
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + least(size, greatest(0, rest - before_size)))::BIGINT AS taken
FROM ahead
"""


@query
def op5_sharding(spark, sf_dir):
    return sharding.shard(read_table(spark, sf_dir, "documents", "doc_id", "text"), Stages(spark, "sharding"), shards=40)


@query
def op6_token_counts(spark, sf_dir):
    return tokens.count_tokens(read_table(spark, sf_dir, "documents", "doc_id", "text"), tokens.load_vocabulary())


@query
def op7_substring_dedup(spark, sf_dir):
    out = substring.remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"), k=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op7_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM docs),
windows AS (
  SELECT rid, pos, word, CASE WHEN pos + 34 <= n THEN string_agg(word, ' ') OVER (
    PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) END AS win FROM words),
counted AS (SELECT rid, pos, word, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS again FROM windows),
covered AS (
  SELECT rid, pos, word, bool_or(again) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM counted),
kept AS (
  SELECT rid, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS text
  FROM covered GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""


@query
def op8_warc(spark, sf_dir):
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), min_bytes=0)


ORACLE["op8_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS lead FROM p)
SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::BIGINT, 1)
         for i in generate_series(0, 31)], '') AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM d
"""


@query
def op9_html_extraction(spark, sf_dir):
    return htmltext.extract_main_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op10_quality_rules(spark, sf_dir):
    out = quality.quality_rules(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _js_sql(own: str, ref: str, bins: str) -> str:
    """Jensen-Shannon distance of every (rid, lang) to be judged: of the
    document's histogram ``own(rid, lang, b, c)`` to the language's
    ``ref(lang, b, c)`` over the bins ``bins(lang, b)``."""
    return f"""
SELECT rid, lang, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                       + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS distance
FROM (SELECT d.rid, d.lang, b.b, coalesce(o.c, 0) / d.total AS p, coalesce(r.c, 0) / t.total AS q
      FROM (SELECT rid, lang, sum(c)::DOUBLE AS total FROM {own} GROUP BY rid, lang) d
      JOIN (SELECT lang, sum(c)::DOUBLE AS total FROM {ref} GROUP BY lang) t ON t.lang = d.lang
      JOIN {bins} b ON b.lang = d.lang
      LEFT JOIN {own} o ON o.rid = d.rid AND o.lang = d.lang AND o.b = b.b
      LEFT JOIN {ref} r ON r.lang = d.lang AND r.b = b.b)
GROUP BY rid, lang"""


_CLASS_SQL = ", ".join(f"len(t) - len(regexp_replace(t, '{c}', '', 'g'))" for c in (
    "[a-z]", "[A-Z]", "[0-9]", "[\\x09\\x0B-\\x0D\\x1C-\\x1F ]", "\\n", "[.,;:!?\'\'\"()-]", "[#*$%&|<>]",
    "[+/=@\\[\\]\\\\^_`{}~]", "[^\\x00-\\x7F]", "[\\x00-\\x08\\x0E-\\x1B\\x7F]"))

ORACLE["op10_quality_rules"] = f"""
WITH docs AS (SELECT doc_id, lang, coalesce(text, '') AS t, row_number() OVER () AS rid,
                     regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
words AS (SELECT rid, lang, unnest(w) AS word, generate_subscripts(w, 1) AS pos, len(w) AS n FROM docs),
windows AS (SELECT rid, pos, CASE WHEN pos + 4 <= n THEN string_agg(word, ' ') OVER (
              PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) END AS g FROM words),
again AS (SELECT rid, pos, g IS NOT NULL AND count(*) OVER (PARTITION BY rid, g) > 1 AS twice FROM windows),
repeats AS (SELECT rid, count(*) FILTER (WHERE gone) AS n FROM (
  SELECT rid, bool_or(twice) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS gone FROM again)
  GROUP BY rid),
lines AS (SELECT rid, count(*) - count(DISTINCT line) AS dup FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
base AS (
  SELECT d.rid, doc_id, lang, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
         (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(l.dup, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, strlen(t) AS bytes
  FROM docs d LEFT JOIN lines l USING (rid) LEFT JOIN repeats r USING (rid)),
char_lists AS (SELECT rid, lang, [{_CLASS_SQL}] AS h FROM docs WHERE t <> ''),
chars AS (SELECT rid, lang, unnest(h) AS c, generate_subscripts(h, 1) AS b FROM char_lists),
plain AS (SELECT rid, lang, translate(trim(word, '.,;:!?\'\'"()-'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS p
          FROM words),
enough AS (SELECT lang FROM plain WHERE p <> '' AND lang IS NOT NULL GROUP BY lang HAVING count(*) >= {quality.MIN_REFERENCE_WORDS}),
judged AS (SELECT rid, lang FROM docs WHERE lang IN (FROM enough)
           UNION ALL SELECT rid, e.lang FROM docs d, enough e WHERE d.lang IS NULL OR d.lang NOT IN (FROM enough)),
char_ref AS (SELECT lang, b, sum(c) AS c FROM chars WHERE lang IN (FROM enough) GROUP BY lang, b),
char_bins AS (SELECT lang, b FROM char_ref),
own_chars AS (SELECT rid, j.lang, b, c FROM judged j JOIN chars USING (rid)),
counts AS (SELECT lang, p, count(*) AS n FROM plain WHERE p <> '' AND lang IN (FROM enough) GROUP BY lang, p),
ranked AS (SELECT lang, p, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, encode(p)) AS k FROM counts),
common AS (SELECT * FROM ranked WHERE k <= {quality.COMMON_WORDS}),
word_ref AS (SELECT lang, least(k, {quality.COMMON_WORDS + 1}) AS b, sum(n) AS c FROM ranked GROUP BY 1, 2),
own_words AS (SELECT j.rid, j.lang, coalesce(k, {quality.COMMON_WORDS + 1}) AS b, count(*) AS c
              FROM judged j JOIN plain w USING (rid) LEFT JOIN common o ON o.lang = j.lang AND o.p = w.p GROUP BY 1, 2, 3),
word_bins AS (SELECT lang, b FROM word_ref UNION SELECT lang, b FROM own_words),
by_char AS ({_js_sql("own_chars", "char_ref", "char_bins")}),
by_word AS ({_js_sql("own_words", "word_ref", "word_bins")}),
distances AS (
  SELECT rid, CASE WHEN bytes >= {quality.MIN_CHARS} THEN coalesce(c.distance, 0) ELSE 0 END AS by_char,
         CASE WHEN n_words >= {quality.MIN_WORDS} THEN coalesce(v.distance, 0) ELSE 0 END AS by_word
  FROM (SELECT rid, bytes, n_words FROM base) JOIN judged j USING (rid) LEFT JOIN by_char c USING (rid, lang) LEFT JOIN by_word v USING (rid, lang)),
closest AS (SELECT rid, by_char, by_word FROM (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY by_word, by_char) AS k FROM distances) WHERE k = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
       AND coalesce(by_char, 0) <= {quality.MAX_CHAR_DISTANCE} AND coalesce(by_word, 0) <= {quality.MAX_WORD_DISTANCE} AS kept
FROM base LEFT JOIN closest USING (rid)
"""


@query
def op11_exact_topk(spark, sf_dir):
    """The 5 best inner products of every 50th vector, against all vectors."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), Stages(spark, "topk"),
                      F.expr("vec_id % 50 = 0"), k=5, scale=256.0)


_USABLE_SQL = "embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0"

ORACLE["op11_exact_topk"] = f"""
WITH v AS (SELECT vec_id, row_number() OVER () AS rid, [floor(256 * x::DOUBLE) for x in embedding] AS x
           FROM embeddings WHERE {_USABLE_SQL}),
scored AS (SELECT q.rid AS q_rid, q.vec_id AS query_id, c.vec_id, c.rid, list_inner_product(q.x, c.x)::BIGINT AS score
           FROM v q JOIN v c ON c.rid <> q.rid WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_rid ORDER BY score DESC, vec_id NULLS LAST, rid)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op12_centroid_clustering(spark, sf_dir):
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), Stages(spark, "centroids"),
                                     k=8, rounds=10, seed="3:", dims=64, scale=1024.0)


def _kmeans_sql(k: int, rounds: int) -> str:
    """All rounds as one chain of tables: c<i> centroids, a<i> assignments."""
    out = [f"""WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS x
  FROM embeddings WHERE len(embedding) = 64 AND {_USABLE_SQL}),
e AS MATERIALIZED (SELECT rid, unnest(x) AS x, generate_subscripts(x, 1) AS dim FROM v),
c0 AS MATERIALIZED (
  SELECT (k - 1)::INT AS c, x FROM (SELECT x, row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) AS k FROM v) WHERE k <= {k})"""]
    for i in range(rounds + 1):
        out.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.rid, c.c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v.x, c.x)])::BIGINT AS d
    FROM v, c{i} c) GROUP BY rid)""")
        if i < rounds:
            out.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(n.x, o.x) AS x FROM c{i} o LEFT JOIN (
    SELECT c, list(m ORDER BY dim) AS x FROM (
      SELECT c, dim, ((sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*))::BIGINT AS m
      FROM a{i} JOIN e USING (rid) GROUP BY c, dim) GROUP BY c) n ON n.c = o.c)""")
    return ",\n".join(out) + f"""
SELECT v.vec_id, a.c AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN c{rounds} f ON f.c = a.c
"""


ORACLE["op12_centroid_clustering"] = _kmeans_sql(8, 10)


@query
def op13_merkle_manifest(spark, sf_dir):
    """Tampering lower-cases A-Z of the text of a fifth of the documents."""
    out = merkle.manifest(
        read_table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"), Stages(spark, "merkle"),
        ["doc_id", "source", "lang", "n_chars", "text"], tampered=F.expr("crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0"),
        tamper={"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


_FIELD_SQL = "CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}::VARCHAR) || ':' || {f}::VARCHAR END"
_LEAF_SQL = " || ".join(_FIELD_SQL.format(f=f) for f in ("doc_id", "source", "lang", "n_chars"))
_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# one bit of the CRC-32 of a byte
_CRC_STEP_SQL = "xor(c >> 1, (CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))"


def _tree_sql(name: str, leaves: str) -> str:
    """Nodes (tree, lvl, pos, h, n) above ``leaves`` (tree, pos, h, n), and of
    each node the joined digests of its run before and after it."""
    return f"""
{name} AS (
  SELECT tree, 0 AS lvl, pos, h, n FROM {leaves}
  UNION ALL
  SELECT tree, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 15) // 16)
  FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 16),
{name}_run AS (
  SELECT tree, lvl, pos, n,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name} WHERE n > 1 WINDOW run AS (PARTITION BY tree, lvl, pos // 16 ORDER BY pos))"""


def _walk_sql(name: str, tree: str, start: str) -> str:
    """From ``start`` (rid, tree, pos, proof, folded) up to the root of ``tree``."""
    return f"""
{name} AS (
  SELECT rid, tree, 0 AS lvl, pos, proof, folded FROM {start}
  UNION ALL
  SELECT w.rid, w.tree, w.lvl + 1, w.pos // 16, w.proof || r.before || r.after, sha256(r.before || w.folded || r.after)
  FROM {name} w JOIN {tree}_run r ON r.tree = w.tree AND r.lvl = w.lvl AND r.pos = w.pos),
{name}_end AS (SELECT rid, arg_max(proof, lvl) AS proof, arg_max(folded, lvl) AS folded FROM {name} GROUP BY rid)"""


ORACLE["op13_merkle_manifest"] = f"""
WITH RECURSIVE crc_table AS (
  SELECT b, b::BIGINT AS c, 0 AS i FROM range(256) t(b) UNION ALL SELECT b, {_CRC_STEP_SQL}, i + 1 FROM crc_table WHERE i < 8),
crc_of AS (SELECT list(c ORDER BY b) AS t FROM crc_table WHERE i = 8),
docs AS (SELECT row_number() OVER () AS rid, *, {_LEAF_SQL} AS head, 's' || source AS src FROM documents),
crc AS (
  SELECT rid, doc_id::VARCHAR AS s, 4294967295::BIGINT AS c, 1 AS i FROM docs WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT rid, s, xor(c >> 8, t[(xor(c, ascii(s[i])) & 255) + 1]), i + 1 FROM crc, crc_of WHERE i <= len(s)),
hit AS (SELECT rid FROM crc WHERE i = len(s) + 1 AND xor(c, 4294967295) % 5 = 0),
leaves AS (
  SELECT rid, doc_id, coalesce(src, 'n') AS tree, sha256(head || {_FIELD_SQL.format(f='text')}) AS leaf,
         CASE WHEN rid IN (SELECT rid FROM hit) THEN sha256(head || {_FIELD_SQL.format(f=_LOWER_SQL)}) END AS other
  FROM docs),
placed AS (
  SELECT *, leaf AS h, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM leaves),
{_tree_sql('inner_tree', 'placed')},
subroots AS (SELECT tree AS source, h AS subroot FROM inner_tree WHERE n = 1),
forest AS (SELECT source, subroot, subroot AS h, 'all' AS tree, row_number() OVER (ORDER BY encode(source)) - 1 AS pos,
                  count(*) OVER () AS n FROM subroots),
{_tree_sql('outer_tree', 'forest')},
inner_start AS (SELECT rid, tree, pos, '' AS proof, coalesce(other, leaf) AS folded FROM placed),
{_walk_sql('inner_walk', 'inner_tree', 'inner_start')},
outer_start AS (SELECT e.rid, 'all' AS tree, f.pos, e.proof, e.folded
                FROM inner_walk_end e JOIN placed p USING (rid) JOIN forest f ON f.source = p.tree),
{_walk_sql('outer_walk', 'outer_tree', 'outer_start')}
SELECT p.doc_id, p.leaf, f.subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = r.h AS verified
FROM placed p JOIN forest f ON f.source = p.tree JOIN outer_walk_end e USING (rid) JOIN (SELECT h FROM outer_tree WHERE n = 1) r ON true
"""
