"""Archives and main-text extraction."""

import base64
import hashlib
import html as htmllib
import math
import random
import re
from collections import Counter

import pytest

from brute import prose
from ledgerlens.llm import htmltext, warc
from ledgerlens.llm.common import Stages
from scratch import local_scratch_dir

PAGES = "page_id bigint, url string, html string, record_type string, digest string, host string, block string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], PAGES)


def odd_pages():
    copy = "<html>copy " * 50
    return [(1, "http://a.example.com/x", copy), (2, "http://b.example.com/y?q=1#f", copy), (9, "https://a.example.com/x", copy),
            (3, None, "unique é ü 漢字"), (4, "not a url", ""), (5, "http://c.example.com:8080/\r\nX: y", None),
            (6, "http://[bad", "x\r\n\r\nWARC/1.1\r\n"), (7, "http://a.example.com/x", "long " * 300_000),
            (8, "ftp://user@d.example.com", ""), (9, "https://a.example.com/x", copy), (None, "http://n.example.com/", copy)]


def expected_records(rows, least=0):
    lead = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= least:
            lead[b] = max(lead.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = i is not None and len(b) >= least and lead[b] != i
        out.append((str(i), len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if revisit else "response", lead[b] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 20])
def test_archives_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    got = warc.archive_round_trip(pages_of(spark, odd_pages()).repartition(2), min_bytes=least).collect()
    assert sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                  key=str) == expected_records(odd_pages(), least)


def test_archives_of_no_pages(spark):
    assert warc.archive_round_trip(pages_of(spark, [])).collect() == []


def test_lookup_reads_the_records_of_a_url(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(i, f"http://h{i % 7}.example.com/p{i // 7 % 11}", f"body {i} {prose(i, 20)}") for i in range(150)]
    base, st = local_scratch_dir(), Stages(spark, "t")
    lines = st.write(warc.write_archives(pages_of(spark, rows).repartition(3), f"{base}/a"), "lines")
    bounds = st.write(warc.write_index(lines, f"{base}/i"), "bounds")
    ask = ["http://h3.example.com/p5", "https://H3.EXAMPLE.com:443/p5#frag", "http://absent.example.com/", None]
    urls = spark.createDataFrame([(u,) for u in ask], "url string")
    got = warc.lookup(urls, bounds, f"{base}/a", f"{base}/i").collect()
    want = {(u, i, h) for u in ask[:2] for i, v, h in rows if v == ask[0]}
    assert {(r.url, r.page_id, bytes(r.payload).decode()) for r in got} == want and len(want) >= 4
    assert warc.read_all(spark, bounds, f"{base}/a", f"{base}/i").count() == len(rows)


def test_url_keys_sort_by_reversed_host():
    assert warc.url_key("http://Www.A.example.com:80/x?q=1#f") == "com,example,a,www)/x?q=1"
    assert warc.url_key("https://a.example.com") == "com,example,a)/"
    assert warc.url_key("http://a.example.com:8080/") == "com,example,a:8080)/"
    assert warc.url_key(None) == ")" and warc.url_key("x y") == ")x y"


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_article_text_of_the_shared_pages(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    out = htmltext.extract_main_text(pages)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = texts(out)
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(htmllib.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(p for p in parts if p), r.page_id


def test_markup_that_names_furniture():
    page = ('<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x="</p><p>no</p>";</script></head>'
            '<body class="has-sidebar"><header class="site"><h1>Site</h1></header><nav><a href="/">home</a></nav>'
            '<!-- <p>no</p> --><div class="cookie-notice">We use cookies</div><main><article class="post">'
            '<header><h1>Caf&eacute; &amp; Co&#46;</h1></header><p>One <b>bold</b>\n\t&nbsp;two<p>Three<br>four'
            ' <span class="ad-slot">buy</span> five</p><ul><li>a<li>b &lt;c&gt;</ul><table><tr><td>x<td>y</table>'
            '<div hidden>no</div><form><input><button>send</button></form><section id="comments"><p>reader</p></section>'
            '<footer>by me</footer></article></main><aside>side</aside><div role="contentinfo">c</div><footer>end</footer>')
    assert htmltext.main_text(page, "h", None) == (
        "Café & Co.\nOne bold two\nThree four five\na\nb <c>\nx\ny")
    assert htmltext.main_text(None, "h", None) == "" and htmltext.main_text("", "h", None) == ""
    assert htmltext.main_text("plain  text &amp; more", "h", None) == "plain text & more"
    assert htmltext.main_text("<p>cut <b>off &lt", "h", None) == "cut off <"
    assert htmltext.main_text("</div></p><div>a</span>b</div><p>c", "h", None) == "ab\nc"


def styled(i, host):
    return (i, f"http://{host}/{i}", f'<div class="top">Welcome to {host}</div><div class="body"><h2>{prose(i, 5)}</h2>'
            f'<p>{prose(1000 + i, 40)}</p></div><div class="tail">Imprint of {host} 2024</div>')


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_style_tree_removes_what_a_host_repeats(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    rows = [styled(i, "a.example.com") for i in range(12)] + [styled(100 + i, "b.example.com") for i in range(2)]
    got = texts(htmltext.extract_main_text(pages_of(spark, rows)))
    for i in range(12):
        assert got[i] == f"{prose(i, 5)}\n{prose(1000 + i, 40)}"
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # a host with two pages is not judged
    assert got[100].startswith("Welcome to b.example.com\n")


def plain_site(rng, host, n):
    """Pages whose markup names nothing: a menu (one item marked, by page), at
    times a box, a text, now and then with a line that many pages share."""
    for i in range(n):
        menu = "".join(f"<li>{w}{' now' if rng.random() < .1 else ''}</li>" for w in ("Home", "News", "Shop", "Contact us today"))
        box = "<section><p>Weather for the day</p><p>sunny</p></section>" if rng.random() < .6 else ""
        text = "".join(f"<p>{prose(rng.randrange(10**6), rng.randrange(3, 30))}</p>" for _ in range(rng.randrange(1, 5)))
        shared = "<p>All rights reserved by the publisher of this page</p>" if rng.random() < .7 else ""
        yield f"http://{host}/{i}", f"<div class=m><ul>{menu}</ul></div><div class=t>{text}{shared}</div>{box}<div class=z>page {i} of {host}, all of it free to read</div>"


def brute_tree(pages):
    """Texts by the tree's definition, host by host with counters."""
    hosts, out = {}, []
    for url, page in pages:
        hosts.setdefault(url.split("/")[2], []).append((url, *htmltext.parse(page)))
    for host, found in hosts.items():
        seen = {}
        for _, blocks, shown in found:
            seen[tuple(t for *_, t in blocks)] = (blocks, shown)
        counts, of, styles = {}, Counter(), {}
        for blocks, shown in seen.values():
            for node, _, _, t in set(blocks):
                counts.setdefault(node, Counter())[t] += 1
            for node in {b[0] for b in blocks}:
                of[node] += 1
                styles.setdefault(node, Counter())[shown.get(node, 0)] += 1

        def entropy(c):
            total = sum(c.values())
            return 1 if total <= 1 else -sum(k / total * math.log(k / total) for k in c.values()) / math.log(total)

        def low(node, t):
            c, m = counts[node], of[node]
            if m < 4:
                return False
            weight = sum(k * len(x) for x, k in c.items())
            content = sum(k * len(x) * (1 - math.log(k) / math.log(m)) for x, k in c.items()) / weight
            return (.9 * content + .1 * entropy(styles[node]) < .2
                    or c[t] >= 4 and c[t] >= m / 2 and entropy(c) < .7)

        out += [(url, "\n".join(t for node, _, _, t in blocks if not low(node, t))) for url, blocks, _ in found]
    return sorted(out)


def test_tree_equals_brute_force_where_the_markup_names_nothing(spark):
    rng = random.Random(9)
    pages = [p for k in range(8) for p in plain_site(rng, f"h{k}.example.com", [2, 3, 4, 5, 8, 12, 30, 60][k])]
    rows = [(i, *p) for i, p in enumerate(pages)]
    got = sorted((r.url, r.text) for r in htmltext.extract_main_text(pages_of(spark, rows).repartition(5)).collect())
    assert got == brute_tree(pages)
    plain = {u: htmltext.main_text(h, "", None) for u, h in pages}
    assert sum(plain[u] != t for u, t in got) > 100
    # the menu's varied items go with their branch; texts stay, as do a line repeated amid much text of its node
    # and one that differs on each page
    big = [(u, t) for u, t in got if "//h7." in u]
    assert not any("Contact us today" in t for _, t in big)
    assert all(line in t for u, t in big for line in re.findall(r"<p>([^<]*)</p>", dict(pages)[u])
               if line not in ("Weather for the day", "sunny"))


def test_tree_sees_what_the_markup_names(spark):
    # the same menu under <nav> and its blocks count as one content, whatever the prior says of them
    rows = [(i, f"http://s.example.com/{i}", f"<nav><p>Home and news</p></nav><article><p>{prose(i, 20)}</p></article>")
            for i in range(6)]
    st = Stages(spark, "t")
    low = htmltext.style_tree(htmltext.with_host(pages_of(spark, rows)), st).collect()
    nav = next(n for n, _, named, _ in htmltext.parse(rows[0][2])[0] if named)
    assert [(r.host, r.low) for r in low] == [("s.example.com", htmltext._node_hash("s.example.com", nav))]


def test_copies_of_a_page_keep_their_article(spark):
    one = styled(1, "c.example.com")
    rows = [(i, f"http://c.example.com/{i}", one[2]) for i in range(50)]
    rows += [(100, None, one[2]), (101, "nothing", None), (102, "http://c.example.com/z", ""), (102, "http://c.example.com/z", ""),
             (None, None, None)]
    out = htmltext.extract_main_text(pages_of(spark, rows)).collect()
    assert len(out) == len(rows)
    assert all(prose(1001, 40) in r.text for r in out if r.page_id is not None and r.page_id <= 100)
    assert all(r.text == "" and r.n_chars == 0 for r in out if r.page_id is None or r.page_id > 100)
    assert all(r.n_chars == len(r.text) for r in out)
    assert htmltext.extract_main_text(pages_of(spark, [])).collect() == []
