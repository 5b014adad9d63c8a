"""URL rules, search, WARC, main text and personal data."""

import hashlib
import os
import random
import re
import tempfile
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import blockdist, collision_ann, pii_vote, queries, url_rules, warc
from tessera.llm.components import connected_components


def twin(name, **tables):
    """Sorted rows of a query's SQL over the given frames."""
    con = duckdb.connect()
    for table, df in tables.items():
        con.register(table, df.toArrow())
    return sorted(con.execute(queries.SQL[name]).fetchall(), key=str)


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(180)] + [(500, 500), (None, 1)] + [(900, 901 + i) for i in range(200)]
    edges += [(2000 + i, 2001 + i) for i in range(60)]  # a long chain
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "u bigint, v bigint"), "u", "v").collect()
    assert {tuple(x) for x in got} == {(x, find(x)) for x in label} and len(got) == len(label)
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint"), "u", "v").count() == 0


def test_url_rules(spark):
    link = lambda u: f'<link rel="canonical" href="{u}">'
    jump = lambda u: f"<meta http-equiv='refresh' content='0; url={u}'>"
    rows = [(1, "http://A.Example.ORG/es/1", ""), (2, "http://x.net/a", link("http://a.example.org/es/1")),
            (3, "http://x.net/b?q=1", jump("/a")), (4, "http://x.org/free", link("http://x.net/b?q=1")),
            (5, "http://y.net/c", link("http://z.example.com/de/9")), (6, None, link("http://q.com/de/")), (7, "nonsense", None),
            (8, "http://solo.net", ""), (9, "https://y.net/c#top", ""), (10, "http://e.example.org/en/12", ""),
            (11, "http://xexample.org/es/", ""), (12, "http://example.com/fr/de/", ""), (5, "http://y.net/c", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("verdict", F.lit("x"))
    edges = url_rules.page_edges(pages)
    got = {(r[0], r[1]): r for r in url_rules.judge(pages, edges).collect()}
    verdict = {k[0]: (r["rule"], r["verdict"]) for k, r in got.items()}
    assert verdict[1] == ("example.org/es/", "block")
    assert verdict[2] == verdict[3] == (None, "allow")  # page 4, an alias, is explicitly allowed
    assert verdict[4] == ("org/", "allow")
    assert verdict[5] == verdict[9] == (None, "block")  # through a target that is not in the table
    assert verdict[6] == verdict[7] == verdict[8] == (None, "allow")
    assert verdict[10] == ("example.org/en/1", "block") and verdict[11] == ("org/", "allow")
    assert verdict[12] == ("com/fr/", "allow")
    assert url_rules.judge(pages, edges).count() == len(rows)
    assert url_rules.judge(pages, edges.where("false")).where("page_id is null" if False else "id = 2").first()["verdict"] == "allow"
    assert url_rules.judge(pages.where("false"), edges.where("false")).count() == 0


def test_url_rules_twin(spark):
    """Relative targets, references, attributes in any order, upper case: the SQL reads them as Spark does."""
    link = lambda u: f"<p>1 > 0</p><LINK href='{u}' REL=canonical><link rel=stylesheet href=x>"
    rows = [(1, "http://a.net/d/x?p=1&q=2", link("../y")), (2, "http://A.net/d/../y", ""), (3, "http://b.com/de/1", link("//C.net/k#f")),
            (4, "http://c.net/k", None), (5, "http://d.net", link("e?u=1&amp;v=2")), (6, "http://d.net/e?u=1&v=2", link("http://example.org/es/")),
            (7, "http://f.net/g/h", '<meta content="0;URL = /i" http-equiv = "Refresh">'), (8, "https://f.net/i", link("http://b.com/de/2")),
            (9, None, link("http://b.com/de/2")), (10, "", link("/x")), (11, "x", link("y")), (None, "http://g.net/", "<link rel=canonical href=http://b.com/de/2"),
            (12, "http://h.net/ ", "<link rel=canonical href=http://b.com/de/2 x"), (2, "http://A.net/d/../y", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted((tuple(r) for r in url_rules.judge(pages, url_rules.page_edges(pages)).collect()), key=str)
    assert got == twin("op2_url_rules", pages=pages)
    verdict = {r[0]: r[4] for r in got}
    assert [verdict[i] for i in (1, 4, 5, 6, 7, 8)] == ["allow", "block", "block", "block", "block", "block"]


def test_hostile_pages(spark):
    """Megabytes of open tags, quotes and ends: time in proportion to the page, no error."""
    n = 200_000
    pages = ["<a " * n, "<a " * n + ">", '<a ">" ' * n, "<div>" * n + "</section>" * n, "<b><div>" + "<i>" * n + "</b>" * n, "<script>" * n,
             "<script>a</script " * n, "<nav>" + "<article>" * n, "<!--" * n, "<a " + "b " * n + ">x", "<" * 5 * n, "<xmp/><xmp>" * n]
    for page in pages:
        began = time.time()
        blockdist.main_text(page)
        assert time.time() - began < 5, page[:40]
    links = [x * 100_000 for x in ("<link canonical ", "<link rel= canonical>", "<link rel=canonical href= ' ", "<meta refresh ")]
    df = spark.createDataFrame([(i, "http://a.net", x) for i, x in enumerate(links)], "page_id bigint, url string, html string")
    url_rules.page_edges(df.where("page_id < 0")).count()  # the session's start is not timed
    began = time.time()
    assert url_rules.page_edges(df).count() == 0 and time.time() - began < 10
    zeros = "1.2.3." + "0" * 5000 + "7"
    assert pii_vote.base_spans(zeros + " 1.2.3." + "9" * 5000) == [("ip", 0, len(zeros))]
    assert [c["kind"] for c in pii_vote.candidates("1[.]2[.]3[.]4 " + "0" * 6000 + ".1.1.1")] == [1, 1]


def test_search(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(900, 16))
    x[300:600] = x[7]  # one hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [1.0, None] * 8), (1020, [1.0] * 3), (None, [1.0] * 16)]
    got = {}
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for q, rank, v, s in collision_ann.search(df, F.col("id") % 20 == 0, k=20).collect():
        got.setdefault(q, []).append((rank, v, s))
    assert sorted(got) == list(range(0, 900, 20))
    hits = 0
    for q, found in got.items():
        score = (x * x[q]).sum(axis=1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(900), -score))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(s == pytest.approx(score[v], rel=1e-12) for _, v, s in found)
        hits += len(set(best) & {v for _, v, _ in found})
    assert hits / (20 * len(got)) >= 0.9
    assert collision_ann.search(df.where("false"), F.col("id") % 20 == 0).count() == 0


def test_search_in_blocks(spark, monkeypatch):
    """Blocks of queries, written one after the other, find what one block does."""
    x = np.random.default_rng(9).normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    run = lambda: sorted(tuple(r) for r in collision_ann.search(df, F.col("id") % 20 == 0, k=5).collect())
    whole = run()
    assert len(whole) == 15 * 5
    for per_block in (4, 5, 15):  # a rest, none, one full block
        monkeypatch.setattr(collision_ann, "QUERY_BYTES", per_block * 8 * 8)
        assert run() == whole


def test_warc(spark):
    big = "<p>x\r\n\r\nWARC/1.1\r\n</p>" * 20
    rows = [(5, "http://a.com/x?y#z", big), (3, "http://b.com", big), (9, None, big), (1, "http://c.com/", "small"), (2, "http://d.com/", "small"),
            (4, "http://e.com/", None), (6, "bad\r\nurl", ""), (7, "http://f.com/é", "é" * 60), (7, "http://f.com/é", "é" * 60),
            (None, "http://g.com/", big), (8, "http://h.com/", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    out = os.path.join(tempfile.mkdtemp(), "w")
    got = {r["page_id"]: r for r in warc.archive_pages(pages, out).collect()}
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = html == big and i != 3
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
    t = warc.transactions(warc.read_records(spark, out, payloads=True)).collect()
    assert len(t) == 10 and all(r["request"] is not None and len(r["metadata"]) == 1 for r in t)
    assert {bytes(r["response"]["payload"]).decode() for r in t if r["response"]["type"] == "response"} == {
        r[2] or "" for r in rows}
    assert warc.archive_pages(pages.where("false")).count() == 0
    plain = os.path.join(tempfile.mkdtemp(), "p")
    warc.write_captures(pages, plain, codec="none")
    assert warc.read_records(spark, plain).count() == 33


def test_warc_of_repeated_rows(spark, monkeypatch):
    """A result row for each row, also of rows equal throughout, with and without an id."""
    monkeypatch.setattr(warc, "COPIES", 4)
    big = "<p>x</p>" * 40
    rows = [(7, "http://f.com/é", "é" * 60)] * 2 + [(None, "http://g.com/", big)] * 9 + [(None, None, None)] * 5 + [(3, "http://b.com", big)] * 4 + [
        (5, "http://a.com/", big), (1, "http://c.com/", "small"), (1, "http://d.com/", "small")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    out = os.path.join(tempfile.mkdtemp(), "w")

    def result(i, html):
        data = (html or "").encode()
        revisit = html == big and i != 3
        return i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None

    want = sorted((result(i, html) for i, _, html in rows), key=str)
    assert twin("op7_warc", pages=pages) == want
    assert sorted(map(tuple, warc.archive_pages(pages, out).collect()), key=str) == want
    assert sorted(map(tuple, warc.archive_pages(pages, out).collect()), key=str) == want  # written twice, still one capture each


def test_warc_of_equal_ids(spark):
    """One payload under equal ids, other ids and none: one response, the others revisit it."""
    big = "y" * 320
    rows = [(7, "a", big), (7, "b", big), (9, "c", big), (None, "d", big), (None, "e", "z" * 200), (None, "f", "z" * 200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = sorted(map(tuple, warc.archive_pages(pages).collect()), key=str)
    assert got == twin("op7_warc", pages=pages)
    assert sorted((r[3], r[4]) for r in got if r[1] == 320) == [("response", None)] + [("revisit", 7)] * 3


def test_main_text(spark):
    page = ("<html><head><title>t</title><script>a='</p>'</script></head><body><header>Site</header><nav><a href=x>Menu</a></nav>"
            "<div class='cookie-notice'>We use cookies</div><article><h1>Head &amp; more</h1><p>One  <b>two</b>\n three &lt;x&gt;</p>"
            "<div class=ad>Buy</div><p>Short.</p><aside>Side</aside><form>Name</form><p>Last &#233;<br><p>open</article>"
            "<section id=comments><article class=comment><p>Nice post</p></article></section><footer>(c)</footer></body>")
    want = "Head & more\n\nOne two three <x>\n\nShort.\n\nLast é\n\nopen"
    assert blockdist.main_text(page) == want
    assert blockdist.main_text(None) == blockdist.main_text("") == blockdist.main_text("<nav>a</nav>") == ""
    bare = "<div id=top><a href=a>Home</a></div><div><p>" + "word " * 40 + "</p><p>ok</p></div><div class=sidebar>Links</div>"
    assert blockdist.main_text(bare) == ("word " * 40).strip() + "\n\nok"
    assert blockdist.main_text("a < b and <p") == "a < b and <p"
    for name in ("page no-sidebar", "content has-comments", "layout with-footer", "menu-open"):  # a state, no boilerplate
        assert blockdist.main_text(f"<div class='{name}'><p>{'word ' * 40}</p></div>") == ("word " * 40).strip()
    df = spark.createDataFrame([(1, "u", page), (2, None, None), (1, "u", page), (3, "v", "<p>" * 50_000 + "x")],
                               "page_id bigint, url string, html string").withColumn("text", F.lit(0))
    got = blockdist.extract(df).collect()
    assert [(r["page_id"], r["n_chars"]) for r in got] == [(1, len(want)), (2, 0), (1, len(want)), (3, 1)]
    assert blockdist.extract(df.where("false")).count() == 0


def test_main_text_of_undeclared_page():
    """Short blocks in wrappers of their own, and short blocks between long ones, are content."""
    long = ("word " * 40).strip()
    wrap = lambda t: f"<section><div><div><p>{t}</p></div></div></section>"
    links = "<ul>" + "".join(f"<li><a href=/{i}>Topic number {i}</a></li>" for i in range(5)) + "</ul>"
    blocks = ["Short lead.", long, "Caption", "Item one", "Item two", long, "End."]
    page = "<body>" + "<div>Welcome</div>" + links + "<h1>Head</h1>" + links + "".join(map(wrap, blocks)) \
        + links + wrap("Mid") + wrap(long) + links + "<div>Imprint</div></body>"
    assert blockdist.main_text(page) == "\n\n".join(["Head", *blocks, "Mid", long])
    assert blockdist.main_text(wrap("One.") + wrap("Two.")) == "One.\n\nTwo."


def plain_surge(lines):
    """Surge to dive on an undeclared page without links, line by line and window by window."""
    high = []
    for i, (text, box) in enumerate(lines):
        total = sum(len(t) for j, (t, other) in enumerate(lines) if abs(i - j) <= 1 and (box > 0) == (other > 0))
        high.append(total >= 80 or box > 0 and any(len(t) >= 80 and other == box for t, other in lines))
    if True not in high:
        return [t for t, _ in lines]
    return [t for t, _ in lines[high.index(True):len(high) - high[::-1].index(True)]]


def test_surge_and_dive_by_brute_force():
    """Random pages without an article, names or links: lengths and boxes alone find the content."""
    rng = random.Random(5)
    cut = 0
    for _ in range(400):
        page, lines, box = "", [], 0
        for _ in range(rng.randrange(1, 7)):
            box += 1
            texts = ["x" * rng.choice((3, 9, 30, 60, 90, 300)) for _ in range(rng.randrange(1, 5))]
            if rng.random() < 0.5:
                page += "".join(f"<p>{t}</p>" for t in texts)
                lines += [(t, 0) for t in texts]
            else:
                page += "<div>" + "".join(f"<p>{t}</p>" for t in texts) + "</div>"
                lines += [(t, box) for t in texts]
        want = plain_surge(lines)
        cut += len(want) < len(lines)
        assert blockdist.main_text(f"<html><body>{page}</body></html>").split("\n\n") == want
    assert cut > 100  # the sums decide


def test_short_lines_far_from_the_text_dive():
    long = "word " * 60
    for t in ("div", "p"):
        page = "".join(f"<{t}>{x}</{t}>" for x in ("Acme Corp", "Call us today", "Open 9-5", long, "Imprint", "All rights reserved"))
        assert blockdist.main_text(f"<body>{page}</body>") == f"Open 9-5\n\n{long.strip()}\n\nImprint"
    # unclosed paragraphs are beside each other, and an article's last short lines stay with it
    assert blockdist.main_text(f"<div>Acme</div><div><p>{long}<p>One.<p>Two.<p>Three.</div><div>Imprint</div>") == \
        f"{long.strip()}\n\nOne.\n\nTwo.\n\nThree."


def test_main_text_of_declared_page():
    """Lists of links and short blocks beyond them go, by the window sums alone; single links stay."""
    long = ("word " * 40).strip()
    links = "<ul>" + "".join(f"<li><a href=/{i}>Topic number {i}</a></li>" for i in range(5)) + "</ul>"
    inner = f"<h1><a href=/x>Linked head</a></h1><p>{long}</p><p><a href=/y>Source</a></p><p>a</p><p>b</p><p>c</p>"
    want = f"Linked head\n\n{long}\n\nSource\n\na\n\nb\n\nc"
    assert blockdist.main_text(f"<main><div class=k1>Buy now</div>{links}{inner}{links}<div class=k2>50% off</div></main>") == want
    assert blockdist.main_text(f"<main>{inner}{links}<p>{long}</p></main>") == f"{want}\n\n{long}"
    assert blockdist.main_text(f"<main>{links}</main>").split("\n\n") == [f"Topic number {i}" for i in range(5)]
    # an ad inside the article cuts nothing around it
    ad = "<div class=ad>" + "<p>Buy</p>" * 5 + "</div>"
    assert blockdist.main_text(f"<main><p>Lead</p>{ad}<p>{long}</p>{ad}<p>End</p></main>") == f"Lead\n\n{long}\n\nEnd"


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(t):
    out = []
    for k, p in PLAIN.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if (k == "ip" and any(int(x) > 255 for x in m[0].split(".")) or k == "phone" and not 10 <= len(d) <= 15
                    or k == "card" and not (14 <= len(d) <= 19 and pii_vote.luhn(d))):
                continue
            out.append((k, *m.span()))
    return out


def test_base_spans():
    assert pii_vote.luhn("4111111111111111") and not pii_vote.luhn("4111111111111112")
    r = random.Random(4)
    for _ in range(20_000):
        t = "".join(r.choice("a@.@_1 2-+0(4.é") for _ in range(r.randint(0, 40)))
        assert sorted(plain_spans(t)) == sorted(pii_vote.base_spans(t)), t
    for t in ("a" * 200_000 + " x@y.z", "1" * 200_000, "1." * 60_000, "a@" * 60_000):  # linear time
        pii_vote.candidates(t)


def test_spans(spark):
    texts = ["mail bob@mail.com or bob (at) mail (dot) com, call 555-123-4567 now", "é 4111 1111 1111 1111 card 4111.1111.1111.1111",
             "server 10.0.0.1 and 999.1.1.1", "", None, "+1 (555) 123-4567"] + [f"contact u{i}@mail.com, phone +1 (555) 123-45{i:02d}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id bigint, text string").withColumn("spans", F.lit(1))
    rows = pii_vote.find_spans(df).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        base = plain_spans(texts[r["doc_id"]] or "")
        order = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted((a, pii_vote.KINDS.index(k), k, b) for k, a, b in base))
        assert r["base_sha256"] == hashlib.sha256(order.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii_vote.KINDS] == [sum(x[0] == k for x in base) for k in pii_vote.KINDS]
        assert set(filter(None, order.split(","))) <= set(r["spans"].split(","))
    assert pii_vote.find_spans(df.where("false")).count() == 0


def test_expectation_maximisation():
    """Simulated labelers: reliabilities order, and the posterior is right."""
    r = np.random.default_rng(6)
    true = r.random(4000) < 0.4
    right = (0.95, 0.85, 0.6)
    votes = np.stack([np.where(r.random(4000) < a, np.where(true, 1, -1), np.where(true, -1, 1)) for a in right], axis=1)
    patterns, where, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    q, prior, table = pii_vote.expectation_maximisation([(tuple(p), int(c)) for p, c in zip(patterns, n)])
    assert abs(prior - 0.4) < 0.08 and table[0][0, 2] > table[2][0, 2]
    assert ((q[where.ravel()] > 0.5) == true).mean() > 0.93


def labelled_texts(n, seed):
    """``(texts, true spans beyond the base ones)``: spelled-out data, some without a cue before it or
    in a network or area that a gazetteer may know, and look-alikes."""
    rng = random.Random(seed)
    words = "the of report value made this week with some plain words before after none list".split()
    said = lambda lo, hi: " ".join(rng.choice(words) for _ in range(rng.randrange(lo, hi)))
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    cues = {"email": "mail ", "ip": "host ", "card": "card ", "phone": "call "}

    def card(good):
        d = rng.choice("456") + digits(15)
        while pii_vote.luhn(d) != good:
            d = rng.choice("456") + digits(15)
        return "/".join(d[i:i + 4] for i in range(0, 16, 4))

    def span(kind, good):
        name = "".join(rng.choice("abcdefgh") for _ in range(6))
        if kind == "email":
            at, dot = rng.choice(("(at)", "[at]", " (at) ")), rng.choice(("(dot)", "[dot]", "."))
            return f"{name}{at}{name}{dot}{rng.choice(('com', 'org', 'de'))}" if good else f"{digits(3)}{at}{digits(4)}.{digits(2)}"
        if kind == "ip":
            return "[.]".join(["203", "0", "113", str(rng.randrange(256))] if good else [str(rng.randrange(300, 999)) for _ in range(4)])
        if kind == "card":
            return card(good)
        return f"{rng.choice(('212', '415')) if good else '9' + digits(2)}-{digits(3)}-{digits(4)}"

    texts, true = [], []
    for _ in range(n):
        t, spans = said(3, 12) + " ", set()
        for _ in range(rng.randrange(4)):
            kind, good, cue = rng.choice(pii_vote.KINDS), rng.random() < 0.5, rng.random() < 0.7
            if good:
                t += cues[kind] if cue else ""
            elif kind == "phone" or cue:
                t += rng.choice(("version ", "order ", "isbn ", "invoice "))
            s = span(kind, good)
            if good:
                spans.add(f"{kind}:{len(t)}:{len(t) + len(s)}")
            t += s + " " + said(15, 25) + " "
        strict = ("contact x@site.org", "card 4111 1111 1111 1111", f"tel +1 212 555 {digits(4)}", "server 10.1.2.3")
        texts.append(t + " " + " ".join(x + " " + said(15, 25) for x in strict if rng.random() < 0.3))
        true.append(spans)
    return texts, true


def added_spans(spark, texts, gazetteer=None):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = pii_vote.find_spans(df, gazetteer=gazetteer).select("doc_id", "spans").collect()
    base = [{f"{k}:{a}:{b}" for k, a, b in plain_spans(t)} for t in texts]
    return [found - base[i] for i, found in sorted((r["doc_id"], set(filter(None, r["spans"].split(",")))) for r in rows)]


def test_added_spans_of_labelled_texts(spark):
    """Precision and recall of the spans the method adds, by kind; a gazetteer table finds more of them."""
    texts, true = labelled_texts(1500, 8)
    table = spark.createDataFrame([("ip", "203.0.113"), ("phone", "212"), ("phone", " 415 "), ("phone", None), ("phone", ""),
                                   ("fax", "1"), ("ip", "203.0.113")], "kind string, entry string")
    recall = {}
    for name, gazetteer in (("built-in", None), ("table", table)):
        got = added_spans(spark, texts, gazetteer)
        for kind in pii_vote.KINDS:
            want = {(i, s) for i, x in enumerate(true) for s in x if s.startswith(kind)}
            have = {(i, s) for i, x in enumerate(got) for s in x if s.startswith(kind)}
            assert len(want) > 150 and have
            recall[name, kind] = len(want & have) / len(want)
            assert len(want & have) / len(have) >= 0.98
    assert all(r >= 0.65 for r in recall.values())
    assert all(recall["table", k] >= 0.98 for k in pii_vote.KINDS)


def test_gazetteer_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(pii_vote, "MAX_ENTRIES", 3)
    table = spark.range(4).selectExpr("'ip' AS kind", "cast(id as string) AS entry")
    assert pii_vote.read_gazetteer(table.where("id > 0"))["ip"] == {"1", "2", "3"}
    with pytest.raises(ValueError):
        pii_vote.read_gazetteer(table)


def test_mail_checks():
    for text, vote in (("a(at)b(dot)com", 1), ("a [at] b.co.uk", 1), ("12(at)34.56", -1), (".a@b.com", -1), ("a..b@c.com", -1),
                       ("a@-b.com", -1), ("a@b.c", -1), ("A@B.COM", 1), ("a@b[.]org", 1)):
        assert pii_vote.votes("email", text, 0, len(text), False)[1] == vote, text
