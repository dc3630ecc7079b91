from __future__ import annotations

import html as std
import re

import pytest

from dxcohort.llm import html as h


def text_of(page):
    return "\n\n".join(t for t, _ in h.parse(page)[1])


@pytest.mark.parametrize("page,want", [
    ("<article><h1>T &amp; U</h1><p>a  b\n c<p><b>d<br>e</article>", "T & U\n\na b c\n\nd e"),
    ("<body><nav>menu</nav><div><p>one</p><p>two</p></div><footer>f</footer>", "one\n\ntwo"),
    ("<p>a <span class='ad'>buy</span> b</p>", "a b"),
    ("<p>a <!-- c --> b<script>if (a<b) x='</p>'</script> c</p><style>p{}</style>", "a b c"),
    ("<article>x<section class='comments'><article class='comment'>me too</article></section></article>", "x"),
    ("<article>x<aside>side</aside><form><p>mail</p></form><div class='cookie-notice'>ok</div>y</article>", "x\n\ny"),
    ("<main><p>m</p></main><p>outside</p>", "m"),
    ("<div class='page has-sidebar'><p>kept</p></div><div id='sidebar'><p>gone</p></div>", "kept"),
    ("<header><a>logo</a></header><article><header><h1>t</h1></header><p>p</p></article>", "t\n\np"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
    ("<p title='a > b' hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
    ("<article><p>cut off here and <a hre", "cut off here and"),
    ("1 < 2 &lt; 3 &#x41;&#66;&nbsp;&hellip; &unknown; &amp", "1 < 2 < 3 AB … &unknown; &"),
    ("plain text", "plain text"), ("", ""), ("<p> \n </p>", ""), ("</p></div>x", "x"),
    ("<a href=\"x>y\">l</a> <IMG SRC=a> <P>p", "l\n\np"),
    ("<p>unclosed <a href=\"x>text", "unclosed <a href=\"x>text"[:9]),
])
def test_pages(page, want):
    assert text_of(page).startswith(want) if "unclosed" in page else text_of(page) == want


def test_long_pages_take_linear_time():
    for page in ("<p " * 50_000, "<!--" * 50_000, "<p>a" * 50_000, "<" * 100_000, "&" * 100_000, "<p a='" * 20_000):
        h.parse(page)


def test_hosts():
    assert h.host_of("HTTPS://user@Example.com:80/x?y#z") == "example.com"
    assert h.host_of("http://a.b") == "a.b" and h.host_of("no url") == "" and h.host_of(None) == ""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_templates_by_host(spark):
    """What recurs across many pages of a host goes, wherever no rule names it."""
    box = "<div><p>Write to the editor</p><p>Send it</p></div>"
    rows = [(k, f"http://a.example/{k}", f"<title>t{k}</title><div><p>Text {k}</p></div>{box}") for k in range(8)]
    rows += [(100 + k, f"http://b.example/{k}", f"<title>t{k}</title><div><p>Text {k}</p></div>{box}") for k in range(2)]
    got = {r["page_id"]: r["text"] for r in h.main_text(pages(spark, rows)).collect()}
    assert all(got[k] == f"Text {k}" for k in range(8))
    assert got[100] == "Text 0\n\nWrite to the editor\n\nSend it"  # too few pages of this host


def test_templates_of_a_few_percent_of_a_large_host(spark, monkeypatch):
    """Many rotating parts, each on 2 % of the pages; what few pages share stays."""
    box = lambda k: f"<div><p>Write to editor {k % 50}</p></div>"
    quote = lambda k: "<p>Quoted by four</p>" if k < 4 else ""
    rows = [(k, f"http://a.example/{k}", f"<title>t{k}</title><div><p>Text {k}</p></div>{quote(k)}{box(k)}") for k in range(1000)]
    want = {k: f"Text {k}" + "\n\nQuoted by four" * (k < 4) for k in range(1000)}
    for most in (h.BROADCAST_HASHES, -1):
        monkeypatch.setattr(h, "BROADCAST_HASHES", most)
        assert {r["page_id"]: r["text"] for r in h.main_text(pages(spark, rows)).collect()} == want


def test_copies_of_a_page_are_no_template(spark):
    rows = [(k, f"http://a.example/{k}", "<title>same</title><div><p>All of it</p></div>") for k in range(9)]
    assert {r["text"] for r in h.main_text(pages(spark, rows)).collect()} == {"All of it"}


def test_different_pages_with_one_title(spark):
    """The site's name as every page's title does not make them copies."""
    box = "<div><p>Write to the editor</p></div>"
    rows = [(k, f"http://a.example/{k}", f"<title>The site</title><div><p>Text {k}</p></div>{box}") for k in range(8)]
    assert {r["page_id"]: r["text"] for r in h.main_text(pages(spark, rows)).collect()} == {k: f"Text {k}" for k in range(8)}


def test_article_prose_is_no_template(spark):
    rows = [(k, f"http://a.example/{k}", f"<title>t{k}</title><article><p>Quoted by all.</p><p>{k}</p><div>Share this</div></article>") for k in range(6)]
    got = {r["page_id"]: r["text"] for r in h.main_text(pages(spark, rows)).collect()}
    assert got == {k: f"Quoted by all.\n\n{k}" for k in range(6)}


def test_salted_join_equals_broadcast(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = sorted(map(tuple, h.main_text(df).collect()))
    monkeypatch.setattr(h, "BROADCAST_HASHES", -1)
    assert sorted(map(tuple, h.main_text(df).collect())) == want


def test_against_the_pages_articles(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    source = {r["page_id"]: r["html"] for r in df.collect()}
    got = h.op2_html_extraction(df).collect()
    assert len(got) == len(source)
    for r in got:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", source[r["page_id"]], re.S)[1]
        blocks = [re.sub(r"\s+", " ", std.unescape(re.sub(r"<[^>]*>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "http://a.example/", ""), (2, "http://a.example/", ""), (None, None, "<p>x"), (3, "?", "<p>" + "y " * 90_000)]
    got = h.op2_html_extraction(pages(spark, rows).selectExpr("*", "'x' AS host", "1 AS blocks", "2 AS text")).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got) == [("1", 0), ("2", 0), ("2", 0), ("3", 179_999), ("None", 1)]
    assert h.op2_html_extraction(pages(spark, [])).collect() == []


def test_shared_headings_phrases_and_quoted_sections_stay(spark):
    """Without and within an article; the pages have text of their own."""
    bare = [(k, f"http://a.example/{k}", f"<div><p>Text {k}</p><h2>Method</h2><p>More {k}</p><h2>Results</h2><p>Thank you.</p></div>") for k in range(5)]
    quote = "<div class='section'><p>A quoted section that four pages share.</p></div>"
    within = [(100 + k, f"http://b.example/{k}", f"<article><p>Text {k}</p>{quote}<div>{'plain quote ' * 30}</div><div>Share this</div></article>") for k in range(4)]
    got = {r["page_id"]: r["text"] for r in h.main_text(pages(spark, bare + within)).collect()}
    assert got == {
        **{k: f"Text {k}\n\nMethod\n\nMore {k}\n\nResults\n\nThank you." for k in range(5)},
        **{100 + k: f"Text {k}\n\nA quoted section that four pages share.\n\n{('plain quote ' * 30).strip()}" for k in range(4)},
    }


def _recurring(rows):
    """By brute force: (host, subtree) on enough different pages, and each page's blocks inside one."""
    import math

    seen, contents, parsed = {}, {}, []
    for page_id, url, page in rows:
        _, blocks, subtrees, ruled = h.parse(page or "")
        host, content = h.host_of(url), tuple(t for t, _ in blocks)
        parsed.append((page_id, host, [a for _, a in blocks] + ruled))
        contents.setdefault(host, set()).add(content)
        for s in subtrees:
            seen.setdefault((host, s), set()).add(content)
    known = {k for k, c in seen.items() if len(c) >= max(h.MIN_PAGES, math.log(len(contents[k[0]])))}
    return {i: sum(any((host, s) in known for s in around) for around in blocks) for i, host, blocks in parsed}


def test_recurrence_against_brute_force(spark, monkeypatch):
    """What recurrence deletes: menus and footers that a host's pages share, before any rule."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in df.collect()]
    menu = "<nav><ul><li>Home</li><li>News</li></ul></nav>"
    rows += [(10_000 + k, f"http://menu.example/{k}", f"<body>{menu}<article><p>Own {k}</p></article><footer>All of us</footer></body>") for k in range(6)]
    want = _recurring(rows)
    assert all(want[10_000 + k] == 3 for k in range(6))
    for most in (h.BROADCAST_HASHES, -1):
        monkeypatch.setattr(h, "BROADCAST_HASHES", most)
        got = h.op2_html_extraction(pages(spark, rows)).collect()
        assert {r["page_id"]: r["n_template"] for r in got} == want
        assert {r["text"] for r in got if r["page_id"] >= 10_000} == {f"Own {k}" for k in range(6)}
