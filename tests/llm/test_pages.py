"""Archives by exact round trip, main texts by pages made by hand."""

import base64
import gzip
import hashlib
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog_sync.llm.site_style import DEPTH, extract, importance, main_texts, path_key, statistics
from catalog_sync.llm.warc import chunked, read_archives, records, round_trip, unchunked, write_archives

SCHEMA = "page_id long, url string, html string, record_type string, host string"
PAGES = [
    (3, "http://a/1", "same"), (1, "http://a/2\n x", "same"), (2, None, "same"), (4, "u", None), (5, "u", ""),
    (6, "http://é/", "é中文" * 40_000), (7, "u", "line\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n0\r\n\r\n"),
    (8, "u", "\n"), (9, "u", "\r\n\r\n"), (None, "u", "same"), (None, "u", "alone"), (6, "again", "other"),
    (10, "u", "x" * 65_536), (1, "twice", "same"),
]


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "t", "h") for r in rows], SCHEMA).repartition(3)

    return make


def archived_by_hand(rows, least):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        low = first.get(html or "") if len(data) >= least else None
        again = low is not None and i != low
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", low if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("least", "segment"), [(0, 1 << 16), (5, 300)])
def test_round_trip(pages, least, segment):
    out = round_trip(pages(PAGES), min_bytes=least, segment=segment).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=repr) == archived_by_hand(PAGES, least)
    texts = sorted(((r.page_id, bytes(r.payload).decode()) for r in out if r.record_type == "response"), key=repr)
    kept = [x[0] for x in archived_by_hand(PAGES, least) if x[3] == "response"]
    assert len(texts) == len(kept) and (6, "é中文" * 40_000) in texts


def test_files_are_archives(pages, tmp_path):
    write_archives(pages(PAGES), f"{tmp_path}/w", segment=1000)
    found = []
    for path in sorted(Path(tmp_path, "w").glob("part-*.gz")):
        data = gzip.decompress(path.read_bytes())
        if data:
            assert data.endswith(b"\r\n\r\n")
            found += [h["warc-type"] for h, _ in records(iter(data[:-1].split(b"\n")))]
    assert found.count("response") + found.count("revisit") == len(PAGES)
    assert found.count("continuation") > 300


def test_broken_archives_raise(spark, pages, tmp_path):
    write_archives(pages([(1, "u", "abc" * 1000)]), f"{tmp_path}/w", segment=500)
    text = "".join(gzip.decompress(p.read_bytes()).decode() for p in Path(tmp_path, "w").glob("part-*.gz"))
    parts = text.split("WARC/1.1\r\n")[1:]
    for name, own in (("lost", parts[:2] + parts[3:]), ("cut", parts[:-1]), ("changed", [p.replace("bca", "bda") for p in parts])):
        folder = Path(tmp_path, name)
        folder.mkdir()
        (folder / "part-0.gz").write_bytes(gzip.compress("".join("WARC/1.1\r\n" + p for p in own).encode()))
        with pytest.raises(Exception, match="segments missing|digest"):
            read_archives(spark, str(folder)).collect()


def test_chunks():
    for data in (b"", b"a", "é中".encode() * 9):
        assert unchunked(chunked(data, 5)) == data


def test_no_pages(pages):
    empty = pages([]).where("false")
    assert round_trip(empty).count() == 0 and main_texts(empty).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="blog">
<header class="site"><h1>Site</h1></header><div id="cookie-notice">Cookies</div><nav>menu</nav>
<div class="wrap"><main><article class="post"><header><h1>Title &amp; x</h1><p class="byline">By me</p></header>
<p>One<br>two &lt;b&gt; <b>th<i>r</i>ee</b></p><ul><li>a<li>b</ul><table><tr><td>c1<td>c2</table><aside>side</aside>
<p>Last<script>if(a<b)"</p>"</script> words.<div class="share-buttons">Share</div><form>f</form><footer>Posted</footer>
</article><section id="comments"><h2>Comments</h2><p>nice</p></section></main><div class="sidebar">S</div></div>
<footer>c</footer></body></html>"""


@pytest.mark.parametrize(("page", "text"), [
    (PAGE, "Title & x\n\nOne two <b> three\n\na\n\nb\n\nc1\n\nc2\n\nLast words."),
    ("", ""), ("just text & more < 5", "just text & more < 5"), ("<p> \n </p>", ""),
    ("<p>a<p>b<div>c &lt;\n d</div>text<!-- x", "a\n\nb\n\nc < d\n\ntext"),
    ("<article><h1>A</h1><p><b>x.<br><p>y</p></article><footer>f</footer>", "A\n\nx.\n\ny"),
    ("<div class='ad'>buy</div><p hidden>h</p><p>kept</p>", "kept"),
    ("<script>never closed", ""), ("<p title='a>b'>quoted</p>", "quoted"),
])
def test_blocks(page, text):
    assert extract(page, {}) == text


LONG = "All that this page has to tell, in a good many words. " * 3


@pytest.mark.parametrize("name", [
    "content with-sidebar", "site no-sidebar", "post has-comments", "wrapper nav-fixed", "withSidebar", "sidebar", "menu-open",
])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_names_of_wrappers(name, tag):
    page = (f"<nav>n</nav><div class='{name}'><{tag}><p>{LONG}</p><div class='share-buttons'>Share</div></{tag}>"
            "<div class='sidebar'>s</div><div class='comment-list'>c</div></div><footer>f</footer>")
    assert extract(page, {}) == ("" if name == "sidebar" and tag == "div" else LONG.strip())


@pytest.mark.parametrize("box", ["related", "related-posts", "comment-list", "cookie-notice"])
def test_marked_branches_beside_the_text_stay_out(box):
    page = f"<div class='text'><p>{LONG}</p></div><div class='{box}'><article><p>{LONG}{LONG}</p></article></div>"
    assert extract(page, {}) == LONG.strip()
    assert extract(f"<article class='post has-comments'><p>{LONG}</p></article><div class='{box}'>{LONG}</div>", {}) == LONG.strip()


def test_long_page():
    words = "word " * 200_000
    assert extract(f"<article><p>{words}</p></article>", {}) == words.strip()


def test_branches_alike_on_all_pages_go(pages):
    def page(n):
        box = "<div class='extra'><p>Read more from us</p></div>"
        return f"<body>{box}<div class='words'><p>Own text {n}</p><p>shared words</p></div></body>"

    rows = [(n, "http://h.example/p", page(n)) for n in range(20)] + [(99, None, page(99)), (98, "no host", None)]
    out = {r.page_id: (r.text, r.n_chars) for r in main_texts(pages(rows)).collect()}
    for n in range(20):
        assert out[n][0] == f"Own text {n}\n\nshared words" and out[n][1] == len(out[n][0])
    assert out[99][0].startswith("Read more") and out[98] == ("", 0)
    tree = {r.path: r.importance for r in importance(pages(rows)).where(F.col("pages") == 20).collect()}
    # Of the texts in words every second is on all pages.
    assert tree[path_key(["html", "body", "div.words", "p"])] > 0.3


@pytest.mark.parametrize(("copies", "others"), [(4, 0), (5, 0), (30, 0), (8, 2), (95, 6)])
@pytest.mark.parametrize("around", ["div", "article", "article><div class='entry'"])
def test_copies_of_a_page_are_one_page(pages, copies, others, around):
    def page(n):
        return f"<body><{around}><p>Text {n} of one</p><p>Text {n} of two</p></body>"

    rows = [(n, "http://h.example/p", page(max(0, n - copies + 1))) for n in range(copies + others)]
    out = {r.page_id: r.text for r in main_texts(pages(rows)).collect()}
    for n, _, html in rows:
        assert out[n] == extract(html, {}) != ""


@pytest.mark.parametrize("page", [
    "<a " * 400_000, "if a <b and " * 100_000, "<b>" * 200_000 + "</i>" * 200_000, "<div>" * 250_000,
    "<div>" * 100_000 + "</div>" * 100_000, "<i><div>" + "<b>" * 150_000 + "</i>" * 150_000,
    '<a ">" ' * 150_000 + "'>", "</title " * 150_000, "<title>" + "</title " * 150_000, "<a<" * 400_000 + ">",
    "<span class=ad>" * 30_000 + "<div></div>" * 60_000, "<li><article>" + "<div>" * 120_000 + "</li>" * 120_000,
    "<!--" * 300_000, "<div class=ad>" * 40_000, "&" * 1_000_000,
], ids=range(15))
def test_broken_markup_is_linear(page):
    start = time.process_time()
    extract(page, {})
    for _ in statistics(page):
        pass
    assert time.process_time() - start < 10  # about a megabyte; many minutes when quadratic


def test_tags_without_end():
    assert extract("one <a two <b three", {}) == "one <a two <b three"
    assert extract("<p>one</p><p title='x>two</p><p>it</p>", {}) == "one\n\ntwo\n\nit"
    assert extract("<p title=\"a>b\">one</p><i title='>two", {}) == "one\n\ntwo"


@pytest.mark.parametrize("deep", [3, DEPTH - 2, DEPTH + 3, 3 * DEPTH])
def test_deep_nesting_keeps_texts_and_marks(deep):
    page = "<div>" * deep + "<p>in</p><nav>menu</nav><p>mid<b>d</b>le</p>" + "</div>" * deep + "<p>out</p>"
    assert extract(page, {}) == "in\n\nmiddle\n\nout"


def test_hot_host_with_many_paths(pages):
    """Each page meets its own paths only, whatever its host has."""
    box = "<div class='box{}'><p>Read more from us</p></div>"
    names = ["".join(chr(97 + int(d)) for d in str(n)) for n in range(40)]
    rows = [(n, None, f"<body>{box.replace('{}', names[n // 6])}<p>Own text {n}</p></body>") for n in range(240)]
    out = {r.page_id: r.text for r in main_texts(pages(rows + rows[:1] + [(None, None, None)])).collect()}
    assert out.pop(None) == "" and out == {n: f"Own text {n}" for n in range(240)}
