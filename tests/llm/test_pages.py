"""Main text of pages, WARC archives and their index."""

import gzip
import io
import random

import pytest

from tidebook.llm import html_text, warc

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><a href="/">Home page of the site</a></header>
<nav><ul><li><a href="/a">A</a></li><li><a href="/b">B</a></li></ul></nav><div class="ad">Buy this thing now and here.</div>
{start}<h1>Title &amp; more</h1><p>First   paragraph with <b>bold</b> words and&nbsp;a space, long enough to be content.<p>Second one,
on two lines &lt;here&gt;.</p><ul><li>point one of the list</li></ul><form><input>Subscribe to us</form>{stop}
<aside><p>Sidebar text that is not part of it.</p></aside>
<section id="comments"><p>A reader's comment that is quite long and chatty, but no content.</p></section>
<div class="cookie-notice"><p>We use cookies.</p></div><footer>&copy; site</footer></body></html>"""
WANT = "Title & more First paragraph with bold words and a space, long enough to be content. Second one, on two lines <here>. point one of the list"


@pytest.mark.parametrize("tags", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class='post'>", "</div>")])
def test_article(tags):
    assert html_text.extract(PAGE.format(start=tags[0], stop=tags[1])) == WANT


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("plain text only", "plain text only"),
        ("<p>one<p>two &amp three", "one two & three"),
        ("<article><h1>Short</h1><p>x</article>", "Short x"),
        ("<article><p>cut off <b>in the mid", "cut off in the mid"),
        ("<html><body></body></html>", ""),
    ],
)
def test_small_pages(page, want):
    assert html_text.extract(page) == want


def test_long_page_in_pieces(monkeypatch):
    page = PAGE.format(start="<article>", stop="</article>")
    monkeypatch.setattr(html_text, "PIECE", 7)
    assert html_text.extract(page) == WANT
    monkeypatch.undo()
    words = " ".join(f"word{i}" for i in range(60_000))
    assert html_text.extract(f"<article><p>{words}</p></article>") == words


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")


def test_main_text_rows(spark, rows):
    frame = pages_frame(spark, [(1, "u", None), (1, "u", None), (None, None, "<p>a b</p>")])
    assert rows(html_text.main_text(frame), "page_id", "url", "text", "n_chars") == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "a b", 3)]
    assert html_text.main_text(pages_frame(spark, []).limit(0)).count() == 0


def sample_pages():
    rng = random.Random(3)
    bodies = ["<p>" + "é text " * n for n in (3, 20, 40, 200)]
    urls = ["http://a.example.com/x", "https://b.example.org/p?q=1#top", "http://a.example.com/x", "HTTP://User@[::1/", "no url\n", None]
    rows = [(i, rng.choice(urls), rng.choice([*bodies, f"<p>own {i} " + "x" * 150, None, ""])) for i in range(120)]
    return [*rows, (None, "http://z.example.net/", bodies[2]), (200, "http://t.example.net/", bodies[3] * 3), (200, "http://s.example.net/", bodies[3] * 3)]


def expected(pages):
    import hashlib

    first = {}
    for page_id, url, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100:
            rank = (page_id is None, page_id or 0, url is not None, url or "")
            first[raw] = min(first.get(raw, (rank, page_id, url)), (rank, page_id, url))
    out = []
    for page_id, url, html in pages:
        raw = (html or "").encode()
        again = raw in first and first[raw][1:] != (page_id, url)
        out.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw][1] if again else None))
    return sorted(out, key=repr)


def test_archives_read_back_through_the_index(spark, rows, monkeypatch):
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 7)
    pages = sample_pages()
    frame = pages_frame(spark, pages).repartition(3)
    archive = warc.write_archive(frame)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(archive.read(archive.find(warc.page_keys(frame))), *names) == expected(pages)
    monkeypatch.setattr(warc, "DIRECTORY_CHUNK", 3)
    assert rows(archive.read(archive.find(warc.page_keys(frame))), *names) == expected(pages)
    one = spark.createDataFrame([("com,example,a)/x",), ("com,example,nowhere)/",)], "key string")
    assert {r["key"] for r in archive.find(one).collect()} == {"com,example,a)/x"}


def test_archive_files_are_plain_gzip_members(spark, tmp_path):
    frame = pages_frame(spark, sample_pages()).coalesce(1)
    archive = warc.write_archive(frame)
    system, place = warc.locate(archive.path)
    from pyarrow import fs

    records = 0
    for info in system.get_file_info(fs.FileSelector(place)):
        if "/part-" in info.path:
            data = gzip.GzipFile(fileobj=io.BytesIO(system.open_input_stream(info.path).read())).read()
            records += data.count(b"WARC/1.1\r\n")
    assert records == len(sample_pages())


def test_long_records_are_several_members(spark, rows, monkeypatch):
    page = "<p>" + "long page " * 5000
    monkeypatch.setattr(warc, "MEMBER", 1000)
    parts = warc.members(page.encode())
    monkeypatch.undo()
    assert warc.inflate(parts) == page.encode()


def test_empty_archive(spark):
    frame = pages_frame(spark, []).limit(0)
    archive = warc.write_archive(frame)
    assert archive.read(archive.find(warc.page_keys(frame))).count() == 0


def test_reversed_hosts():
    assert warc.reversed_host("https://blog.example.com/en/1#top") == "com,example,blog)/en/1"
    assert warc.reversed_host("http://example.com") == "com,example)/"
    assert warc.reversed_host(None) == ""


BODY = "<p>" + "Some words of the article that go on. " * 20 + "</p>"
TEXT = " ".join("Some words of the article that go on.".split() * 20)


@pytest.mark.parametrize(
    "html, expected",
    [
        (f'<article class="post social-science">{BODY}</article>', TEXT),
        (f'<div class="site has-sidebar"><article>{BODY}</article></div>', TEXT),
        (f"<html><head><title>t</title><meta charset=utf-8>{BODY}", TEXT),
        (f'<p class="notice">Note<div>{BODY}</div>', TEXT),
        (f"<main><article>{BODY}</article><article>{BODY}</article></main>", f"{TEXT} {TEXT}"),
        (f'<article>{BODY}<section id="restaurant-menu">{BODY}</section></article>', f"{TEXT} {TEXT}"),
        (f"<article>{BODY}<ul>" + "<li><a href=x>A reference</a>" * 3 + "</ul></article>", TEXT + " A reference" * 3),
        (f'<body class="ad-free"><div class="page-menu-open"><div class="nav-container"><div class="social share">{BODY}</div></div></div>', TEXT),
    ],
)
def test_names_of_wrappers_do_not_condemn_the_article(html, expected):
    assert html_text.extract(html) == expected


@pytest.mark.parametrize(
    "side",
    [
        f'<div class="comments">{BODY}{BODY}{BODY}</div>',
        f'<section id="comments"><article class="comment">{BODY}</article><article class="comment">{BODY}</article></section>',
        "<div class='related'>" + "<a href=x>Another story of some length</a> " * 5 + "</div>",
        "<aside><p>By the way, a box beside the text.</p></aside>",
        '<div class="newsletter"><p>Subscribe to get this every week.</p></div>',
        "<p hidden>Not shown at all.</p>",
        '<div class="cookie-consent"><p>We use cookies.</p><button>Fine</button></div>',
    ],
)
def test_what_stands_beside_the_article_goes(side):
    assert html_text.extract(f"<body><div>{side}<article>{BODY}</article></div></body>") == TEXT
    assert html_text.extract(f"<body><div><article>{BODY}</article>{side}</div></body>") == TEXT

