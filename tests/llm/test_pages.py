import base64
import gzip
import hashlib
import io

import pytest

from perkline.llm import html_text, warc

SCHEMA = "page_id long, url string, html string, path string, host string"


def page_rows():
    body = "<p>" + "équal words " * 20 + "</p>"
    rows = [(4, "http://a/1", body), (2, "http://a/2", body), (9, "http://b/", body), (2, "http://c/", body),
            (None, None, body), (5, None, None), (6, "http://x y\r\nWARC-Type: evil", ""), (7, "u", "tiny"), (8, "u", "tiny"),
            (10, "u", "x" * 100), (11, "u", "x" * 100), (12, "u", "y" * 99), (13, "u", "y" * 99),
            (14, "u", "\r\n\r\nWARC/1.1\r\n" * 50_000)]
    return [(*r, "p", None) for r in rows]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(page_rows(), SCHEMA).repartition(3)
    manifest = warc.write_archives(pages, roll_bytes=400)
    assert manifest.count() > 3
    got = warc.read_archives(manifest).collect()
    same = {hashlib.sha256(r[2].encode()).hexdigest(): m for r, m in (
        (next(x for x in page_rows() if x[0] == 2), 2), (next(x for x in page_rows() if x[0] == 10), 10))}
    want = []
    for page_id, _, html, *_ in page_rows():
        payload = (html or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        first = same.get(digest)
        revisit = first is not None and first != page_id
        want.append((page_id, len(payload), digest, "revisit" if revisit else "response", first if revisit else None,
                     None if revisit else payload))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                    None if r["payload"] is None else bytes(r["payload"])) for r in got), key=str) == sorted(want, key=str)
    empty = warc.write_archives(pages.limit(0))
    assert warc.read_archives(empty).count() == 0


def test_reader_frames_members_and_verifies():
    digest = hashlib.sha256(b"hello").hexdigest()
    data = b"".join(warc.member(warc.record(i, "http://h/", b"hello", digest, None, "1970-01-01T00:00:00Z")) for i in range(5))
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 5
    offsets = []
    for offset, pieces in warc.members(io.BytesIO(data)):
        fields, block = warc.read_record(pieces)
        offsets.append(offset)
        assert block.endswith(b"\r\n\r\nhello") and fields["warc-type"] == "response"
    assert len(offsets) == 5 and data[offsets[3]:offsets[3] + 2] == b"\x1f\x8b"
    with pytest.raises(ValueError, match="cut off"):
        [warc.read_record(p) for _, p in warc.members(io.BytesIO(data[:-3]))]
    broken = warc.record(1, None, b"hello", digest, None, "1970-01-01T00:00:00Z").replace(b"hello", b"hellO")
    with pytest.raises(ValueError, match="digest"):
        warc.read_record(iter([broken]))
    longer = warc.record(1, None, b"hello", digest, None, "1970-01-01T00:00:00Z") + b"x"
    with pytest.raises(ValueError, match="content length"):
        warc.read_record(iter([longer]))


def foreign(kind, block, version="1.0", **fields):
    names = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:x:{kind}>", "Content-Length": len(block)}
    names |= {k.replace("_", "-"): v for k, v in fields.items()}
    head = "".join(f"{k}: {v}\r\n" for k, v in names.items())
    return gzip.compress(f"WARC/{version}\r\n{head}\r\n".encode() + block + b"\r\n\r\n")


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_archives_of_other_writers(spark, tmp_path):
    http, page = "application/http; msgtype=response", b"<p>page</p>\r\n\r\nmore"
    chunked = b"5\r\n<p>pa\r\nE;x=1\r\nge</p>\r\n\r\nmore\r\n0\r\n\r\n"
    assert warc.unchunked(chunked) == page and warc.unchunked(page) is None and warc.unchunked(b"5\r\nab") is None
    plain, coded = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n" + page, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked
    records = [
        foreign("warcinfo", b"software: other\r\n", Content_Type="application/warc-fields"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", Content_Type="application/http; msgtype=request"),
        foreign("response", plain, Content_Type=http, WARC_Target_URI="http://h/\r\n  folded", WARC_Payload_Digest=sha1(page),
                WARC_Block_Digest=sha1(plain)),
        foreign("response", coded, Content_Type=http, WARC_Payload_Digest=sha1(page)),
        foreign("response", coded, Content_Type=http, WARC_Payload_Digest=sha1(chunked).lower()),
        foreign("response", plain, "1.1", Content_Type=http, WARC_Payload_Digest="blake9:whatever"),
        foreign("response", plain, Content_Type=http, WARC_Payload_Digest=sha1(b"the whole"), WARC_Truncated="length"),
        foreign("revisit", b"", WARC_Payload_Digest=sha1(page), WARC_Refers_To="<urn:x:response>"),
        foreign("resource", page, "0.18", WARC_Payload_Digest="md5:" + hashlib.md5(page).hexdigest()),
        foreign("metadata", b"")]
    path = tmp_path / "other.warc.gz"
    path.write_bytes(b"".join(records))
    manifest = spark.createDataFrame([(path.as_uri(),)], "path string")
    got = sorted(warc.read_archives(manifest).collect(), key=lambda r: r["offset"])
    assert [r["record_type"] for r in got] == [
        "warcinfo", "request", *["response"] * 5, "revisit", "resource", "metadata"]
    assert [r["payload"] and bytes(r["payload"]) for r in got] == [
        b"software: other\r\n", b"", *[page] * 5, None, page, b""]
    digest = hashlib.sha256(page).hexdigest()
    assert [r["payload_digest"] for r in got[2:9]] == [*[digest] * 5, "sha1:" + hashlib.sha1(page).hexdigest(), digest]
    assert [r["payload_bytes"] for r in got[2:9]] == [*[len(page)] * 5, None, len(page)]
    assert got[2]["url"] == "http://h/ folded" and got[7]["refers_to_record"] == got[2]["record_id"] == "<urn:x:response>"
    assert {r["page_id"] for r in got} == {None} == {r["refers_to"] for r in got}


@pytest.mark.parametrize("record, match", [
    (foreign("response", b"HTTP/1.0 200\r\n\r\nx", Content_Type="application/http", WARC_Payload_Digest=sha1(b"y")), "payload that differs"),
    (foreign("resource", b"x", WARC_Block_Digest=sha1(b"y")), "block that differs"),
    (foreign("resource", b"x", WARC_Payload_Digest="sha1:no digest"), "unreadable digest"),
    (foreign("resource", b"x", "9.9"), "known version")])
def test_damaged_records_of_other_writers(record, match):
    with pytest.raises(ValueError, match=match):
        warc.content(*warc.read_record(iter([gzip.decompress(record)])))


MAIN = "First  para&amp;graph\nwith &eacute; and <b>bold</b>text.<br>More"


def full_page(number, extra=""):
    return f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy</div><div id="cookie-notice">Cookies</div><aside>Side</aside>
<article class="post no-sidebar"><header><h1>Title {number}</h1></header><p>{MAIN}</p><p>Unclosed <i>inline
<p>Next {number}<ul><li>one<li>two</ul><div class="share">Share</div><form><input><p>Mail</p></form>
<p class="tagline">Read more of our stories</p>{extra}
<section class="comments"><article><p>Reader says</p></article></section></article>
<div class="related"><p>Other</p></div><footer>&copy; us</footer></body></html>"""


def test_main_text_by_markup():
    got = [text for _, text in html_text.blocks(full_page(3))]
    assert got == ["Title 3", "First para&graph with é and boldtext. More", "Unclosed inline", "Next 3", "one", "two",
                   "Read more of our stories"]
    assert html_text.blocks("") == [] and html_text.blocks("<p") == [("body", "<p")]
    assert [t for _, t in html_text.blocks("a < b <p>c</p>d")] == ["a < b", "c", "d"]
    assert [t for _, t in html_text.blocks("<body><nav>x</nav><div>y</div><script>z")] == ["y"]
    assert [t for _, t in html_text.blocks("<main><p>in</main><p>out")] == ["in"]
    assert len(html_text.blocks("<p>" + "word " * 200_000)) == 1
    assert html_text.blocks('<a href="' * 3000) != []


LONG = "Sentence of the article. " * 9


@pytest.mark.parametrize("page", [
    "<body><form id='aspnetForm' action='x'><nav><p>Menu</p></nav><article><p>{}</p></article><footer>f</footer></form></body>",
    "<body><p>Slogan</p><div class='layout-sidebar'><main><p>{}</p></main><div class='sidebar'><p>Side</p></div></div></body>",
    "<div class='comments-enabled'><article><p>{}</p></article><div class='comments'><article><p>Hm</p></article></div></div>",
    "<article><svg width='1'/><p>{}</p></article>", "<article><svg width='1'><path d='m'><p>{}</p></article>",
    "<article><svg><text>label</text></svg><p>{}</p></article>", "<article><math/><p>{}</p></article>"])
def test_article_is_kept_whatever_holds_it(page):
    assert [t for _, t in html_text.blocks(page.replace("{}", LONG))] == [LONG.strip()]


def test_math_text_stays_and_furniture_goes():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be.</p></article>"
    assert html_text.blocks(page) == [("p", "Let x=1 be.")]
    rest = "<section class='comments'><article><p>I say</p></article><article><p>Me too</p></article></section>"
    assert [t for _, t in html_text.blocks(f"<body><div><p>{LONG}</p></div>{rest}</body>")] == [LONG.strip()]
    assert [t for _, t in html_text.blocks(f"<p>Post</p><aside><article>{LONG}</article></aside>")] == ["Post"]
    assert [t for _, t in html_text.blocks("<article>" + "<svg>" * 20_000 + "<p>in</p></article>")][-1] == "in"


def test_templates_are_removed_per_host(spark):
    rows = [(i, f"http://One.example/{i}?q", full_page(i)) for i in range(12)]
    rows += [(100 + i, f"https://two.example:80/{i}", full_page(i)) for i in range(5)]
    rows += [(200 + i, "http://three.example/x", full_page(7)) for i in range(30)]
    rows += [(300, None, None), (301, "no address", ""), (None, "http://one.example/", full_page(50)), (3, "http://one.example/3", full_page(3))]
    pages = spark.createDataFrame([(*r, "p", "h") for r in rows], SCHEMA)
    got = html_text.main_text(pages).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[3] == "Title 3\nNext 3"
    assert text[None].splitlines() == ["Title 50", "Next 50"]
    assert text[103].endswith("Read more of our stories") and text[200].endswith("Read more of our stories")
    assert text[300] == text[301] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_templates_are_removed_per_section(spark):
    rows = [(i, f"http://one.example/news/{i}", f"<p>Our news desk</p><p>News {i}</p>") for i in range(12)]
    rows += [(100 + i, f"http://one.example/shop/a/{i}", f"<p>Our news desk {i}</p><p>Item {i}</p>") for i in range(30)]
    rows += [(200, "http://one.example/news", "<p>Our news desk</p>"), (201, "http://two.example/news/1", "<p>Our news desk</p>")]
    pages = spark.createDataFrame([(*r, "p", "h") for r in rows], SCHEMA)
    text = {r["page_id"]: r["text"] for r in html_text.main_text(pages).collect()}
    assert len(text) == len(rows) and all(text[i] == f"News {i}" for i in range(12))
    assert all(text[100 + i] == f"Our news desk {i}\nItem {i}" for i in range(30))
    assert text[200] == text[201] == "Our news desk"


@pytest.mark.parametrize(("page", "text"), [
    ('<article>a<section id="market-share"><p>real text</p></section></article>', "a\nreal text"),
    ('<article><p class="ad-free">real</p><div class="search-results-explained">x</div><div class="notice-period">y</div></article>',
     "real\nx\ny"),
    ('<article><p>x<button>y</p><p>lost?</p></article>', "x\nlost?"),
    ('<article><p>x<select><option>y</p><p>lost?</p></article>', "x\nlost?"),
    ('<article><p>x<noscript>y</p><p>lost?</p></article>', "x\nlost?"),
    ('<article><p>x<title>y</p><p>lost?</p></article>', "x\nlost?"),
    ('<article><p>x<script>if (a < b) y()</p><p>lost?</p></article>', "x\nlost?"),
    ('<article><p>x <button>y</button> z <textarea><p>w</textarea></p></article>', "x z"),
    ('<script>var t = "</p><article>no</article>";</script><article><p>x</article>', "x"),
    ('<article><p>x</p><section class="reviews"><article>good</article></section><ol class="responses"><li>me too</ol></article>', "x"),
    ('<article><p>x</p><p class="hidden">y</p><div class="share-buttons">z</div><div class="related-posts">w</div></article>', "x"),
    ("<article><p>" + "<b>" * 30 + "x<p>y</article>", "x\ny"),
])
def test_what_an_article_holds(page, text):
    assert "\n".join(t for _, t in html_text.blocks(page)) == text


def site_pages():
    """A host whose menu, notice and footer carry no telling names, and a paragraph that few of its pages share."""
    rows = []
    for i in range(24):
        part = "guides" if i % 4 == 0 else "news"
        notice = '<div class="x7"><p>Only for readers of guides.</p></div>' if part == "guides" else ""
        quoted = "<p>A sentence that several pages quote.</p>" if i % 3 == 0 else ""
        rows.append((i, f"http://site.example/{part}/{i}", (
            f'<body><div class="x1"><span>Start</span> <a href="/n">News</a></div>{notice}<div class="x2"><h1>Title {i}</h1>'
            f'<p>Text of page {i}.</p>{quoted}</div><div class="x3">Made with care &copy; 2024</div></body>')))
    rows += [(100 + i, f"http://small.example/{i}", f'<body><div class="x1">Menu</div><p>Small {i}</p></body>') for i in range(5)]
    return [*rows, (24, "http://site.example/guides/0", rows[0][2]), (25, "http://site.example/", None)]


def brute_template(rows, least, share):
    """Subtrees by a recursive parse of these well-formed pages, counted per host and folder."""
    from collections import defaultdict
    from html.parser import HTMLParser

    class Tree(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=False)
            self.stack, self.all = [["", []]], []

        def handle_starttag(self, tag, attrs):
            self.stack.append([(tag, tuple(attrs)), []])

        def handle_endtag(self, tag):
            name, parts = self.stack.pop()
            tree = (name, tuple(parts))
            self.stack[-1][1].append(tree)
            if tag != "body":
                self.all.append(tree)

        def handle_data(self, data):
            if data.strip():
                self.stack[-1][1].append(" ".join(data.split()))

        def handle_entityref(self, name):
            self.stack[-1][1].append(f"&{name};")

    sites = defaultdict(set)
    for _, url, page in rows:
        tree = Tree()
        tree.feed(page or "")
        host = url.split("/")[2]
        for site in {host, *([f"{host}/{url.split('/')[3]}"] if url.count("/") > 3 else [])}:
            if tree.all:
                sites[site].add(frozenset(tree.all))
    out = {}
    for site, pages in sites.items():
        trees = set().union(*pages)
        out[site] = {t for t in trees if sum(t in p for p in pages) >= max(least, 1) and sum(t in p for p in pages) > share * len(pages)}
    return out


def test_counting_finds_what_no_name_tells(spark):
    rows = site_pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df, least_pages=6, share=0.5).collect()}
    for i in range(24):
        want = [f"Title {i}", f"Text of page {i}.", *(["A sentence that several pages quote."] if i % 3 == 0 else [])]
        assert got[i] == "\n".join(want)
    assert got[100] == "Menu\nSmall 0" and got[24] == got[0] and got[25] == ""
    plain = {i: "\n".join(t for _, t in html_text.blocks(h or "")) for i, _, h in rows}
    assert all("Start" in plain[i] and "Made with care" in plain[i] for i in range(24))
    found = brute_template(rows, 6, 0.5)
    assert {name[0][0] for name in found["site.example"]} >= {"div", "a", "span"} and found["small.example"] == set()
    gone = {t[0] for t in found["site.example/guides"]}
    assert ("div", (("class", "x7"),)) in gone
