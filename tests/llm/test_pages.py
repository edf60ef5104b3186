"""ARC to WARC conversion and main text extraction."""

from __future__ import annotations

import base64
import gzip
import hashlib
import itertools
import os
import random
import re
import tracemalloc
from html import unescape

import pytest

from gridlake.llm import warc
from gridlake.llm.extraction import extract_text, main_text, minimum_cut

ROOT = "/root/testdata/sf0.01"
with_tables = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")
SCHEMA = "page_id long, url string, html string, digest string, keeper string"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)


# --- archives -----------------------------------------------------------------


def plain_records(rows):
    largest = {}
    for i, _, page in rows:
        if i is not None:
            largest[page or ""] = max(i, largest.get(page or "", i))
    result = []
    for i, _, page in rows:
        data = (page or "").encode()
        keeper = largest.get(page or "")
        other = keeper is not None and i != keeper
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        result.append(str((i, len(data), digest, "revisit" if other else "response", keeper if other else None)))
    return sorted(result)


TRICKY = "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhttp://a 1.1.1.1 20240101000000 text/html 9\n"
ROWS = [
    (1, "http://a b/c d", "<p>é</p>"), (2, None, None), (3, "", ""), (4, "u\n\r v", TRICKY), (5, "http://x", TRICKY), (6, "\x00", "a\x00b\r"),
    (7, "http://é/ü", "z" * 200000), (7, "http://é/ü", "z" * 200000), (None, "n", "z" * 200000), (None, "n", "only null ids"),
    (None, "n", "only null ids"), (8, "http://q", "\n\n"), (-9, "http://neg", "\r\n\r\n"), (10, "-", "-"),
]


def test_pages_come_back(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    rows = ROWS + [(100 + i, f"http://h/{i}", "same page" if i % 3 else f"page {i}") for i in range(300)]
    path, back = warc.archive_pages(pages(rows), path=str(tmp_path / "w"))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(str(tuple(r[c] for c in names)) for r in back.collect()) == plain_records(rows)


def test_revisits_resolve_by_record_id(spark, pages, tmp_path):
    rows = [*ROWS, (11, "-", "-"), (11, "http://same", "another page"), (11, "http://same", "a third one"), (12, "v", "-")]
    rows += [(20, "a", "tie"), (20, "b", "tie"), (19, None, "tie")]
    path, back = warc.archive_pages(pages(rows), path=str(tmp_path / "w"))
    found = back.collect()
    responses = {r["record_id"]: (r["page_id"], r["payload_digest"]) for r in found if r["record_type"] == "response"}
    revisits = [r for r in found if r["record_type"] == "revisit"]
    assert len(revisits) >= 5
    for r in revisits:
        assert responses[r["refers_to_id"]] == (r["refers_to"], r["payload_digest"])
    assert all(r["refers_to_id"] is None for r in found if r["record_type"] == "response")
    # records share an id only if they are copies of one row; two of ROWS stand twice
    assert len({r["record_id"] for r in found}) == len(found) - 2
    files = spark.read.format("binaryFile").load(path).collect()
    fields = [r.fields for f in files for r in warc.parse_warc(gzip.decompress(f["content"]))]
    of_tie = [f for f in fields if f.get("WARC-Source-Key") == "19"]
    assert [(f["WARC-Refers-To-Target-URI"], f["WARC-Refers-To-Date"]) for f in of_tie] == [("b", "2024-01-01T00:00:00Z")]


def test_small_payloads_are_responses(pages):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    back = warc.archive_pages(pages(rows), min_bytes=3)[1].collect()
    assert {r["page_id"]: r["refers_to"] for r in back} == {1: None, 2: None, 3: 4, 4: None}


def test_no_pages(pages):
    assert warc.archive_pages(pages([]))[1].count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    rows = [(i, (url or "").encode(), (page or "").encode()) for i, url, page in ROWS]
    records = list(warc.parse_arc(warc.arc_file(rows, version)))
    assert [warc.split_http(r.block)[2] for r in records] == [page for *_, page in rows]
    for record in records:
        (back,) = warc.parse_warc(warc.to_warc(record))
        assert back.block == record.block and back.fields["WARC-Type"] == "response"
        assert back.fields["WARC-Date"] == "2024-01-01T00:00:00Z"


def test_arc_of_other_writers():
    body = b"1 1 Somebody\nURL IP-address Archive-date Content-type Archive-length\n"
    arc = b"filedesc://a.arc 0.0.0.0 19961022000000 text/plain %d\n%s\n\n" % (len(body), body)
    arc += b"http://a/with blank 1.2.3.4 19961022010203 image/gif 3\nGIF\nhttp://b 1.2.3.4 19961022010204 text/html 0\n\n"
    first, second = warc.parse_arc(arc)
    assert (first.url, first.kind, first.block, second.block) == ("http://a/with blank", "image/gif", b"GIF", b"")
    (back,) = warc.parse_warc(warc.to_warc(first))
    assert back.fields["Content-Type"] == "image/gif" and back.fields["WARC-Date"] == "1996-10-22T01:02:03Z"


def test_damaged_archives():
    good = warc.arc_file([(1, b"http://a", b"page")], 1)
    for bad in (good[:-5], good.replace(b"text/html", b"text/html x y"), b"no header\n"):
        with pytest.raises(ValueError):
            list(warc.parse_arc(bad))
    record = warc.to_warc(next(warc.parse_arc(good)))
    for bad in (record[:-8], record.replace(b"page", b"pane"), b"x" + record):
        with pytest.raises(ValueError):
            list(warc.parse_warc(bad))


def test_conversion_of_archive_files(spark, tmp_path):
    arcs = [(bytearray(warc.arc_file([(i, b"http://a", b"page %d" % i)], 1 + i % 2)),) for i in range(4)]
    path = str(tmp_path / "w")
    warc.write_warc(warc.convert(spark.createDataFrame([*arcs, (None,)], "archive binary")), path)
    assert {r["page_id"] for r in warc.read_warc(spark, path).collect()} == {0, 1, 2, 3}


# --- main text ----------------------------------------------------------------


def cost(labels, evidence, edges):
    total = sum(e if not c else 0 for c, e in zip(labels, evidence, strict=True) if e > 0)
    total += sum(-e if c else 0 for c, e in zip(labels, evidence, strict=True) if e < 0)
    return total + sum(w for a, b, w in edges if labels[a] != labels[b])


def test_cut_is_minimal():
    chance = random.Random(8)
    for _ in range(150):
        n = chance.randrange(1, 10)
        evidence = [chance.choice([-1000.0, 0.0, *[chance.uniform(-3, 3)] * 6]) for _ in range(n)]
        edges = [(i, j, chance.uniform(0, 2)) for i in range(n) for j in range(i + 1, min(n, i + 3))]
        least = min(cost(x, evidence, edges) for x in itertools.product([False, True], repeat=n))
        assert abs(cost(minimum_cut(evidence, edges), evidence, edges) - least) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>no</p>";</script><style>p {}</style></head><body class="nav-open">
<div id="cookie-notice"><p>We use cookies to improve your experience on this site. Please accept them now.</p></div>
<header><h1>Site name</h1><nav><a href="/">Home</a></nav></header><div class="wrap"><div class="content"><h1>Real title</h1>
<p>First paragraph with &eacute;&nbsp;some <b>bold</b>   text. And <a href="x">a link</a> in it.<p>Second &lt;one&gt;, short.
<div class="ad-slot">Buy our great new product today, it is wonderful and cheap.</div><!-- <p>hidden</p> -->
<ul><li>item one of the list<li>two</ul><p style="display:none">You do not see this sentence, dear reader.</p></div>
<div class="sidebar"><p>Popular: this long text is about something entirely different, dear reader.</p></div></div>
<section id="comments"><p>Great article! I really enjoyed reading all of it, thanks to the author for this work.</p></section>
<form><p>Subscribe to us by entering your mail here, please.</p></form><footer>&copy; us</footer></body></html>"""


def test_a_page_with_all_kinds_of_boilerplate():
    assert main_text(PAGE).split("\n") == [
        "Real title", "First paragraph with é some bold text. And a link in it.", "Second <one>, short.",
        "item one of the list", "two",
    ]


def test_odd_pages():
    assert main_text(None) == main_text("") == main_text("<nav>Home</nav>") == main_text("<script>x") == ""
    assert main_text("just one sentence without any tag in it.") == "just one sentence without any tag in it."
    assert main_text("<article><p>a &am") == "a &am"
    assert main_text('<article><p>cut off here <a href="x') == "cut off here"
    assert main_text("<article><p>1 < 2 and 3 > 2 &amp; so on") == "1 < 2 and 3 > 2 & so on"
    long = " ".join(f"word{i}" for i in range(100000))
    assert main_text(f"<article><p>{long}</p></article>") == long
    assert main_text("<article>" + "<p>Short one.</p>" * 3000 + "</article>").count("\n") == 2999
    assert main_text("<div>" * 3000 + "A sentence that is deep in the page, very deep.") != ""
    assert isinstance(main_text("<" * 50000), str)


@pytest.mark.parametrize(
    ("attributes", "kept"),
    [
        ('title="A hidden valley"', True), ('data-hidden="false"', True), ('data-url="/hidden-gems"', True), ("data-id=nav", True),
        ("data-x='class=\"ad\" hidden'", True), ("alt=hidden-lake", True), ('x-style="display:none"', True), ('aria-hidden="false"', True),
        ('title=" id=nav role=navigation "', True), ("hidden", False), ("data-a=1 HIDDEN", False), ('title="a"hidden', False),
        ('aria-hidden = "true"', False), ("style='display: none'", False), ('data-hidden="false" hidden=""', False),
    ],
)
def test_only_exact_attribute_names_count(attributes, kept):
    text = "This is one sentence of the main text, and it is long enough to be kept."
    for tag in ("article", "div", "p"):
        assert main_text(f"<body><{tag} {attributes}>{text}</{tag}></body>") == (text if kept else "")
    inline = f"<article><p>Before it <span {attributes}>within</span> after it, as all of it is text.</p></article>"
    assert ("within" in main_text(inline)) == kept


@pytest.mark.parametrize(
    ("inner", "kept"),
    [
        ("<span hidden><span>inner</span> LEAKED</span>", ""), ("<span hidden>a<b>LEAKED</b><i hidden>LEAKED</i>LEAKED</span>", ""),
        ("<span hidden><span><span hidden>a</span></span>LEAKED</span> seen", " seen"), ("<b hidden>LEAKED<br>LEAKED", ""),
        ("<span><span hidden>LEAKED</span> seen</span>", " seen"), ("<img hidden> seen", " seen"), ("</span> seen", " seen"),
        ("<span hidden><script>x</span></script>LEAKED</span> seen", " seen"), ("<span hidden><a href=x>LEAKED</a></span> seen", " seen"),
    ],
)
def test_hidden_inline_elements_hide_all_they_hold(inner, kept):
    text = "This is one sentence of the main text, and it is long enough to be kept"
    after = "The next block has nothing to do with what was hidden in the one before it."
    # with and without the end tag of the block around it
    for end in ("</p>", ""):
        page = f"<article><p>{text}{inner}{end}<p>{after}</p></article>"
        assert main_text(page) == f"{text}{kept}\n{after}"


def test_deep_pages_take_memory_in_proportion_to_their_tags():
    peaks = []
    for n in (2000, 4000):
        page = "<article>" + "<div>A sentence on each of the levels, which are never closed.</div><div>" * n
        tracemalloc.start()
        assert main_text(page).count("\n") == n - 1
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 2.5 * peaks[0] and peaks[1] < 20_000_000


LONG_TEXT = " ".join(f"word{i}" for i in range(199)) + " end."
SHORT_TEXT = "One of the sentences of the main text, with a dozen words or so."
MENU = '<nav><a href="/">Home</a></nav>'


@pytest.mark.parametrize(
    "page",
    [
        "<div class='main-content has-sidebar'>{}</div>", "<div class='layout with-nav'>{}</div>", "<section class='content social-science'>{}</section>",
        "<div class='layout with-nav'><article>{}</article></div>", "<div class='sidebar'><article>{}</article></div>", "<div id='noSidebar'>{}</div>",
        "<div class='menu-open'><main>{}</main></div>", "<div class='widget'><div role='main'>{}</div></div>", "<form id='aspnetForm'>{}</form>",
        "<form><article>{}</article></form>", "<div class='page has-nav'><form class='content'><main>{}</main></form></div>",
    ],
)
def test_class_words_and_forms_do_not_lose_the_main_text(page):
    text = [LONG_TEXT, SHORT_TEXT, LONG_TEXT]
    inner = "".join(f"<p>{t}</p>" for t in text)
    assert main_text(f"<body>{MENU}{page.format(inner)}<footer>us</footer></body>") == "\n".join(text)


def test_long_text_outweighs_class_words_and_short_text_does_not():
    around = f"<article><p>{SHORT_TEXT}</p>" + f"<p>{LONG_TEXT}</p>" * 3 + "{}</article>"
    kept = "\n".join([SHORT_TEXT] + [LONG_TEXT] * 3)
    for name in ("social", "sidebar", "related-posts", "comments"):
        assert main_text(around.format(f"<div class='{name}'><p>{LONG_TEXT}</p></div>")) == f"{kept}\n{LONG_TEXT}"
        assert main_text(around.format(f"<div class='{name}'><p>{SHORT_TEXT}</p></div>")) == kept
    assert main_text(around.format(f"<form><p>{SHORT_TEXT}</p></form>")) == kept
    talk = "<section id='comments'>" + f"<article class='comment'><p>{SHORT_TEXT}</p></article>" * 100 + "</section>"
    assert main_text(f"{around.format('')}{talk}") == kept


@with_tables
def test_articles_of_all_pages(spark):
    table = spark.read.parquet(f"{ROOT}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in table.collect()}
    rows = extract_text(table).collect()
    assert len(rows) == len(html)
    for row in rows:
        article = html[row["page_id"]].partition("<article>")[2].partition("</article>")[0]
        marked = re.sub("<(/?p|/?h1)>", "\x00", article).replace("<br>", " ")
        blocks = [" ".join(unescape(b).split()) for b in re.sub("<[^>]*(>|$)", "", marked).split("\x00")]
        assert row["text"] == "\n".join(b for b in blocks if b)
        assert row["n_chars"] == len(row["text"])


def test_extraction_of_odd_rows(pages):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, None, "")]
    got = extract_text(pages(rows)).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got) == [("1", len(main_text(PAGE)))] * 2 + [("2", 0), ("None", 0)]
    assert extract_text(pages([])).count() == 0
