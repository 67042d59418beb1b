"""HTML extraction and WARC in ZIP."""

from __future__ import annotations

import base64
import hashlib
import html
import io
import re
import struct
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from compare import TABLES_DIR
from isobar.llm import html_density, queries, wacz
from isobar.llm.common import table

PAGES = "page_id long, url string, html string"


def test_articles_of_the_tables(spark):
    pages = {r.page_id: r.html for r in table(spark, TABLES_DIR, "pages").collect()}
    found = queries.op7_text_density(spark, TABLES_DIR).collect()
    assert len(found) == len(pages)
    for r in found:
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        text = html.unescape(re.sub(r"</?b>", "", re.sub(r"<(/?(p|h1|br))>", " ", inside)))
        assert r.text == " ".join(text.split()) and r.n_chars == len(r.text)


@pytest.mark.parametrize("page, text", [
    ("", ""), ("just text", "just text"), ("<nav><a href=x>x</a></nav>", ""), ("<p>a&amp;b &eacute;&#33;\n  c<p>d", "a&b é! c d"),
    ("<body><div id=menu><a>A</a></div><div class=content><h1>T</h1><p>Some long paragraph of text.</p><p>And <i>an</i>other one.</p>"
     "</div><div class=comments><p>A comment that is longer than all the rest of this page, really.</p></div></body>",
     "T Some long paragraph of text. And another one."),
    ("<main><section><p>one one one one</p><p>x x x</p></section><section><p>two two two two</p></section></main>"
     "<div class=cookie-notice>We use cookies</div>", "one one one one x x x two two two two"),
    ("<article><header><h1>Title</h1></header><p>Text<form>name</form> more</p><aside>side</aside><script>x<1</script></article>",
     "Title Text more"),
    ("<main><table><tr><td>a<td>b<tr><td>c</table><ul><li>x<li>y</ul></main>", "a b c x y"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<article><p>cut sh", "cut sh"),
])
def test_shapes_of_pages(page, text):
    assert html_density.main_text(page) == text


STORY = "<h1>Title</h1><p>First paragraph of some length here.</p><p>Second paragraph, also long.</p>"
STORY_TEXT = "Title First paragraph of some length here. Second paragraph, also long."


@pytest.mark.parametrize("name", [
    "layout has-sidebar", "no-sidebar", "ad-free", "menu-open", "share-enabled", "sidebar", "page-header", "comments"])
@pytest.mark.parametrize("inner", [
    f"<article>{STORY}</article>", f"<main>{STORY}</main>", STORY, STORY.replace("h1", "h2")])
def test_a_wrapper_keeps_its_article(name, inner):
    page = "<body><nav><a>Home</a></nav>{}<div class=ad>Buy</div><footer>foot</footer></body>"
    for wrapped in (f"<div class='{name}'>{inner}</div>", f"<div id=a><div id='{name.split()[-1]}'>{inner}</div></div>",
                    f"<form action=x><input name=y><div class='{name}'>{inner}</div><div class=login>Sign in</div></form>"):
        assert html_density.main_text(page.format(wrapped)) == STORY_TEXT


@pytest.mark.parametrize("page, text", [
    ("<article><div class='article-header'><h1>Title</h1></div><p>Text</p></article>", "Title Text"),
    ("<article><div class='header'><h1>Title</h1></div><p>Text</p></article>", "Title Text"),
    (f"<body><nav><a>Home</a><div>{STORY}</div></body>", STORY_TEXT),  # never closed
    (f"<article>{STORY}<div class=comment-list><article>{'A reply. ' * 40}</article></div></article>", STORY_TEXT),
    (f"<article>{STORY}</article><div class=cookie-notice>{'We use cookies. ' * 40}</div>", STORY_TEXT),
    (f"<main>{STORY}<aside><article>A teaser</article></aside><form>name</form><div class=relatedPosts>More</div></main>", STORY_TEXT),
])
def test_boilerplate_beside_an_article_goes(page, text):
    assert html_density.main_text(page) == text


LONG = "".join(f"<p>Paragraph {i} of the story, with enough words in it to be dense.</p>" for i in range(6))
LONG_TEXT = " ".join(f"Paragraph {i} of the story, with enough words in it to be dense." for i in range(6))


@pytest.mark.parametrize("page, text", [
    (f"<div id=text><p>An intro.</p><div>{LONG}</div><ul><li>one<li>two</ul><blockquote>Quoted.</blockquote>"
     "<table><tr><td>a<td>b</table><pre>code</pre><figure><figcaption>Seen</figcaption></figure></div>",
     f"An intro. {LONG_TEXT} one two Quoted. a b code Seen"),
    (f"<div>Bare <b>te</b>xt, then<div>{LONG}</div>and more <a href=x>of</a> it</div>", f"Bare text, then {LONG_TEXT} and more of it"),
    (f"<div><div class=meta><h1>Title</h1></div><div><p>Lead of the story.</p><div><div>{LONG}</div></div></div><p>End.</p></div>",
     f"Title Lead of the story. {LONG_TEXT} End."),
    (f"<div><section>{'A dense section of another tag. ' * 9}</section><div>{LONG}</div></div>",
     f"{('A dense section of another tag. ' * 9).strip()} {LONG_TEXT}"),
    (f"<div><a href=a>Home</a> | <a href=b>News</a><div>{LONG}</div><ul><li><a href=c>Older</a><li><a href=d>Newer</a></ul></div>",
     LONG_TEXT),
])
@pytest.mark.parametrize("frame", ["{}", "<html><head><title>T</title></head><body><nav><a>x</a></nav>{}</body></html>", "<title>T</title>{}"])
def test_text_around_the_densest_node_stays(frame, page, text):
    assert html_density.main_text(frame.format(page)) == text


@pytest.mark.parametrize("broken", ["<b>" * 100_000 + "</i>" * 100_000, "<p>" + "<b>" * 1000 + "</p>" * 100_000 + "<hr>" * 100_000])
def test_broken_markup_takes_linear_time(broken):
    started = time.process_time()
    assert html_density.main_text(f"<body>{broken}<p>{'text ' * 50}</p></body>") == ("text " * 50).strip()
    assert time.process_time() - started < 20


def test_density_chooses_among_parts_without_landmarks(monkeypatch):
    """Two like sections; with a constant density there would be nothing to choose them by."""
    short = "".join(f"<div><a href={i}>Item {i}</a><span>x</span></div>" for i in range(30))
    page = f"<body><div id=a>{short}</div><div id=b>{''.join(f'<div>{p}</div>' for p in LONG.split('</p>') if p)}</div></body>"
    assert html_density.main_text(page) == LONG_TEXT
    measure = html_density._measure

    def constant(nodes):
        measure(nodes)
        for node in nodes:
            node.density = float(not node.dropped and node.chars > 0)
        for node in nodes:
            node.total = sum(c.density for c in node.parts if isinstance(c, html_density.Node))

    monkeypatch.setattr(html_density, "_measure", constant)
    assert html_density.main_text(page) != LONG_TEXT


def test_extraction_of_odd_rows(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>x</p>"), (2, "u", "<p>x</p>"), (3, "u", "<p>" + "long " * 50_000 + "</p>")]
    pages = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit(1)).withColumn("n_chars", F.lit("mine"))
    found = html_density.extract(pages).collect()
    assert sorted(r.n_chars for r in found) == [0, 0, 1, 1, 249_999]
    assert html_density.extract(pages.limit(0)).count() == 0


def brute(rows, least=0):
    groups = {}
    for i, h in rows:
        groups.setdefault((h or "").encode(), []).append(i)
    for payload, ids in groups.items():
        known = [i for i in ids if i is not None]
        for i in ids:
            top = max(known) if known and len(ids) > 1 and len(payload) >= least else None
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            revisit = top is not None and i != top
            yield i, len(payload), digest, "revisit" if revisit else "response", top if revisit else None


@pytest.mark.parametrize("least, limit", [(0, wacz.ARCHIVE_BYTES), (3, 700)])
def test_round_trip(spark, tmp_path, least, limit):
    rows = [(i, "<p>é漢 %d</p>" % (i % 7)) for i in range(40)] + [(50, None), (51, ""), (None, "<p>é漢 1</p>"), (60, "ab"), (61, "ab"),
            (70, "once"), (70, "once"), (80, "x\r\n\r\ny" * 5000)]
    pages = spark.createDataFrame([(i, f"http://a/{i}\r\nb", h) for i, h in rows], PAGES).withColumn("payload", F.lit(1)).repartition(3)
    archives = wacz.write_archives(pages, str(tmp_path), least, limit)
    found = wacz.read_archives(archives).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=repr) == sorted(brute(rows, least), key=repr)
    by_payload = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, h in rows}
    assert all(hashlib.sha1(r.payload).hexdigest() in by_payload for r in found if r.record_type == "response")
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    with zipfile.ZipFile(archives.first().archive) as package:  # another reader agrees on the package
        assert package.namelist() == [wacz.DATA, wacz.INDEX] and package.testzip() is None
    assert wacz.round_trip(pages.limit(0)).count() == 0


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_zip64_directory_and_broken_archives():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as package:
        package.writestr("a", b"first")
        package.writestr("b", b"second")
    plain = raw.getvalue()
    # The same directory, described by a ZIP64 end record.
    end = plain.rindex(wacz.END)
    count, size, offset = struct.unpack("<HII", plain[end + 10 : end + 20])
    end64 = wacz.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, count, count, size, offset)
    locator = wacz.LOCATOR64 + struct.pack("<IQI", 0, end, 1)
    wide = plain[:end] + end64 + locator + wacz.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    for content in (plain, wide, plain[:end] + plain[end:-2] + b"\x05\x00hello"):
        found = wacz.members(Source(content), len(content))
        assert {n: content[m.start : m.start + m.size] for n, m in found.items()} == {"a": b"first", "b": b"second"}
    for broken in (plain[:-30], b"", b"PK"):
        with pytest.raises(ValueError):
            wacz.members(Source(broken), len(broken))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as package:
        package.writestr("a", b"x" * 1000)
    with pytest.raises(ValueError, match="compressed"):
        wacz.members(Source(packed.getvalue()), len(packed.getvalue()))


def test_a_changed_payload_is_noticed():
    raw = wacz.record(1, "http://a", b"payload", None, False, "u")
    assert wacz.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError, match="digest"):
        wacz.parse(raw.replace(b"payload\r\n", b"pAyload\r\n"))
