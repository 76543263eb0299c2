from ledgerlens.llm import htmltext

SENTENCE = "This is a sentence with several words, and it goes on for a while. "


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_furniture_goes_and_the_article_stays():
    body = f"""<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, many of them.</div>
    <div class="ad">Buy now, it is cheap.</div><article><h1>Head &amp; line</h1><p>First   {SENTENCE}</p><p><b>Second &#233;&eacute;<br>line.<br><p>Third <a href="x">link</a> end.</p>
    <ul><li>one<li>two</ul><script>var t="</p>";</script><div class="comments"><p>{SENTENCE * 9}</p></div></article><aside>Side {SENTENCE}</aside>
    <form><label>Name</label></form><footer>&copy; me</footer>"""
    assert htmltext.main_text(page(body)).split("\n\n") == [
        "Head & line", "First " + SENTENCE.strip(), "Second éé line.", "Third link end.", "one", "two"]


def test_without_an_article_the_ratios_choose():
    links = "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(30))
    body = f'<div id="top"><ul>{links}</ul></div><div id="text">' + "".join(f"<p>{i} {SENTENCE * 3}</p>" for i in range(8)) + "</div><div id='end'><span>x</span></div>"
    assert htmltext.main_text(page(body)).split("\n\n") == [f"{i} {(SENTENCE * 3).strip()}" for i in range(8)]


def test_nothing_of_the_content_is_dropped_or_capped():
    paras = [f"w{i}" if i % 7 else SENTENCE.strip() * 40 for i in range(600)]
    body = "<article>" + "".join(f"<p>{p}</p>" for p in paras) + "</article>"
    assert htmltext.main_text(page(body)).split("\n\n") == paras


def test_odd_pages():
    assert htmltext.main_text(None) == htmltext.main_text("") == htmltext.main_text("<html><body></body></html>") == ""
    assert htmltext.main_text("plain text, no tags.") == "plain text, no tags."
    assert htmltext.main_text("<article><p>cut off in the mid") == "cut off in the mid"
    assert htmltext.main_text("<p>a < b and c > d, yes.</p>") == "a < b and c > d, yes."
    assert htmltext.main_text("<!-- c --><p>x.<![CDATA[y]]></p><!-- open") == "x.y"
    assert htmltext.main_text("<article>" + "<div>" * 3000 + "deep text." + "</div>" * 3000) == "deep text."
    assert htmltext.main_text("<p title='a>b\">q.</p>") != None


LONG = ["This, that; and: the other, so it goes, on and on. " * 30 + str(i) for i in range(4)]
PARTS = "<ul><li>one</li><li>two</li></ul><table><tr><td>a</td><td>b</td></tr></table><blockquote><p>Said so.</p></blockquote><figure><figcaption>Seen.</figcaption></figure>"
TEXT = LONG[:2] + ["one", "two", "a", "b", "Said so.", "Seen."] + LONG[2:]


def long_page(around):
    body = "".join(f"<p>{p}</p>" for p in LONG[:2]) + PARTS + "".join(f"<p>{p}</p>" for p in LONG[2:])
    return page(around.format(body))


def test_short_parts_of_a_long_article_stay():
    links = "<ul><li><a href='/'>Home</a></li><li><a href='/x'>X</a></li></ul>"
    for around in ("<article>{}</article>", "<main><div>{}</div></main>", links + "<div id='text'>{}</div>", links + "{}", "<div><section>{}</section></div><div>x</div>"):
        assert htmltext.main_text(long_page(around)).split("\n\n") == TEXT, around


def test_a_missing_end_tag_does_not_empty_the_page():
    for body in ("<html><head><title>t</title><body><article><p>Text.</p></article>", "<head><meta charset=x><article><p>Text.</p></article>",
                 "<body><div><button>Go</div><article><p>Text.</p></article>", "<body><button>Go<article><p>Text.</p></article><button>No</button>",
                 "<body><noscript>Go<article><p>Text.</p></article>", "<body><select><option>a<article><p>Text.</p></article>",
                 "<body><object data=x><div></div><article><p>Text.</p></article>", "<title>open<body><article><p>Text.</p></article>"):
        assert htmltext.main_text(body) == "Text.", body
    assert htmltext.main_text("<article><p>a</p><object><p>x</p><object>y</object>z</object><button><b>q</b></button><p>b</p></article>") == "a\n\nb"


def test_a_wrapper_named_for_furniture_holds_the_page():
    side = "<div class='sidebar'><p>Side.</p></div><div class='comments'><article class='comment'><p>" + SENTENCE * 99 + "</p></article></div>"
    for name in ("has-sidebar", "no-sidebar", "elementor-widget", "page-with-header", "sidebar"):
        for around in ("<article>{}</article>", "<main>{}</main>"):
            assert htmltext.main_text(long_page(f"<p>Top.</p><div class='{name}'>{around}{side}</div>")).split("\n\n") == TEXT, (name, around)
        assert htmltext.main_text(long_page(f"<div class='{name}'><div>{{}}</div></div>")).split("\n\n") == TEXT, name
    assert htmltext.main_text(long_page("<form><div>{}</div></form>")).split("\n\n") == TEXT
    assert htmltext.main_text(page("<div class='widget'><p>Short.</p></div><div><p>" + LONG[0] + "</p></div>")) == LONG[0]


def test_query_shape(spark):
    rows = [(1, "u", page(f"<article><p>{SENTENCE}</p></article>"), "t"), (2, None, None, "t"), (2, None, None, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, extra string")
    got = htmltext.with_main_text(df)
    assert got.columns == ["page_id", "url", "extra", "text"]
    assert sorted((r.page_id, r.text) for r in got.collect()) == [(1, SENTENCE.strip()), (2, ""), (2, "")]
    assert htmltext.with_main_text(df.limit(0)).count() == 0


def given_pages():
    import duckdb
    return [r[0] for r in duckdb.connect().execute("SELECT html FROM '/root/testdata/sf0.1/pages.parquet'").fetchall()]


def test_the_ratios_find_the_article_without_marks_and_classes():
    """On the given pages the paths alone choose nearly the same text as with the evidence."""
    import re
    pages = given_pages()
    bare = [re.sub(r'\s(class|id|role)="[^"]*"', "", re.sub(r"</?(article|main)>", "", p)) for p in pages]
    same = sum(htmltext.main_text(p) == htmltext.main_text(b) for p, b in zip(pages, bare))
    assert same >= 0.95 * len(pages)


def test_a_mark_on_a_teaser_does_not_hide_the_text():
    body = "<article><p>Read on.</p></article><div>" + "".join(f"<p>{i} {SENTENCE * 30}</p>" for i in range(20)) + "</div>"
    assert len(htmltext.main_text(page(body)).split("\n\n")) == 20


def test_ratios_equal_a_plain_sum():
    import math
    found = htmltext.blocks(page(f"<div id=a><p>One, two.</p><p>Three <a href=x>four!</a></p><ul><li>{SENTENCE}</li></ul></div><div id=b><a href=y>all, linked.</a></div>"))
    raw, smooth = htmltext.ratios(found)
    paths = list(dict.fromkeys(b[0] for b in found))
    for p in paths:
        own = [b for b in found if b[0] == p]
        chars = sum(len(t) - k for _, _, t, k, _ in own)
        marks = sum(sum(t.count(c) for c in ".,;:!?") * (1 - k / len(t)) for _, _, t, k, _ in own)
        assert raw[p] == math.sqrt(chars * (1 + marks))
    for p in paths:
        near = [q for q in paths if htmltext.home(q) == htmltext.home(p)]
        weight = {q: sum(len(t) - k for r, _, t, k, _ in found if r == q) for q in near}
        mean = sum(raw[q] * weight[q] for q in near) / sum(weight.values()) if any(weight.values()) else 0
        assert abs(smooth[p] - ((raw[p] + mean) / 2 if weight[p] else 0)) < 1e-9


def test_a_column_named_as_the_result_is_replaced(spark):
    df = spark.createDataFrame([(1, "<p>New text.</p>", "old")], "page_id long, html string, text string")
    assert [tuple(r) for r in htmltext.with_main_text(df).collect()] == [(1, "New text.")]
