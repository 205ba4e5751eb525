import os
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from haze.llm import html_extract as H  # noqa: E402

SCHEMA = "page_id long, url string, html string"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad <p>no</p> --><div class="ad">Buy.</div>
<div class="cookie-notice">We use cookies</div><article class="post post-17"><h1>Head &amp; line</h1><p><b>First  para
with&nbsp;space.<br><p>Second <i>one</i>, caf&eacute; &#233; &lt;tag&gt;</p><form><input value="x"><p>Sign up</p></form>
<ul><li>item 1<li>item 2</ul><aside>side</aside><table><tr><td>cell a<td>cell b</table></article>
<section id="comments"><p>I am a reader with a very long comment that goes on and on and on, much longer than the article itself,
and so on and on.</p></section><footer>&copy; foot</footer></body></html>"""
TEXT = "Head & line\nFirst para with space.\nSecond one, café é <tag>\nitem 1\nitem 2\ncell a\ncell b"


def _texts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("paths", F.lit(1)).withColumn("host", F.lit("h"))
    return {r.page_id: r.text for r in H.extract(df).collect()}


def test_page_without_boilerplate(spark):
    assert _texts(spark, [(1, "http://a.b/1", PAGE)]) == {1: TEXT}


def test_cut_off_markup_and_odd_pages(spark):
    rows = [(1, "http://a.b/1", PAGE[:PAGE.index("<ul><li>item")]), (2, None, None), (3, "nonsense", ""), (4, "http://a.b/2", "just text"),
            (5, "http://a.b/2", "<p>un<b>closed"), (6, "http://a.b/2", "<div><p>x</p><p"), (7, "u", "<script>never ends"),
            (8, "u", "a <" + "b " * 50_000), (9, "u", "<p>" * 20_000 + "deep"), (9, "u", "<p>dup</p>"), (9, "u", "<p>dup</p>"), (10, "u", "1 < 2 & 3 > 2")]
    got = H.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[1] == "Head & line\nFirst para with space.\nSecond one, café é <tag>"
    assert (text[2], text[3], text[4], text[5], text[6], text[7]) == ("", "", "just text", "unclosed", "x", "")
    assert text[10] == "1 < 2 & 3 > 2"
    assert all(r.n_chars == len(r.text) for r in got)


def test_hosts_vote_for_the_container(spark):
    """A page whose own best container is a long promotion follows its host's path."""
    page = "<body><div class='story-{i}'><p>{body}</p><p>{body}</p></div><div class='zone'><p>{zone}</p></div></body>"
    rows = [(i, f"https://News.example/{i}", page.format(i=i, body=f"story {i} " * 30, zone="x")) for i in range(20)]
    rows.append((99, "https://news.example/99", page.format(i=99, body="short story", zone="promotion " * 200)))
    got = _texts(spark, rows)
    assert got[99] == "short story\nshort story"
    best = H.host_paths(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.host for r in best] == ["news.example"] and best[0].paths[0].endswith("div.story-")


def test_empty_table(spark):
    assert H.extract(spark.createDataFrame([], SCHEMA)).count() == 0


LONG = "a long sentence of the story " * 40


def _text(page):
    return H.Page(page).text().replace(LONG.strip(), "LONG")


def test_heading_and_lead_outside_the_inner_container(spark):
    """On every page of a host, also where the part outside is the larger one."""
    page = "<body><nav>n</nav><article><h1>Head</h1><p class='lead'>{lead}</p><div class='content'><p>{body}</p></div></article><div>promo</div></body>"
    rows = [(i, f"http://a.b/{i}", page.format(lead="Lead", body=LONG)) for i in range(40)] + [(99, "http://a.b/99", page.format(lead=LONG, body="short"))]
    got = _texts(spark, rows)
    assert got[0] == f"Head\nLead\n{LONG.strip()}" and got[99] == f"Head\n{LONG.strip()}\nshort"


def test_climbing_to_the_whole_article():
    assert _text(f"<body><article><p>intro</p><table><tr><td>{LONG}</table></article><div>promo</div></body>") == "intro\nLONG"
    assert _text(f"<body><main><div><h1>Head</h1></div><div><div>{LONG}</div></div></main></body>") == "Head\nLONG"
    assert _text(f"<body><nav>n</nav><div><h1>Head</h1><p>Lead</p><div>{LONG}</div></div><div>promo</div></body>") == "Head\nLead\nLONG"
    assert _text(f"<body><div><h1>Head</h1><p>Lead</p><div>{LONG}</div><div>promo</div></div></body>") == "Head\nLead\nLONG"
    assert _text(f"<body><p>intro</p><div>{LONG}</div></body>") == "intro\nLONG"


def test_boxes_around_the_article_are_not_left_out():
    for box in ("div class='content has-sidebar'", "main class='site-main no-comments'", "div class='elementor-widget-text-editor'",
                "div class='post category-search'", "div class='sidebar'", "form id='aspnetForm'", "div role='search'"):
        end = box.split()[0]
        assert _text(f"<body><{box}><article><p>{LONG}</p></article></{end}><div class='ad'>Buy</div></body>") == "LONG", box
        assert _text(f"<body><{box}><p>{LONG}</p></{end}><div class='ad'>Buy</div></body>") == "LONG", box
    parts = "".join(f"<div class='elementor-widget-text-editor'><p>part {i}</p></div>" for i in range(3))
    assert _text(f"<body><div>{parts}</div></body>") == "part 0\npart 1\npart 2"
    assert _text(f"<body><article class='widget'><p>{LONG}</p></article></body>") == "LONG"
    assert _text("<p>a <span class='ad'>x</span>b") == "a b"


def test_boxes_beside_the_article_are_left_out():
    for name in ("cookie-notice", "ad", "site-footer", "comments-area", "sidebar-left", "share-buttons", "related-posts", "main-menu", "widget_text"):
        assert _text(f"<body><article><p>{LONG}</p><div class='x {name}'><p>no</p></div></article></body>") == "LONG", name
    comments = "<article class='comment'>I agree</article>" * 9
    assert _text(f"<body><main><p>{LONG}</p><section id='comments'>{comments}</section></main></body>") == "LONG"


def test_self_closing_elements_end_at_their_own_tag():
    assert _text("<body><p>one</p><svg width='1'/><p>two</p><math/><iframe src='x' /><p>three</p></body>") == "one\ntwo\nthree"
    assert _text("<p>one</p><svg/><p>two</p><svg><text>no</text></svg><iframe src='x' />no</iframe><p>three</p>") == "one\ntwo\nthree"


def test_marked_elements_nested_deeply():
    assert _text("<div class='ad'>" * 20_000 + "x") == "x"


def test_host_with_two_templates(spark):
    """Unmarked promotions stay out on both, and on a page of neither."""
    zone = "<div class='zone'><p>promotion of something</p></div>"
    one = f"<body>{zone}<div class='wrap'><article><p>{{0}}</p></article></div></body>"
    two = f"<body><div class='story'><p>{{0}}</p><p>{{0}}</p></div>{zone}</body>"
    rows = [(i, f"http://h/{i}", (one, two)[i % 2].format(LONG)) for i in range(40)] + [(90, "http://h/90", one.format("short")), (91, "http://h/91", two.format("short"))]
    rows += [(92, "http://h/92", f"<body>{zone}<section class='other'><p>{LONG}</p></section></body>")]
    got = _texts(spark, rows)
    assert {got[i] for i in range(0, 40, 2)} == {LONG.strip()} and {got[i] for i in range(1, 40, 2)} == {f"{LONG.strip()}\n{LONG.strip()}"}
    assert got[90] == "short" and got[91] == "short\nshort" and got[92] == LONG.strip()
    best = H.host_paths(spark.createDataFrame(rows, SCHEMA)).first().paths
    assert best[0].endswith("article") and best[1].endswith("div.story")


def test_comments_and_notices_longer_than_the_article_are_left_out():
    short = "<p>A short article.</p>"
    for name in ("comments", "cookie-notice", "comments-list", "related-posts", "promo"):
        assert _text(f"<body><div class='post'>{short}</div><div class='{name}'><p>{LONG * 10}</p></div></body>") == "A short article.", name
        assert _text(f"<body><div class='post'>{short}</div><div class='{name}'><h1>Big</h1><p>{LONG * 10}</p></div></body>") == "A short article.", name
        assert _text(f"<article>{short}<section class='{name}'><article>{LONG}</article></section></article>") == "A short article.", name
        assert _text(f"<article><div class=entry-content>{short}</div><div id='{name}'>{LONG}</div></article>") == "A short article.", name
    assert _text(f"<body><div class='post'>{short}</div><div class='sidebar'><p>{LONG * 10}</p></div></body>") == "A short article."
    assert _text(f"<body><div class='comments'><p>{LONG}</p></div></body>") == ""


def test_deep_markup_takes_linear_time():
    depth = 100_000
    start = time.time()
    assert _text("<div>" * depth + "<p>x</p>" + "</div>" * depth) == "x"
    assert _text("<div class='comments'>" * depth + "x") == ""
    assert _text("<blockquote>" * depth + "x" + "</i>" * depth) == "x"
    assert time.time() - start < 60
    boxes = "<div class='sidebar'>" * 40
    assert _text(f"<body>{boxes}<main><p>{LONG}</p><div class='ad'>Buy</div></main></body>") == "LONG"


def test_links_and_headings_are_seen_at_any_depth():
    deep = "<span><b><i><u><em>"
    page = H.Page(f"<body><div><a href='/'>{deep}linked</a></div><h1>{deep}Head</h1></body>")
    assert page.blocks == ["linked", "Head"] and page.unlinked == [0, 4] and page.headings == {1}
