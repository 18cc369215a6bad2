"""Main-text extraction: parsing traps, held-out labelled pages, odd rows."""

from scribal.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News today</a></li></ul></nav><!-- ad <p>7</p> -->
<div class="ad">Buy these things now, they are cheap.</div><div id="cookie-notice"><p>We use cookies on this site.</p></div>
<article><h1>A title of some words &amp; more</h1><p title="a > b">First <b>bo</b>ld para&shy;graph, with
 several   words &copy &eacute;t&eacute; in it.<br>A next line.<p>Second paragraph is longer and says more than the first one did.
<aside>Related reading for you</aside><p>Third one ends here.</p><section class="comments"><h3>Comments</h3>
<div class="comment"><p>I do not agree with a single word of this long article, sorry.</p></div></section></article>
<aside class="sidebar"><p>Most read stories of the week, in our own words.</p></aside>
<form><label>Your mail address</label><button>Send</button></form>
<footer>&copy; example.com &middot; All rights reserved by the people named here.</footer>"""
TEXT = ("A title of some words & more First bold para\xadgraph, with several words © été in it. A next line. "
        "Second paragraph is longer and says more than the first one did. Third one ends here.")


def test_parts_of_a_page():
    assert H.default_model().text(PAGE) == TEXT


def test_parsing_traps():
    def texts(page):
        return [b.text for b in H.leaf_blocks(page)]

    assert texts("<p>a<p>b<div>c</div>d") == ["a", "b", "c", "d"]
    assert texts('<p class="x>y">a</p><!-- never closed <p>b') == ["a"]
    assert texts("<script>if (a</b) '<p>'</SCRIPT>a<style>p") == ["a"]
    assert texts("1 < 2 &lt;b&gt; &am") == ["1 < 2 <b> &am"]
    assert texts("<p>cut off <b>here</b><a hre") == ["cut off here"]
    assert texts("<ul><li>a<li>b</ul><td>c") == ["a", "b", "c"]
    assert texts("<p>x</p>" * 5000) == ["x"] * 5000
    assert texts('<p a="' + "x" * 100_000) == []


def test_held_out_pages():
    model = H.default_model()
    wrong = total = 0
    for page, label in H.labelled_pages(150, seed=99):
        blocks = H.leaf_blocks(page)
        wrong += sum(a != label(b.text) for a, b in zip(model.labels(blocks), blocks))
        total += len(blocks)
    assert wrong / total < 0.01


def test_frame(frame):
    rows = [(1, "u", PAGE, 5), (1, "u", PAGE, 5), (2, "v", None, 6), (3, None, "", 7), (None, "w", "<nav><a>x</a></nav>", 8)]
    pages = frame(rows, "page_id long, url string, html string, n_chars long")
    out = sorted((str(r.page_id), r.text) for r in H.extract(pages).collect())
    assert out == [("1", TEXT), ("1", TEXT), ("2", ""), ("3", ""), ("None", "")]
    assert H.extract(frame([], "page_id long, url string, html string")).count() == 0


def test_other_layouts():
    text = H.default_model().text
    plain = ("<body><div id='top-menu'><a href=1>Home</a></div><div class='post-content'><h1>Great title here</h1><p>Some real "
             "text of the page that goes on for a while, with commas.</p></div><div class='related-posts'><h3>Related</h3><ul><li>"
             "<a href=3>Other story</a></li></ul></div><div id='comments'><p>Nice post, thanks a lot for writing this down!</p></div>")
    assert text(plain) == "Great title here Some real text of the page that goes on for a while, with commas."
    nested = ("<body><header><h1>Site name</h1><nav><a href=1>x</a></nav></header><main><article><header><h1>The headline</h1></header>"
              "<p>Body text one is here.</p><ul><li>First point</li></ul><div class='newsletter-signup'><p>Subscribe to our letter now.</p>"
              "</div><p>Body text two.</p></article></main><aside><h2>Popular</h2><p>Teaser text</p></aside>")
    assert text(nested) == "The headline Body text one is here. First point Body text two."
    short = ("<body><div role='alert'>This site uses cookies to improve things.</div><article><p>Just one paragraph.</p></article>"
             "<form><p>Leave your name and address for us here, please do so now.</p><input></form></body>")
    assert text(short) == "Just one paragraph."


def test_formulas_drawings_and_objects_are_text():
    page = ("<p>Energy is <math><mi>E</mi><mo>=</mo><mn>1</mn></math> as shown</p><p>see <svg><text>label</text></svg> here</p>"
            "<p>a <object data='x'>fallback <b>bold</b></object> b</p><p>z<script>var a</script><style>p{}</style> y</p>")
    assert [b.text for b in H.leaf_blocks(page)] == ["Energy is E=1 as shown", "see label here", "a fallback bold b", "z y"]


def test_many_unclosed_raw_elements_take_linear_time():
    import time

    begin = time.perf_counter()
    H.leaf_blocks("<iframe>x " * 20_000)
    assert time.perf_counter() - begin < 5
