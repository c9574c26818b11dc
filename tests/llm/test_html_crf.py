from html.parser import HTMLParser

import pyarrow.parquet as pq
import itertools

import numpy as np

from quarry.llm import html_crf as X

from .edge import rows_of

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><a href="/">Home of things</a></header><nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use small files to remember you, as everyone does.</p><a href=/ok>Fine</a></div>
<article><h1>A long walk &amp; a short rest</h1><p>The first   paragraph goes on, with a comma,<br>and ends here.</p>
<div class="ad">Buy the new thing today, it is cheap.</div><p><b>Second one is bold.<br><p>The third follows an open one &#233;.</p>
<script>document.write("<p>no</p>")</script><!-- <p>hidden comment</p> --></article>
<aside class="sidebar"><h3>Also read</h3><p>Another story that is not this one, at some length.</p></aside>
<section id="comments"><h3>Replies</h3><div class="comment"><b>Bob</b><p>I liked the first paragraph, it goes on and on.</p></div></section>
<form><label>Name</label><input><button>Send</button></form><footer>&copy; 2024 Things. All rights.</footer></body></html>"""


def test_blocks():
    texts = [b.text for b in X.blocks_of(PAGE)]
    assert "A long walk & a short rest" in texts and "The first paragraph goes on, with a comma, and ends here." in texts
    assert "Second one is bold." in texts and "The third follows an open one é." in texts
    assert not any("hidden comment" in t or "var a" in t or "p{x" in t or "no" == t for t in texts)
    assert X.blocks_of(None) == X.blocks_of("") == [] and [b.text for b in X.blocks_of("bare text & <b>bold")] == ["bare text & bold"]
    assert X.blocks_of("<script>never closed <p>x") == []
    assert [b.text for b in X.blocks_of("<p>a < b and <p>c")] == ["a < b and", "c"]


def test_ancestors_of_a_block():
    """Tags and names of all open elements, after misnested and unopened end tags as well."""
    got = [(b.text, set(b.tags), set(b.names), b.last, b.own) for b in X.blocks_of('<div class="x"><b><i id=y>one</b> two<p class=z>three</i></p><p>four</u></div>five<u class=k><p>six</u> seven')]
    assert got == [
        ("one two", {"div"}, {"x"}, "div", "div"), ("three", {"div", "p"}, {"x", "z"}, "p", "p"), ("four", {"div", "p"}, {"x"}, "p", "p"),
        ("five", {"u"}, {"k"}, "u", "none"), ("six seven", {"p"}, set(), "p", "p"),
    ]


def test_deep_and_broken_markup_is_linear():
    n = 60_000
    for page in ("<div>x" * n, "<b>x" * n + "</b>" * n, "<span>x" * n + "</i>" * n, "<ul><li>x" * n):
        blocks = X.blocks_of(page)
        assert sum(b.text.count("x") for b in blocks) == n
        X.main_text(page, X.default_chain())


def test_main_text_of_a_page():
    assert X.main_text(PAGE, X.default_chain()).split("\n") == ["A long walk & a short rest", "The first paragraph goes on, with a comma, and ends here.", "Second one is bold.", "The third follows an open one é."]


def test_viterbi_is_the_best_sequence():
    chain = X.Chain({"a": 1.3, "b": -0.9, "c": 0.2}, np.array([[0.4, -0.6], [-0.5, 0.8]]))
    for n in range(1, 7):
        for feats in itertools.islice(itertools.product((["a"], ["b"], ["c"], ["b", "c"]), repeat=n), 0, None, 7):
            s = chain.scores(feats)
            best = max(itertools.product((0, 1), repeat=n), key=lambda y: sum(s[i, y[i]] for i in range(n)) + sum(chain.trans[a, b] for a, b in zip(y, y[1:])))
            got = chain.decode(list(feats))
            score = lambda y: sum(s[i, y[i]] for i in range(n)) + sum(chain.trans[a, b] for a, b in zip(y, y[1:]))
            assert abs(score(got) - score(best)) < 1e-9


def test_held_out_accuracy():
    pages = X.labelled_pages(200, seed=99)
    chain = X.default_chain()
    right = total = 0
    for blocks, y in pages:
        got = chain.decode(X.features(blocks))
        right += sum(a == b for a, b in zip(got, y))
        total += len(y)
    assert right / total >= 0.97, right / total


def test_query_rows(spark, sf):
    rows = rows_of(X.op9_html_extraction(spark, sf))
    html = {r["page_id"]: r["html"] for r in X.read(spark, sf, "pages").collect()}
    assert len(rows) == len(html)
    for r in rows:
        inside = html[r["page_id"]].split("<article>")[1].split("</article>")[0]
        assert r["text"] == "\n".join(b.text for b in X.blocks_of(inside)) and r["n_chars"] == len(r["text"])


def test_edges(spark):
    df = spark.createDataFrame([(1, "u", None, "kept"), (2, None, "", "kept"), (3, "u", PAGE, "kept"), (3, "u", PAGE, "kept"), (4, "u", "<p>" + "word " * 50000, "kept"), (5, "u", "<<<>>> </ <a", "kept")], "page_id bigint, url string, html string, n_chars string")
    out = X.extract(df)
    got = rows_of(out)
    assert out.columns == ["page_id", "url", "html", "n_chars", "text"] and all(r["n_chars"] == "kept" for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert len({r["text"] for r in got if r["page_id"] == 3}) == 1
    assert X.extract(df.limit(0)).count() == 0


def test_head_that_is_not_closed():
    """HTML lets </head> be left out: the same blocks as with it."""
    head, body = "<html><head><meta charset=utf-8><title>t</title><style>x{}</style><link rel=x>", "<p>one</p><div class=a>two<br>three</div>"
    want = ["one", "two three"]
    for page in (head + "<body>" + body, head + body, head + "\n\n  <body>" + body + "</body></html>", head + "<noframes>no</noframes><body>" + body, "<head><head><title>t</title>" + body, head + "</head><head>" + body):
        assert [b.text for b in X.blocks_of(page)] == want, page
    assert [(b.text, set(b.tags)) for b in X.blocks_of("<html><head><title>t</title><body><p>text")] == [("text", {"html", "body", "p"})]
    for page in (head + "text", head + "<b>text", head + "<img src=x>text", head + "<br>text", head + "</body>text", head + "<my-box>text"):
        assert [b.text for b in X.blocks_of(page)] == ["text"], page
    assert X.blocks_of(head) == X.blocks_of(head + "</head><body>") == []
    open_head = PAGE.replace("</head>", "")
    assert X.main_text(open_head, X.default_chain()) == X.main_text(open_head.replace("<body>", ""), X.default_chain()) == X.main_text(PAGE, X.default_chain()) != ""


def texts(page):
    return [b.text for b in X.blocks_of(page)]


def test_stray_quotes_and_comments_lose_no_text():
    p = '<p>See <a href="x"">the linked page</a> for more details on it.</p><p class="z">A middle para</p>'
    assert texts(p) == ["See the linked page for more details on it.", "A middle para"]
    assert texts("<p title='it's'>one</p><p class='q'>two</p>") == ["one", "two"]
    assert texts('<p "x>one</p><p y">two</p>') == ["one", "two"]
    assert texts('<p class=">">one</p>') == ["one"]
    assert texts("<p data-x=a'b>one</p><p>it's</p>") == ["one", "it's"]
    assert texts('<p class="open>one</p>') == ["one"]  # a quote that never closes
    assert texts("<p class=>one</p><p =x>two</p><p a = 'b c' >three</p>") == ["one", "two", "three"]
    assert texts("a<!-->b<!--->c<!-- > x -->d<!-- y --!>e") == ["abcde"]
    assert texts("<br/>a<hr/>b<img alt='>'/>c") == ["a", "bc"]


def test_formulas_are_text():
    assert texts("<p>The law <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation>E=m</annotation></math> holds</p>") == ["The law E=m holds"]


class Plain(HTMLParser):
    """Visible text by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.deep, self.out = [], []

    def handle_starttag(self, tag, attrs):
        if tag in X.HIDDEN | {"svg", "noscript"} and tag not in X.VOID:
            self.deep.append(tag)

    def handle_endtag(self, tag):
        if tag in self.deep:
            del self.deep[len(self.deep) - 1 - self.deep[::-1].index(tag) :]

    def handle_data(self, data):
        if not self.deep:
            self.out.append(data)


def test_blocks_hold_what_an_independent_parser_reads():
    """All text of every page of the table, white space apart."""
    for page in pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["html"]).column("html").to_pylist():
        plain = Plain()
        plain.feed(page or "")
        plain.close()
        assert "".join("".join(texts(page)).split()) == "".join("".join(plain.out).split())
