"""The style tree of ``pages`` against pages whose main text is known."""

import time

from tissueloom.llm import pages
from tissueloom.llm.pages import Page


def texts(spark, rows):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")
    return [r.text for r in sorted(pages.main_text(df).collect(), key=lambda r: r.page_id)]


def test_text_beside_an_article_stays():
    body = "<div class=content><p>The long main text</div><article class=teaser><p>A card</article>"
    assert Page(body).texts() == ["The long main text", "A card"]


def test_inline_noise_goes_alone():
    share = "<article><p>One</p><button>Share</button><p>Two <span class=ad>Buy</span> three<select><option>x<option>y</select></p>"
    assert Page(share + "<svg><text>icon</text></svg></article>").texts() == ["One", "Two three"]
    assert Page("<p>Text <a class=share><div>x</div></a> goes on<p>End").texts() == ["Text", "goes on", "End"]
    assert Page("<p>one<button>x</button>two").texts() == ["one two"]


def test_repeated_text_goes_from_two_distinct_pages_on(spark):
    notice = "".join(f"<div class=n{k}>A long notice that all pages have, part {k}</div>" for k in range(9))
    page = "<body><p>Short {}</p>" + notice + "</body>"
    rows = [("http://two/", page.format("a")), ("http://two/x", page.format("b"))]
    rows += [(f"http://many/{i}", page.format(i)) for i in range(12)]
    rows += [("http://copies/", "<body><p>The same page</p><p>twice</p></body>")] * 5
    # one page's own text stays, even below a node that mostly repeats
    rows += [(f"http://list/{i}", "<body><ul class=k>" + "".join(f"<li>{k}" for k in range(30)) + f"<li>own {i}</ul></body>") for i in range(3)]
    got = texts(spark, rows)
    assert got[:2] == ["Short a", "Short b"] and got[2:14] == [f"Short {i}" for i in range(12)]
    assert got[14:19] == ["The same page\ntwice"] * 5
    assert [x.splitlines()[-1] for x in got[19:]] == ["own 0", "own 1", "own 2"]


def test_unnamed_notice_is_known_by_its_place(spark):
    rows = [(f"http://plain/{i}", f"<html><body><div>Article {i}</div><div>Same notice</div></body></html>") for i in range(9)]
    rows += [(f"http://inner/{i}", f"<body><div><p>Article {i}</p></div><div><p>Same notice</p></div></body>") for i in range(9)]
    rows += [(f"http://longer/{i}", "<body>" + "".join(f"<p>Part {i}.{k}" for k in range(i + 1)) + "<p>Same notice</body>") for i in range(9)]
    rows += [(f"http://text/{i}", f"<body>Article {i}<div>Box {i}</div>Same notice</body>") for i in range(9)]
    want = [f"Article {i}" for i in range(9)] * 2
    want += ["\n".join(f"Part {i}.{k}" for k in range(i + 1)) for i in range(9)]
    assert texts(spark, rows) == want + [f"Article {i}\nBox {i}" for i in range(9)]


def test_names_do_not_take_the_article(spark):
    text = "<article><h1 class=post-header>Title</h1><p>Text</article>"
    for body in (
        f"<body class=right-sidebar>{text}</body>",
        f"<body class='sidebar header'>{text}</body>",
        f"<html class=no-sidebar><body class=header-fixed>{text}</body></html>",
        f"<body><div id=page class=has-banner>{text}</div></body>",
        f"<body><form id=page><div class=banner role=form>{text}</div></form></body>",
        f"<body><main class=header>{text}</main></body>",
    ):
        assert Page(body).texts() == ["Title", "Text"], body
    assert Page(f"<body><div class='sidebar x'>Side</div>{text}<div role=banner>B</div><form>F</form>").texts() == ["Title", "Text"]
    assert Page("<article>A<section class=comments><article class=comment>C</article></section></article>").texts() == ["A"]
    # importance speaks for a branch with most of a host's text, not for adverts that change
    rows = [(f"http://odd/{i}", f"<body><div class=sidebar><p>Long main text of page number {i}</p><i class=ad>Buy {i}</i></div><div class=ad>Buy {i}!</div></body>") for i in range(6)]
    rows += [("http://copy/", f"<body><p>One page of a host of copies<div class=ad>Buy {i}</div></body>") for i in range(6)]
    rows += [(f"http://same/{i}", f"<body><p>Own {i}</p><div class=sidebar><p>A long text that is the same on all of the pages</p></div></body>") for i in range(6)]
    want = [f"Long main text of page number {i}" for i in range(6)] + ["One page of a host of copies"] * 6
    assert texts(spark, rows) == want + [f"Own {i}" for i in range(6)]


def test_any_depth_in_linear_time():
    for tag in ("<div>", "<span>", "<p><b>", "<div class=ad>", "<form>", "<main>", "<li><ul>"):
        start = time.process_time()
        Page(tag * 100_000 + "text").texts()
        assert time.process_time() - start < 20, tag


def test_text_nodes_are_decoded_one_by_one():
    assert Page("<p>&<b>amp;</b> x &amp;amp; y &am<!-- -->p; z &lt;b&gt;").texts() == ["&amp; x &amp; y &amp; z <b>"]


def test_lone_pages_judge_named_branches_themselves(spark):
    form = "<body><form id=aspnetForm><div class=content><p>The whole article of this page</p></div></form><form>Go</form></body>"
    side = "<body><div class=sidebar><p>A long main text in an oddly named box</p><i class=ad>Buy</i></div><div class=menu>Menu</div></body>"
    rows = [("http://lone/", form), ("http://copies/", side), ("http://copies/2", side), (None, form), ("no host", side)]
    article, box = "The whole article of this page", "A long main text in an oddly named box"
    assert texts(spark, rows) == [article, box, box, article, box]


def test_odd_rows(spark):
    rows = [(None, "http://a/", "<p>x", 1), (1, "http://a/", "<p>x", 2), (1, "http://a/", "<p>x", 2), (2, "", None, 3)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, noise int").selectExpr("*", "1 AS host", "2 AS spared")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in pages.main_text(df).collect())
    assert got == [("1", "x", 1), ("1", "x", 1), ("2", "", 0), ("None", "x", 1)]
