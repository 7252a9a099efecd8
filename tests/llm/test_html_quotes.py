import pytest

from openends.llm import html_text, quotes

LONG = "a paragraph of many words that go on and on, as the text of an article does. " * 3

PAGES = {
    "plain": ("<p>only a paragraph", "only a paragraph"),
    "bold": ("<b>bold", "bold"),
    "no markup": ("plain text\n with  spaces", "plain text with spaces"),
    "script": ('<script>var a="<p>x</p>"', ""),
    "entities": ("<p>&#x41;&#66;&nbsp;&amp;&lt; &eacute;</p>", "AB &< é"),
    "quoted bracket": ("<p title='a>b'>hello</p><img alt=\"x>y\">", "hello"),
    "comment": ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"),
    "blocks": ("<div><div>a</div>b<span> c</span></div>", "a\n\nb c"),
    "lists": ("<main><h2>A</h2><ul><li>one<li>two</ul></main>", "A\n\none\n\ntwo"),
    "table": ("<table><tr><td>one cell<td>two cells</table>", "one cell\n\ntwo cells"),
    "line break": ("<p>one<br>two</p>", "one two"),
    "misnested": ("<article><h1>T</h1><p><b>first<br><p>second</b> more<p>third</article>",
                  "T\n\nfirst\n\nsecond more\n\nthird"),
    "cut off": (f"<body><nav>m</nav><article><h1>T</h1><p>{LONG}", f"T\n\n{LONG.strip()}"),
    "template": (
        f"<body><nav><ul><li><a href=x>Home</a></li></ul></nav><div class=ad>Buy it</div>"
        f"<article><h1>Title</h1><p>{LONG}</p><p>Short.</p></article>"
        f"<footer>&copy; site</footer></body>",
        f"Title\n\n{LONG.strip()}\n\nShort.",
    ),
    "nothing named": (
        f"<body class='has-sidebar'><header><a href=/>Site</a> Welcome</header><div id=wrap>"
        f"<div class='cookie-notice'>{LONG}</div><div class=content><h1>Title</h1><p>{LONG}</p>"
        f"<p>Short.</p><form>Name <input> Mail</form><div class=advert>Buy</div></div>"
        f"<div class=sidebar>{LONG}</div><div id=comments><h3>Comments</h3>"
        f"<div class=comment><p>{LONG}{LONG}</p></div></div></div></body>",
        f"Title\n\n{LONG.strip()}\n\nShort.",
    ),
    "comments by heading": (
        "<article><h1>T</h1><p>text</p><section><h2>3 Comments</h2><p>mine</p></section></article>",
        "T\n\ntext",
    ),
    "hidden": ("<article><p>seen</p><p hidden>a</p><p style='display: none'>b</p></article>", "seen"),
    "links": (
        f"<body><div>{LONG}<p>{LONG}</p><p>{LONG}</p></div>"
        "<div><a href=1>one more story</a> <a href=2>and another story</a></div></body>",
        f"{LONG.strip()}\n\n{LONG.strip()}\n\n{LONG.strip()}",
    ),
    "parts alike": (
        f"<body><div id=page><h1>T</h1><div class=s><h2>A</h2><p>{LONG}</p></div><div class=s>"
        f"<p>Short.</p></div><div class=s><p>{LONG}</p><p>{LONG}</p></div></div><div>end</div></body>",
        "\n\n".join(["T", "A", LONG.strip(), "Short.", LONG.strip(), LONG.strip()]),
    ),
    "empty": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    source, expected = PAGES[name]
    assert html_text.main_text(source) == expected


def test_deep_and_broken_pages_end():
    assert html_text.main_text("<div>" * 5_000 + "x") == "x"
    assert html_text.main_text("seen " + '<a "' * 5_000) == "seen"
    assert html_text.main_text("<p>a" * 20_000).count("\n\n") == 19_999
    assert html_text.main_text(None) == ""


def test_every_page_once(spark):
    rows = [(1, "u", "<p>one</p>", "x"), (1, "u", "<p>one</p>", "x"), (2, None, None, None), (None, "u", "<p>", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = html_text.extract(pages).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(1, "u", "one", 3), (2, None, "", 0)]
    assert html_text.extract(pages.limit(0)).count() == 0


def threads(spark, rows):
    df = spark.createDataFrame(
        rows, "conv_id bigint, turn int, role string, text string, level string, thread string"
    )
    found = quotes.reply_order(df).orderBy("conv_id", "thread", "depth", "turn").collect()
    return [tuple(r[c] for c in ("conv_id", "turn", "text", "n_passages", "max_level", "n_linked",
                                 "reply_to", "thread", "depth")) for r in found]


def message(conv, turn, text):
    return (conv, turn, "user", text, "clash", "clash")


def test_quotes_find_their_originals(spark):
    got = threads(spark, [
        message(1, 0, "Hello there my friend.\n\nHow are you today?"),
        message(1, 1, "> How are you\n> today?\n\nFine, thanks."),
        message(1, 2, "On Monday bot wrote:\n> > How are you today?\n> fine,  THANKS.\nGood.\n\n\n\nBye"),
        message(1, 5, "> Hello there my friend.\nback to this"),
        message(1, 6, ">>> no one said that\nand on"),
    ])
    assert got == [
        (1, 0, "Hello there my friend.\n\nHow are you today?", 0, 0, 0, None, 0, 0),
        (1, 1, "Fine, thanks.", 1, 1, 1, 0, 0, 1),
        (1, 5, "back to this", 1, 1, 1, 0, 0, 1),
        (1, 2, "Good.\n\nBye", 2, 2, 2, 1, 0, 2),
        (1, 6, "and on", 1, 3, 0, 5, 0, 2),
    ]


def test_odd_messages(spark):
    got = threads(spark, [
        message(2, 0, None), message(2, 2, ""), message(2, 2, ""), message(None, 1, "x"),
        message(2, None, "x"), message(3, 7, "> only a quote"), message(3, 9, "a > b"),
    ])
    assert got == [
        (2, 0, "", 0, 0, 0, None, 0, 0),
        (2, 2, "", 0, 0, 0, None, 2, 0),
        (3, 7, "", 1, 1, 0, None, 7, 0),
        (3, 9, "a > b", 0, 0, 0, None, 9, 0),
    ]
    assert threads(spark, []) == []


def test_a_line_everyone_repeats_adds_no_pairs(spark):
    rows = [message(1, t, "> agreed\nagreed\nown %d" % t) for t in range(300)]
    got = threads(spark, rows)
    assert len(got) == 300
    assert {(r[1], r[6], r[8]) for r in got} == {(0, None, 0)} | {(t, 0, 1) for t in range(1, 300)}


def test_a_long_chain_of_replies(spark):
    got = threads(spark, [message(1, t, f"turn {t}") for t in range(70)])
    assert [(r[1], r[6], r[7], r[8]) for r in got] == [
        (t, t - 1 if t else None, 0, t) for t in range(70)
    ]


def test_self_closed_drawings_are_empty():
    for icon in ('<svg class="icon"/>', "<svg />", "<math/>"):
        page = f"<body><article><p>First part.</p><p>{icon} Second part.</p><svg><text>no</text></svg><p>Third part.</p></article></body>"
        assert html_text.main_text(page) == "First part.\n\nSecond part.\n\nThird part."
        assert "Third part." in html_text.main_text(f"<article><p>First part.</p>{icon}<p>Third part.</p></article>")


def test_one_marked_word_or_heading_does_not_take_the_text():
    long = " ".join(f"word{i}" for i in range(120))
    builder = (
        "<body><div class='elementor-widget elementor-widget-title'><h1>Title</h1></div>"
        f"<div class='elementor-widget elementor-widget-theme-post-content'><p>{long}</p><p>{long} end</p></div></body>"
    )
    assert "end" in html_text.main_text(builder)
    paper = f"<body><div><h1>Paper</h1><p>{long}</p><div><h2>4 Discussion</h2><p>{long} found</p></div></div></body>"
    assert "found" in html_text.main_text(paper)
    replies = "".join(f"<li class='c' id='c{i}'><p>I think so, number {i}.</p></li>" for i in range(4))
    comments = f"<body><div><h1>Paper</h1><p>{long}</p><div class='x'><h3>4 Comments</h3><ul>{replies}</ul></div></div></body>"
    assert "I think" not in html_text.main_text(comments)
