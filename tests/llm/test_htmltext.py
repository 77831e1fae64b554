import time

from fleetscope.llm.htmltext import extract, main_text, path_weights

ARTICLE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=x>Menu</a></ul></nav>
<!-- note --><div class="ad">Buy now, please.</div><article><header>Top</header><h1>Head &amp; more&lt;b&gt;</h1><p><b>First&nbsp; para,
 with <i>inline</i> words.<br>Same block.<p>Second&#8212;one.</p><div class="comments"><p>I am a reader.</p></div><form><p>Mail?</p></form>
<ul><li>Item one<li>Item two</ul></article><aside><p>Side.</p></aside><footer>&copy; me</footer></body></html>"""


def test_marked_article():
    assert main_text(ARTICLE) == "Head & more<b>\n\nFirst para, with inline words. Same block.\n\nSecond—one.\n\nItem one\n\nItem two"


def test_ratios_without_a_mark():
    text = "A long sentence, with commas; and some more words, so that it weighs. " * 4
    page = f"""<body><div class=box><span>Home</span></div><div class=links>{'<div><a href=#>Elsewhere and away</a></div>' * 9}</div>
    <div class=body><p>{text}</p><p>{text}</p><p>Short, but in it.</p></div><div class=box><span>Imprint</span></div></body>"""
    assert main_text(page).split("\n\n") == [text.strip(), text.strip(), "Short, but in it."]


def test_weights_are_by_path():
    paths = [(-1, ""), (0, "a"), (1, "p"), (1, "b")]
    w = path_weights([[2, "One, two, three four five six.", 0], [3, "x", 0], [2, "y", 0]], paths, 0.3)
    assert set(w) == {2, 3} and w[2] > w[3]


def test_hard_pages(spark):
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (2, None, None), (None, "v", ""), (3, "w", "</p></b>plain <b>text"), (4, "x", "<p>" * 3000 + "deep"),
            (5, "y", "<article>" + "<p>word, " * 3000), (6, "z", "<article><p>&am &amp &#x110000; &unknown; <![CDATA[ <x"), (7, "q", "<nav>only menu")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert [(r.page_id, r.url) for r in got] == [r[:2] for r in rows]
    by = {r.page_id: r.text for r in got}
    assert by[1] == main_text(ARTICLE) and by[2] == "" and by[None] == "" and by[3] == "plain text" and by[4] == "deep" and by[7] == ""
    assert by[5].count("word,") == 3000
    assert extract(pages.limit(0)).count() == 0


def test_odd_words_around_the_text():
    text = "A long sentence, with commas; and some more words, so that it weighs. " * 4
    body = f"<p>{text}</p><p>{text}</p>"
    want = [text.strip(), text.strip()]
    for mark in (f"<article>{body}</article>", f"<main>{body}</main>", body):
        for wrapped in (f"<div class='content-sidebar-wrap'>{mark}</div>", f"<div id=page class=no-sidebar><div>{mark}</div></div>",
                        f"<div class='ad-free'>{mark}</div>", f"<form action=x>{mark}</form>", f"<span class=widget>{mark}</span>"):
            page = f"<body><div class=top><a href=x>Home</a></div>{wrapped}<div class=ad>Buy now.</div></body>"
            assert main_text(page).split("\n\n") == want, page
    assert main_text(f"<body><span class='ad-free'>{text}</span></body>") == text.strip()
    assert main_text(f"<article>{body}<div class=comments><p>I read it.</p></div><form><p>Mail?</p></form></article>").split("\n\n") == want


def test_lists_of_links_in_the_article_stay():
    page = "<body><nav><a href=x>Menu</a></nav><article><p>Text.</p><ul><li><a href=x>link item</a></li><li>two</li></ul></article></body>"
    assert main_text(page) == "Text.\n\nlink item\n\ntwo"
    assert main_text("<article><ul><li><a href=x>only link</a></ul></article>") == "only link"


def test_deep_and_long_pages_take_linear_time():
    start = time.perf_counter()
    deep = main_text("<div class=x>" * 20_000 + "deep" + "</div>" * 20_000)
    odd = main_text("<div class=ad>" * 5_000 + "<article>in it" + "<div>more" * 5_000)
    many = main_text("<div>" * 10_000 + "<p>word, " * 10_000 + "</span>" * 10_000)
    assert deep == "deep" and odd.startswith("in it") and odd.count("more") == 5_000 and many.count("word,") == 10_000
    assert time.perf_counter() - start < 20
