import pytest

from marquetry.llm import html

LONG = "the cat and the dog went to the house of the man and they were in the garden with a bird"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<", "<"),
        ("<!-- x", ""),
        ("<script>var t = '</p>'", ""),
        (f"<article><p>{LONG}</p></article>", LONG),
        (f"<p>a &lt;b&gt; &amp;amp; {LONG}\n\n&nbsp; <b>x</b>y<br>z</p>", f"a <b> &amp; {LONG} xy z"),
        (f"<nav><p>{LONG}</p></nav><main><h1>Title</h1><p>{LONG}</p><p>End</p></main>", f"Title {LONG} End"),
        (f"<body><h1>Title</h1><p>{LONG}<p>Short</p><div class='cookie-notice'>{LONG}</div><footer>{LONG}", f"Title {LONG} Short"),
        (f"<article><p>{LONG}</p><section id=comments><article><p>{LONG}</p></article></section></article>", LONG),
        (f"<div>{LONG}</div><ul><li><a href=x>{LONG}</a></li><li><a href=y>{LONG}</a></li></ul>", LONG),
        (f"<div style='display:none'>{LONG}</div><div hidden>{LONG}</div><p>{LONG}</p>", LONG),
        (f"<form><p>{LONG}</p></form><aside>{LONG}</aside><div role='navigation'>{LONG}</div>", ""),
        ("<article><p>No</p><p>stops</p></article><div class=ad>Buy</div>", "No stops"),
        (f"<textarea>{LONG}</textarea><p>{LONG} &copy; 2 &lt 3</p>", f"{LONG} © 2 < 3"),
        (f"<div class='loadable'><p>{LONG}</p></div>", LONG),
        (f"<article><header><h1>Head</h1></header><p>{LONG}</p></article><header>{LONG}</header>", f"Head {LONG}"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_open_blocks_follow_the_nearest_decided_one():
    found = html.blocks(f"<p>one</p><p>{LONG}</p><p>two</p><div class=menu>x</div><p>three</p>")
    html.classify(found)
    assert [b.keep for b in found] == [True, True, True, False, True]


def test_rows(spark):
    rows = [(1, "u", f"<p>{LONG}</p>", "x"), (1, "u", f"<p>{LONG}</p>", "x"), (None, None, None, None), (2, "v", "<p>" * 3000 + LONG * 500, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r["page_id"], r["url"], r["n_chars"]) for r in html.extract(pages).collect()}
    assert got == {(1, "u", len(LONG)), (None, None, 0), (2, "v", 500 * len(LONG))}
    assert html.extract(pages).count() == 4
    assert html.extract(pages.limit(0)).collect() == []


RUSSIAN = "Сегодня утром жители города собрались на площади, чтобы обсудить новый проект набережной и парка."
LINKS = "<p><a href=x>one link and another link</a></p>"


def test_pages_in_other_languages_keep_their_text():
    page = f"<body><div><p>{RUSSIAN}</p><p>Коротко.</p><p>{RUSSIAN}</p></div><div>{LINKS}</div></body>"
    assert html.main_text(page) == f"{RUSSIAN} Коротко. {RUSSIAN}"


def test_links_do_not_decide_for_an_article():
    assert html.main_text(f"<article><p>Short one.</p>{LINKS}<p>Short two.</p></article>") == "Short one. Short two."


@pytest.mark.parametrize("name", ["content with-sidebar", "has-social-share page"])
def test_a_class_does_not_take_the_main_text(name):
    long = "This is the text that the page was made for, and it is long enough to be seen as the main text of it."
    side = "<div class=sidebar><p>Not this.</p></div>"
    assert html.main_text(f"<body><div class='{name}'><p>{long}</p>{side}</div></body>") == long
    assert html.main_text(f"<body><div class='{name}'><article><p>Short.</p></article>{side}</div></body>") == "Short."
    assert html.main_text(f"<body><main><p>{long}</p></main><div class=comments><p>{long * 3}</p></div></body>") == long
    assert html.main_text(f"<main><h1>Title</h1><div class='{name}'><p>{long}</p></div></main>") == f"Title {long}"
