import pytest

from termlode.llm.html_text import block_features, extract_text, labelled_table, text_blocks, train_tree

from .conftest import found

WORDS = " ".join(["plain words of a long paragraph"] * 6)
PAGES = {
    1: (
        "<html><head><title>No</title><style>p{}</style></head><body class='has-sidebar'>"
        "<header><h1>Site</h1><p>Tagline</p></header><nav><a href=x>Home</a></nav>"
        "<div class='cookie-notice'>We use cookies and other things to improve your visit</div>"
        "<main><article><header><h1>Title &eacute;</h1></header><p><b>First   para\n&amp; more."
        "<p>One<br>two <a href=x>link</a>\xa0three<script>var t='</p><p>no';</script>"
        "<div class=\"ad\" title='a > b'>Buy now</div><form><label>Name</label></form>"
        "<blockquote>Quote</blockquote><ul><li>Item<li>Next</ul><!-- gone <p>x</p> -->"
        "<section id='comments'><h3>Comments</h3><p>Nice article! I liked reading it.</section>"
        "</article><aside>Related</aside></main><div class=sidebar>Side</div>"
        "<footer>&copy; x</footer></body></html>",
        "Title é\nFirst para & more.\nOne\ntwo link three\nQuote\nItem\nNext",
    ),
    2: (f"<div><a href=x>Menu</a></div><p>{WORDS}</p><p>Short.</p><p>{WORDS}</p><p><a>a</a></p>",
        f"{WORDS}\nShort.\n{WORDS}"),
    3: (None, ""),
    4: ("", ""),
    5: ("<article><p>cut off &am", "cut off &am"),
    6: ("<article>a <5 & b > c<p hidden>no</p><p style='display: none'>no</p></article><scr", "a <5 & b > c"),
    7: ("<article>" + "<p>x y</p>" * 30_000 + "</article>", "\n".join(["x y"] * 30_000)),
    9: (f"<body><form id=aspnet><div class='layout-sidebar'><nav>Menu</nav><article><p>{WORDS}</p><form>Name"
        "<input></form><div class=widget>Share</div></article></div><p>Beside</p></form>", WORDS),
    10: ("<div id='widget-content'><article>a b<p>c</article></div><section id=comments><article>Nice!"
         "</article></section><aside><article>Teaser</article></aside>", "a b\nc"),
    11: ("<article>one<button>two<p>three<select><option>four<object>five</article>", "onetwo\nthree\nfourfive"),
    12: (f"<form action=x><p>{WORDS}</p><p>{WORDS}</p></form>", f"{WORDS}\n{WORDS}"),
    13: (f"<p>{WORDS}</p><p>{WORDS}</p><form><p>{WORDS}</p></form>", f"{WORDS}\n{WORDS}"),
    8: ("<<<>><!---><article>&#x41;&#66;</article></p></div>", "AB"),
}


def test_pages(spark):
    rows = [(i, "u", html, "x", "y") for i, (html, _) in PAGES.items()] + [(None, None, None, None, None)]
    frame = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, text string, blocks string")
    got = found(extract_text(frame), "page_id", "text")
    expected = [(i, text) for i, (_, text) in sorted(PAGES.items())]
    assert got == [(None, ""), *expected[:1], *expected]
    assert extract_text(frame.where("false")).count() == 0


def test_the_tree_learns_its_table():
    table = labelled_table()
    assert (train_tree(table).predict(table[:, :-1]) == table[:, -1].astype(bool)).all()


def test_features_are_of_neighbours():
    blocks = text_blocks("<p>a b</p><p><a>c</a></p><h2>d e f</h2>")
    rows = block_features(blocks)
    assert rows[1, :6].tolist() == [1, 1, 2, 0, 3, 0]
    assert rows[:, 8].tolist() == [0, 0, 1]
    assert block_features([]).shape == (0, 10)


@pytest.mark.parametrize("page", ["<" * 5000, "<a " * 3000, "<p class='" + "x" * 9000, "&" * 9000])
def test_bad_markup_is_read_in_linear_time(page):
    text_blocks(page)
