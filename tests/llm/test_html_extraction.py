import pytest

from dimweave.llm.html_extraction import extract, main_text

LONG = "word " * 40


def test_article_without_what_is_around():
    page = f"""<!DOCTYPE html><head><title>T</title><style>p{{x:"</p>"}}</style>
    <script>var a = "<p>no</p>";</script></head><body><header>Head</header>
    <nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>no</p> -->
    <div class="cookie-notice">We use cookies</div>
    <article><h1>Title &amp; more</h1><p>First   line
    goes on<br>after</p><div class="ad">Buy</div><p>{LONG}</p><form>Mail <input></form>
    <p>End &lt;b&gt;&nbsp;x</article>
    <aside>Side</aside><div id="comments"><article><p>{LONG}</p></article></div>
    <footer>&copy; foot</footer>"""
    want = ["Title & more", "First line goes on", "after", LONG.strip(), "End <b> x"]
    assert main_text(page) == "\n".join(want)


def test_surge_and_dive_without_article_markup():
    links = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(9))
    page = f"<ul>{links}</ul><div><h2>Head</h2><p>{LONG}</p><p>Short.</p></div>"
    assert main_text(page).split("\n")[-2:] == [LONG.strip(), "Short."]
    assert "Link number 3" not in main_text(page)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<p></p>", ""),
        ("plain  text", "plain text"),
        ("<p>short", "short"),
        ("<p a='", ""),
        ("<nav>never closed <a>x</a><article><p>kept", "kept"),
        ("<div hidden>no</div><p>yes</p>", "yes"),
        ("<script>never closed <p>no", ""),
    ],
)
def test_edges(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    ("inside", "want"),
    [
        ("<h1><a href=x>Title</a></h1><p>text</p>", ["Title", "text"]),
        ("<p>text</p><p><a href=x>All of it a link</a></p>", ["text", "All of it a link"]),
        (
            "<p>text</p><ul>" + "".join(f"<li><a href=x>n{i}</a>" for i in range(5)) + "</ul><p>end",
            ["text", "n0", "n1", "n2", "n3", "n4", "end"],
        ),
        ("<p><a href=x>One</a></p><p><a href=y>Two</a></p>", ["One", "Two"]),
    ],
)
@pytest.mark.parametrize("tag", ["article", "main"])
def test_links_inside_an_article_stay(tag, inside, want):
    page = f"<ul><li><a href=m>Menu</a></ul><{tag}>{inside}</{tag}><p>{LONG}</p>"
    assert main_text(page).split("\n") == want


def test_short_passage_around_an_advert_stays():
    page = f"<div><h1>Head</h1><div class=share>x</div><p>{LONG}</p><div class='ad'>x</div><p>The end.</p></div>"
    assert main_text(page).split("\n") == ["Head", LONG.strip(), "The end."]
    page = f"<div><div><p>{LONG}</p></div></div><div class='ad'>x</div><div><p>Other.</p></div>"
    assert main_text(page) == LONG.strip()


@pytest.mark.parametrize(
    "wrapper",
    [
        '<div class="layout has-sidebar">', '<div class="no-sidebar">', "<form action=x>",
        '<div class="post share-enabled">', '<form><div class="has-sidebar"><div id="search-page">',
        '<main><div class="has-sidebar">', '<main><h1>Head</h1><div class="no-sidebar">',
    ],
)
def test_marked_wrapper_of_the_article_stays(wrapper):
    page = f"""<div class="nav">Home</div>{wrapper}<p>{LONG}</p><div class="sidebar">Side</div><nav>N
    </nav><p>End.</p>{"".join("</" + t.split()[0].strip("<>") + ">" for t in wrapper.split(">")[::-1]
    if t.startswith("<") and "h1" not in t)}<div class="footer">Foot</div><p class="copyright">C</p>"""
    head = ["Head"] if "Head" in wrapper else []
    assert main_text(page).split("\n") == [*head, LONG.strip(), "End."]


def test_several_posts_with_one_marking_stay():
    posts = "".join(f'<div class="post share-enabled"><p>{i} {LONG}</p></div>' for i in range(5))
    page = f'{posts}<div class="sidebar">Side</div>'
    assert main_text(page).split("\n") == [f"{i} {LONG}".strip() for i in range(5)]


def test_what_a_page_gave_stays_beside_a_large_notice():
    page = f"<div><p>Short article.</p></div><div class=cookie><p>{LONG}</p></div>"
    assert "Short article." in main_text(page).split("\n")


def test_frame(table):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None), (2, "v", "<p>" + "é " * 400_000)]
    schema = "page_id long, url string, html string, text string"
    found = extract(table([(*r, "clash") for r in rows], schema)).collect()
    got = sorted(((r.page_id or 0, r.url, len(r.text)) for r in found), key=str)
    assert got == [(0, None, 0), (1, "u", 1), (1, "u", 1), (2, "v", 799_999)]
    assert extract(table([], schema)).count() == 0


LONG = "A sentence that is long enough to stand for the body of a page by itself, and then some. "


@pytest.mark.parametrize(
    ("piece", "lines"),
    [
        ("<h2 id='search'>Search methods</h2>", ["Search methods"]),
        ("<h2 class='header alert'>Alert levels</h2>", ["Alert levels"]),
        ("<h3 id='comments'>Comments on the text</h3>", ["Comments on the text"]),
        ("<div id='related-work'><p>Related work</p></div>", ["Related work"]),
        ("<section id='social'><p>Social history</p></section>", ["Social history"]),
        ("<p>a <custom-el>b</custom-el> c</p>", ["a b c"]),
        ("<p>a<svg><text>x</text></svg> b</p>", ["a b"]),
        ("<p>a <button>press</button>b <script>x()</script>c<style>y</style></p>", ["a b c"]),
        ("<div id='comments'><p>First!</p></div>", []),
        ("<div class='advert'><p>Buy</p></div>", []),
        ("<nav id='x'><p>Menu</p></nav>", []),
    ],
)
def test_pieces_of_an_article(piece, lines):
    page = f"<html><body><nav>Home</nav><article><p>{LONG}</p>{piece}<p>{LONG}</p></article></body></html>"
    assert main_text(page).split("\n") == [LONG.strip(), *lines, LONG.strip()]
