import html as entities
import re

import pytest

from gridplume.llm import html_blocks as hb
from gridplume.llm.common import table

TREE = hb.train(hb.LABELLED)
PROSE = "The council met on Tuesday to talk about the new bridge over the river, and it was decided to wait for another year."

PAGE = f"""<!DOCTYPE html><html><head><title>Not this</title><style>p > a {{}}</style><script>var t = "<p>no</p>";</script></head><body>
<header class="site-header"><h1>The Daily Page</h1><p>{PROSE} Header.</p></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News of the day</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies. {PROSE}</p></div><!-- a comment <p>with a tag</p> -->
<main><article><header><h1>The &quot;bridge&quot;</h1></header><p>First &amp; <b>fore</b>most,&nbsp;it <a href="x">costs</a> &#163;5.</p>
<div class="ad">Buy now! {PROSE}</div><ul><li>one</li><li>two</li></ul><form><label>Your name</label><button>Send</button></form>
<p>Last<br>line.</p><footer>Tags: bridge</footer></article><section id="comments"><h2>Comments</h2><p>I think so too. {PROSE}</p></section></main>
<aside>Read also: {PROSE}</aside><footer>&copy; 2020 {PROSE}</footer></body></html>"""


def test_an_article_without_its_furniture():
    assert hb.main_text(PAGE, TREE) == 'The "bridge" First & foremost, it costs £5. one two Last line.'


@pytest.mark.parametrize("mark", ['class="sidebar"', 'class="related-posts"', 'role="navigation"', 'id="newsletter"', "hidden", "class='promo box'", "class=comments"])
def test_furniture_by_name(mark):
    page = f"<body><article><p>{PROSE}</p><div {mark}><p>{PROSE} Not.</p></div><p>{PROSE} End.</p></article></body>"
    assert hb.main_text(page, TREE) == f"{PROSE} {PROSE} End."


def test_a_page_without_article_goes_by_words_and_links():
    links = "".join(f"<li><a href='/{k}'>link {k}</a></li>" for k in range(9))
    page = f"<body><div><a href=/>Start</a> | <a href=/x>About us</a></div><h2>On the bridge</h2><p>{PROSE}</p><p>{PROSE}</p><ul>{links}</ul></body>"
    assert hb.main_text(page, TREE) == f"On the bridge {PROSE} {PROSE}"


@pytest.mark.parametrize("cut", [1, 7, 25, 60, 100])
def test_a_page_that_breaks_off(cut):
    page = f"<body><nav><a href=x>Home</a></nav><article><p>{PROSE}<p>{PROSE} End of it all &amp; more than that, and here it ends.</p></article></body>"
    whole = hb.main_text(page, TREE)
    assert whole.startswith(hb.main_text(page[:-cut], TREE)[:100]) and "Home" not in whole


def test_unclosed_tags_and_stray_signs():
    assert hb.main_text(f"<article><p>a < b and c > d<p><b>{PROSE}<div>x</article><script>", TREE).startswith("a < b and c > d The council")


def test_tree_knows_its_table():
    assert all(hb.classify(TREE, row[:-1]) == row[-1] for row in hb.LABELLED)


def test_awkward_rows(spark):
    long = "<article>" + "".join(f"<p>{PROSE} {k}</p>" for k in range(5000)) + "</article>"
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "u", PAGE, None), (4, "u", "plain words only", "t"), (5, "u", PAGE, "t"), (5, "u", PAGE, "t"), (6, "u", long, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted(((r["id"] or 0, r["n_chars"], r["text"]) for r in hb.extract(pages).collect()))
    assert [f[0] for f in found] == [0, 1, 2, 4, 5, 5, 6]
    assert all(n == len(t) for _, n, t in found) and found[1][2] == found[2][2] == ""
    assert found[6][2] == " ".join(f"{PROSE} {k}" for k in range(5000))
    assert hb.extract(pages.limit(0)).count() == 0


def test_tables_have_their_articles(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, "/root/testdata/sf0.01", "pages").collect()}
    for r in hb.extract(table(spark, "/root/testdata/sf0.01", "pages")).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["id"]], re.S)[1]
        inner = re.sub(r"<(?!/?b>)[^>]*>", " ", re.sub(r"<[^>]*\Z", "", inner))
        assert r["text"] == " ".join(entities.unescape(re.sub("</?b>", "", inner)).split())
