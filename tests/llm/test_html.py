"""Main text of pages: boilerplate, blocks, character references and damaged markup."""

import pytest

from clearshelf.llm.html import extract, main_text

PARA = "A sentence of the article, with commas, and enough words to count as prose in any page."
OTHER = "Another paragraph, which is also long enough, so that its points reach the article as well."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


ARTICLE = f"<article><h1>Title</h1><p>{PARA}</p><p>Short.</p><p>{OTHER}</p></article>"
TEXT = f"Title\n{PARA}\nShort.\n{OTHER}"


@pytest.mark.parametrize(
    "noise",
    [
        "<nav><ul><li><a href=/>Home</a></li><li>Menu</li></ul></nav>",
        "<header><p>Site, name, slogan</p></header>",
        "<footer>&copy; us</footer>",
        f"<aside><p>{PARA} {PARA}</p></aside>",
        f'<div class="sidebar"><p>{OTHER}</p></div>',
        f'<div id="cookie-notice"><p>{OTHER}</p></div>',
        '<div class="ad">Buy, buy, buy</div>',
        "<form><label>Mail</label><input name=q><p>Sign up, please, now</p></form>",
        "<script>var t = '</p><p>';</script><style>p{margin:0}</style><noscript>no</noscript>",
        f'<section class="comments"><p>{PARA}</p><p>{OTHER}</p><p>{OTHER}</p></section>',
        f'<div class="commentList" role="list"><p>{PARA}</p></div>',
        f'<div role="complementary"><p>{OTHER}</p></div>',
        f"<div hidden><p>{OTHER}</p></div>",
        f'<div style="display: none"><p>{OTHER}</p></div>',
        "<!-- <p>a comment</p> -->",
    ],
)
@pytest.mark.parametrize("place", ["before", "after", "inside"])
def test_noise_goes(noise, place):
    body = {
        "before": noise + ARTICLE,
        "after": ARTICLE + noise,
        "inside": ARTICLE.replace("<p>Short.", noise + "<p>Short."),
    }[place]
    assert main_text(page(body)) == TEXT


def test_without_an_article_element():
    body = (
        '<div id="page"><div class="links"><a href=1>one</a> <a href=2>two</a></div>'
        f'<div class="post"><h2>Title</h2><p>{PARA}</p><p>Short.</p><p>{OTHER}</p></div>'
        '<div class="footer"><p>us, them, all of us</p></div></div>'
    )
    assert main_text(page(body)) == TEXT


def test_sections_of_one_article_stay_together():
    body = f"<main><section><p>{PARA}</p><p>{OTHER}</p></section><section><p>{OTHER}</p></section></main>"
    assert main_text(page(body)) == f"{PARA}\n{OTHER}\n{OTHER}"


def test_siblings_of_the_best_container_stay():
    half = f"<p>{PARA}</p><p>{OTHER}</p>"
    body = f"<div><div>{half}{half}</div><div>{half}</div><div><a href=1>more</a></div></div>"
    assert main_text(page(body)) == "\n".join([PARA, OTHER] * 3)


def test_blocks_white_space_and_references():
    body = (
        f"<article><p>{PARA}\n  two\t lines<br>here &amp; &lt;b&gt; &eacute; &#233; &#x1F600;&nbsp;x</p>"
        "<ul><li>one<li>two <b>bold</b></ul><blockquote>quoted</blockquote>tail</article>"
    )
    lines = main_text(page(body)).split("\n")
    assert lines == [
        f"{PARA} two lines here & <b> é é 😀 x", "one", "two bold", "quoted", "tail",
    ]


def test_unclosed_and_cut_markup():
    html = f"<html><body><nav><a href=1>x</a></nav><article><h1>T</h1><p><b>{PARA}<br><p>{OTHER} &am"
    assert main_text(html) == f"T\n{PARA}\n{OTHER} &am"
    assert main_text(f"<article><p>{PARA}</p><p>{OTHER}</p><p") == f"{PARA}\n{OTHER}"


def test_odd_pages():
    assert main_text("") == ""
    assert main_text("just text") == "just text"
    assert main_text(page("<nav>only a menu</nav>")) == ""
    assert PARA in main_text("<div>" * 300 + f"<p>{PARA}</p>" + "</div>" * 300)


def test_rows(spark):
    rows = [(1, "u", page(ARTICLE)), (1, "u", page(ARTICLE)), (None, None, None), (2, "v", ""),
            (3, "w", page("<article><p>" + "long é, " * 40_000 + "</p></article>"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text")
    found = sorted(extract(pages).collect(), key=str)
    assert len(found) == 5
    assert sum(r.text == TEXT and r.n_chars == len(TEXT) for r in found) == 2
    assert sum(r.text == "" and r.n_chars == 0 for r in found) == 2
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 3, 9])
@pytest.mark.parametrize("depth", [1, 2, 3, 4, 6, 40])
def test_paragraphs_in_nests_of_their_own(n, depth):
    texts = [PARA, OTHER * 3, *[f"{OTHER} {i}" for i in range(n - 2)]]
    nests = "".join("<div>" * depth + f"<p>{t}</p>" + "</div>" * depth for t in texts)
    assert main_text(page(f"<div>{nests}</div><div><a href=1>more</a></div>")) == "\n".join(texts)


@pytest.mark.parametrize("tag", ["div", "font"])
def test_five_thousand_levels(tag):
    assert PARA in main_text(f"<{tag}>" * 5000 + f"<p>{PARA}</p><p>{OTHER}</p>")
    assert PARA in main_text(page(f"<article>{f'<{tag}>' * 5000}<p>{PARA}</p></article>"))


@pytest.mark.parametrize(
    "name",
    ["class='has-sidebar'", "class='with-sidebar x'", "class=no-ads", "class='page-header-fixed'",
     "id='search-results'", "id=social-layout", "class=widget"],
)
def test_a_wrapper_is_not_dropped_by_its_name(name):
    side = f"<div class=sidebar><p>{OTHER}</p></div>"
    plain = f"<div><h1>Title</h1><p>{PARA}</p><p>Short.</p><p>{OTHER}</p></div>"
    assert main_text(page(f"<div {name}>{ARTICLE}{side}</div>")) == TEXT
    assert main_text(page(f"<div {name}><main>{plain}</main>{side}</div><p>us, all</p>")) == TEXT
    if "widget" not in name:
        assert main_text(page(f"<div {name}>{plain}{side}</div><div class=footer>us</div>")) == TEXT


def test_comments_and_teasers_that_are_articles_go():
    comment = f"<article><p>{PARA}</p></article>"
    assert main_text(page(f"{ARTICLE}<div class=comments>{comment * 5}</div>")) == TEXT
    inside = ARTICLE.replace("</article>", f"<div id=comments>{comment}</div></article>")
    assert main_text(page(f"<div class=has-sidebar>{inside}</div>")) == TEXT
    assert main_text(page("<div class=ad>Buy, buy</div><div><p>x</p></div>")) == "x"


@pytest.mark.parametrize(
    "wrapper", ["form", "fieldset", "label", 'div aria-hidden="true"', 'div style="display:none"', 'form role="form"']
)
def test_a_form_or_hidden_wrapper_keeps_the_text_of_the_page(wrapper):
    tag = wrapper.split()[0]
    inside = f"<div>{f'<p>{PARA}</p>' * 5}<input name=a><button>Go</button><select><option>x</select></div>"
    menu = "<nav><a href=/>Home</a></nav>"
    assert main_text(page(f"{menu}<{wrapper}>{inside}</{tag}>")) == "\n".join([PARA] * 5)
    assert main_text(page(f"<form id=f><{wrapper}>{inside}</{tag}></form>")) == "\n".join([PARA] * 5)
    assert main_text(page(f"<{wrapper}>{menu}{ARTICLE}</{tag}>")) == TEXT


@pytest.mark.parametrize("wrapper", ["form", "fieldset", "div hidden", 'div aria-hidden="true"'])
def test_a_long_form_or_hidden_part_beside_the_article_goes(wrapper):
    tag = wrapper.split()[0]
    long = f"<{wrapper}>{f'<p>{PARA} {OTHER}</p>' * 9}</{tag}>"
    assert main_text(page(ARTICLE + long)) == TEXT
    assert main_text(page(long + ARTICLE)) == TEXT
    assert main_text(page(f"<main>{ARTICLE}</main>{long}")) == TEXT
    assert main_text(page(f"<div><p>{PARA}</p><p>{OTHER}</p><form><p>Name, please</p></form></div>")) == f"{PARA}\n{OTHER}"


COMMENT = f'<article class="comment"><p>{OTHER}</p></article>'


@pytest.mark.parametrize(
    "comments",
    [
        f'<div id="comments">{COMMENT * 8}</div>',
        f'<section class="comment-list">{COMMENT * 8}</section>',
        COMMENT * 8,
        f'<div class="discussion">{f"<p>{OTHER}</p>" * 8}</div>',
        f'<ol class="replies">{f"<li><p>{OTHER}</p></li>" * 8}</ol>',
    ],
)
def test_comments_never_stand_in_for_the_article(comments):
    post = f'<article class="post has-comments"><p>{PARA}</p></article>'
    assert main_text(page(post + comments)) == PARA
    assert main_text(page(f"<main>{post}{comments}</main>")) == PARA
    assert main_text(page(f'<article class="post"><p>{PARA}</p>{comments}</article>')) == PARA
    assert main_text(page(f"<form>{post}{comments}</form>")) == PARA


def test_a_page_of_comments_alone_keeps_them():
    assert main_text(page(f'<div class="discussion"><p>{PARA}</p><p>{OTHER}</p></div>')) == f"{PARA}\n{OTHER}"
