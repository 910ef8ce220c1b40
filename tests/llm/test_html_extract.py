import html
import random

import pytest

from impactspark.llm import html_extract as H
from impactspark.llm.common import prepare

LONG = "A sentence of the article, with commas and full stops. It goes on; and on."


@pytest.mark.parametrize("source,text", [
    (None, ""), ("", ""), ("   ", ""), ("<<<>>", "<<<>>"), ("plain &amp; simple", "plain & simple"),
    (f"<p>{LONG}", LONG),
    (f"<body class='has-sidebar'><nav><a href=x>m</a></nav><div><p>{LONG}<p>{LONG}</div><div id=sidebar>no</div>", f"{LONG} {LONG}"),
    (f"<header>top</header><article><header><h1>Title</h1></header><p>a<b>b</b>c. {LONG}</p><aside>x</aside></article><footer>z",
     f"Title abc. {LONG}"),
    (f"<main><p>{LONG}</p><section class='comments'><p>{LONG}</p></section><form><p>f</p></form></main>", LONG),
    (f"<div class='cookie-notice'>We use cookies.</div><article><p>{LONG}</article>", LONG),
    (f"<article><p>x &lt;b&gt; &eacute;\n\t y</p><script>var a = '<p>no</p>';</script><style>p{{}}</style><!-- no --><p>{LONG}",
     f"x <b> é y {LONG}"),
    (f"<article><ul><li>one, two<li>three.</ul><table><tr><td>a<td>b<tr><td>c</table><p>{LONG}</p></article>",
     f"one, two three. a b c {LONG}"),
    (f"<article><p>{LONG}</p><ul><li><a href=1>more</a><li><a href=2>more</a></ul></article>", LONG),
    (f"<article><p>{LONG}</p><p hidden>no</p><div aria-hidden='true'>no</div><div role=dialog>no</div></article>", LONG),
])
def test_main_text(source, text):
    assert H.main_text(source) == text


def test_plain_lists_tables_and_terms_beside_long_paragraphs():
    para = ("word " * 11 + "end, " + "more " * 10 + "end. ") * 3 + "last words of it, and so on."
    lists = "<ul>" + "".join(f"<li>unpunctuated list item {k}</li>" for k in range(20)) + "</ul>"
    table = "<table>" + "".join(f"<tr><td>cell {k} a</td><td>cell {k} b</td></tr>" for k in range(6)) + "</table>"
    terms = "<dl>" + "".join(f"<dt>term {k}</dt><dd>its meaning {k}</dd>" for k in range(5)) + "</dl>"
    links = "<ul class=more>" + "".join(f"<li><a href={k}>see also {k}</a></li>" for k in range(9)) + "</ul>"
    want = ["Title", *[para.strip()] * 6, *[f"unpunctuated list item {k}" for k in range(20)],
            *[f"cell {k} {c}" for k in range(6) for c in "ab"], *[x for k in range(5) for x in (f"term {k}", f"its meaning {k}")]]
    inner = f"<h1>Title</h1>{f'<p>{para}</p>' * 6}{lists}{table}{terms}{links}"
    for page in (f"<nav><a href=/>home</a></nav><article>{inner}</article>",
                 f"<article><div class=text><h1>Title</h1>{f'<p>{para}</p>' * 6}</div>{lists}{table}{terms}{links}</article>",
                 f"<body><nav>menu</nav><div class=text>{inner}</div><footer>end</footer></body>"):
        assert H.main_text(page).split() == " ".join(want).split()


@pytest.mark.parametrize("source,text", [
    *((f"<body><nav>m</nav><div class='{c}'><article><p>{LONG}</p><div class=sidebar>no</div></article><div id=comments>no, no."
       f"</div></div><footer>z", LONG)
      for c in ("container has-sidebar", "with-comments", "no-banner", "sidebar", "page_sidebar-left", "fixed-header")),
    (f"<p>Call us.<div class='wrap no-banner'><h1>Title</h1><p>{LONG}<p>{LONG}</div><div class=banner>{LONG}</div>",
     f"Call us. Title {LONG} {LONG}"),
    (f"<article><h1>Title</h1><div class='text share'><p>{LONG}</p></div><div class=share>no</div></article>", f"Title {LONG}"),
    (f"<body class=fixed-header><div class='header'>no</div><p>{LONG}</p>", LONG),
    (f"<article><p>{LONG}</p></article><div class=comments>{f'<article><p>{LONG}</p></article>' * 9}</div>", LONG),
    (f"<main><p>{LONG}</p><div class=comments>{f'<article><p>{LONG}</p></article>' * 20}</div></main>", LONG),
    (f"<div class=text><p>{LONG}</p></div><div id=comments>{f'<article><p>{LONG}</p></article>' * 20}</div>", LONG),
])
def test_class_words_of_wrappers(source, text):
    assert H.main_text(source) == text


def test_random_markup_never_fails():
    rng = random.Random(6)
    parts = ["<p>", "</p>", "<div class='ad'>", "</div>", "<a href=\"x>y\">", "</a>", "<!--", "-->", "<script>", "</script>",
             "<br/>", "<", ">", "&amp;", "&#x41;", "&bogus;", "text. ", "<article>", "</article>", "<td>", "</table>", "\n"]
    for _ in range(2000):
        assert isinstance(H.main_text("".join(rng.choice(parts) for _ in range(rng.randrange(40)))), str)


def test_generated_pages_give_their_articles():
    rng = random.Random(8)
    for _ in range(50):
        paras = [" ".join(rng.choice(["one,", "two.", "a&b", "<x>", "longer"]) for _ in range(rng.randrange(3, 40)))
                 for _ in range(rng.randrange(1, 9))]
        menu = "".join(f"<li><a href=/{k}>item {k}</a></li>" for k in range(rng.randrange(12)))
        close = rng.choice(["</p>", ""])
        page = (f"<!DOCTYPE html><html><head><title>t</title></head><body><nav><ul>{menu}</ul></nav><div class=ad>Buy, now.</div>"
                f"<article>{''.join('<p>' + html.escape(p) + close for p in paras)}</article><footer>&copy; x</footer>")
        assert H.main_text(page) == " ".join(paras)


def test_table_keeps_rows_and_columns(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, "u", f"<p>{LONG}"), (1, "u", f"<p>{LONG}"), (2, None, None), (None, "v", "")],
                               "page_id long, url string, html string").selectExpr("*", "5 AS text", "6 AS blocks")
    out = H.extract(df)
    assert sorted(r["text"] for r in out.collect()) == ["", "", LONG, LONG] and "blocks" in out.columns
    assert H.extract(df.limit(0)).count() == 0


def test_a_form_around_the_page_is_not_a_form_field():
    body = "<p>The first paragraph of the text, with some length. It goes on.</p><p>A second one follows here, as long as that.</p>"
    want = "The first paragraph of the text, with some length. It goes on. A second one follows here, as long as that."
    login = "<form class='login'><label>Name</label><input name='x'><button>Go</button> Forgot your password?</form>"
    assert H.main_text(f"<body><form id='aspnetForm'><div>{body}</div></form></body>") == want
    assert H.main_text(f"<body><form action='/'><article>{body}</article></form></body>") == want
    assert H.main_text(f"<body><form><nav><a href='/'>Home</a></nav><main>{body}</main><footer>End</footer></form></body>") == want
    assert H.main_text(f"<body>{login}<div>{body}</div></body>") == want
    assert H.main_text(f"<body><article>{body}{login}</article></body>") == want
    assert H.main_text(f"<body>{login}</body>") == ""


def test_furniture_names_inside_an_article_are_about_its_text():
    text = "<article><h1>Title</h1><p class='legal'>The court ruled, at last.</p><p class='search-term'>What people looked for.</p>" \
           "<p>An ordinary paragraph, too.</p><div class='advert'>Buy now</div><div class='share'>Share this</div></article>"
    assert H.main_text(text) == "Title The court ruled, at last. What people looked for. An ordinary paragraph, too."
    outside = "<div class='legal'>All rights reserved.</div><div class='search'>Search the site</div>"
    assert H.main_text(outside + text) == H.main_text(text)


def test_formulas_and_objects_stay_in_their_sentence():
    assert H.main_text("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold, as said.</p></article>") == "Let x=1 hold, as said."
    assert H.main_text("<article><p>See <object data='a.svg'>the drawing</object> here, please.</p></article>") == "See the drawing here, please."
