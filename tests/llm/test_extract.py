import itertools
import random

from catalogue.llm import extract

PAGES = "page_id long, url string, html string"


def cut_value(side, surplus, edges):
    return sum(max(0, s) for s, x in zip(surplus, side) if not x) + sum(max(0, -s) for s, x in zip(surplus, side) if x) + sum(
        c for a, b, c in edges if side[a] != side[b])


def test_cuts_are_minimal():
    r = random.Random(3)
    for _ in range(150):
        n = r.randint(1, 9)
        surplus = [r.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, r.randint(0, 6)) for a, b in itertools.combinations(range(n), 2) if r.random() < 0.5]
        best = min(cut_value(x, surplus, edges) for x in itertools.product((False, True), repeat=n))
        assert cut_value(extract.minimum_cut(surplus, edges), surplus, edges) == best


ARTICLE = "<article><h1>Title &amp; more</h1><p>First   paragraph\n of <b>some</b> words.<p>Second one, with a <a href=x>link</a> inside it.<br>Third line.</p></article>"
WANT = "Title & more\nFirst paragraph of some words.\nSecond one, with a link inside it.\nThird line."


def page(body):
    return f"<!DOCTYPE html><html><head><title>Title</title><style>p{{x:'</p>'}}</style><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


def test_only_the_article_is_left():
    around = ("<header>Site name<ul><li><a href=/>Home</a></li></ul></header><nav><ul><li><a href=/a>Some menu</a></li><li><a href=/b>More</a></li></ul></nav>"
              "<div class='ad'>Buy this great thing now, it is very good and cheap today.</div><div id=cookie-notice>We use cookies to make this site work for you.</div>{}"
              "<aside class=sidebar><p>Related stories that you may want to read as well.</p></aside><form><label>Search</label><button>Go</button></form>"
              "<section class='comments'><h2>Comments</h2><p>I do not agree with this article at all, it is wrong.</p><p>Nice read, thank you.</p></section>"
              "<footer>&copy; 2026 Some company. All rights reserved by them.</footer>")
    assert extract.main_text(page(around.format(ARTICLE))) == WANT
    inside = ARTICLE.replace("</article>", "<div class='comments'><p>A reader says that it is all wrong.</p></div></article>")
    assert extract.main_text(page(around.format(inside))) == WANT


def test_pages_without_semantic_elements():
    body = ("<div class=menu><a href=a>One</a> <a href=b>Two</a></div><div class=content><p>" + "This is a rather long paragraph of prose. " * 6
            + "</p><p>Short end.</p></div><div class=footer>Imprint</div>")
    assert extract.main_text(page(body)) == ("This is a rather long paragraph of prose. " * 6).strip() + "\nShort end."


def test_broken_and_odd_markup():
    assert extract.main_text(None) == extract.main_text("") == extract.main_text("<") == extract.main_text("<p") == ""
    assert extract.main_text(page(ARTICLE)[:-22]) == WANT
    for k in range(len(page(ARTICLE))):
        extract.main_text(page(ARTICLE)[:k])
    assert extract.main_text("<article><p>a < b and c > d</p><p title=\"x>y\">q&am</article></b></i>") == "a < b and c > d\nq&am"
    assert extract.main_text("<article><p title='never closed>Words in it.</p>") == "Words in it."
    assert extract.main_text("<article>" + "<div>" * 3000 + "<p>Deep down are words.</p></article>") == "Deep down are words."
    r = random.Random(9)
    for _ in range(300):
        extract.main_text("".join(r.choice(["<p>", "</p>", "<a href='", "\">", "<!--", "-->", "<div", " class=ad", ">", "text ", "</div>", "<script>", "&#x", "&lt;", "<b>"]) for _ in range(40)))


def test_long_pages_and_odd_rows(spark):
    long = page("<nav><a href=x>Menu</a></nav><article>" + "".join(f"<p>Paragraph number {k} has some words.</p>" for k in range(20000)) + "</article>")
    rows = [(1, "u", long), (2, None, None), (None, "v", ""), (3, "w", page(ARTICLE)), (3, "w", page(ARTICLE))]
    frame = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", text string")
    got = extract.extract(frame).collect()
    texts = sorted((r["text"], r["n_chars"]) for r in got)
    assert [n for _, n in texts] == [len(t) for t, _ in texts]
    assert [t for t, _ in texts[:2]] == ["", ""] and sum(t == WANT for t, _ in texts) == 2
    assert max(texts, key=lambda t: t[1])[0].count("\n") == 19999
    assert extract.extract(frame.limit(0)).count() == 0


def test_wrappers_that_only_sound_hidden_or_like_boilerplate():
    for names in ("class='overflow-hidden'", "class='md:overflow-x-hidden'", "style='overflow:hidden'", "data-state=hidden", "class='no-sidebar has-menu'",
                  "data-id=sidebar", "data-class='ads'", "title='a hidden gem'", "hidden=until-found", "aria-hidden=false", "data-style='display:none'"):
        assert extract.main_text(page(f"<div {names}>{ARTICLE}</div>")) == WANT, names
    assert extract.main_text(page(ARTICLE).replace("<body>", "<body class='no-sidebar menu-open search'>")) == WANT
    for names in ("hidden", "HIDDEN=''", "aria-hidden='true'", "style='color:red; display : none'", "style='visibility:hidden;'"):
        assert extract.main_text(page(f"{ARTICLE}<div {names}><p>These words are out of sight for all readers.</p></div>")) == WANT, names


def test_embedded_elements_drop_no_text_of_the_article():
    first, second = "<article><p>First paragraph of some words.</p>", "<p>Second one, with more words in it.</p></article>"
    want = "First paragraph of some words.\nSecond one, with more words in it."
    for e in ("<svg viewBox='0 0 1 1'/>", "<math/>", "<iframe src=x />", "<iframe src=x>", "<object data=x>", "<object data=x />", "<canvas/>", "<audio src=x>", "<video src=x>",
              "<select>", "<select><option>One<option>Two</select>", "<svg><title>Icon</title><style>a{}</style><text>no</text></svg>", "<template><p>Later.</p></template>",
              "<div><svg><g></div>", "<div><select><option>One</div>", "<script>var a = '<p>no</p>';</script>"):
        assert extract.main_text(page(first + e + second)) == want, e
    assert extract.main_text(page(first + "<p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is a formula.</p>" + second)) == want.replace("\n", "\nThe sum a+b is a formula.\n")
    assert extract.main_text(page(first + "<svg/>" + second + "<svg><path d=x /></svg>")) == want
    assert extract.main_text(page(first + "<svg><path d=x>" + second)) == want
    for e in ("<iframe src=x />", "<iframe src=x>"):
        assert extract.main_text(page(first + e + second + "<iframe src=y>no</iframe>")) == want
    for e in ("object", "video", "audio", "canvas"):
        assert "Words shown in its place." in extract.main_text(page(f"{first}<{e}><p>Words shown in its place.</p></{e}>{second}"))
