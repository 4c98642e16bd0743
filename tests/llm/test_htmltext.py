import time

import numpy as np

from sanitaria.llm.htmltext import extract, main_text, smoothed

ARTICLE = "<h1>Head &amp; line</h1><p>First\n  <b>bold</b> &eacute;.<br>Second<p>Short.<p>" + "long text " * 40 + "</p>"
CLEAN = "Head & line\n\nFirst bold é. Second\n\nShort.\n\n" + ("long text " * 40).strip()


def page(body, head="<title>T</title><style>p{}</style><script>var t='</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


BESIDE = {
    "nav": "<nav><ul><li><a href=x>Menu</a></li></ul></nav>", "footer": "<footer>&copy; Us</footer>",
    "header": "<header><p>Site name</p></header>", "aside": "<aside><p>More to read, a long line of it</p></aside>",
    "ad": '<div class="ad">Buy this now, it is very good for you.</div>', "notice": '<div id="cookie-notice"><p>We use cookies.</p></div>',
    "form": "<form><label>Name</label><input><button>Go</button></form>", "comment": "<!-- ad 3 --><section class='comments'><p>I think so.</p></section>",
    "script": "<script>document.write('<p>no</p>')</script><noscript>Turn it on</noscript>", "sidebar": "<div role='complementary'><p>Side</p></div>",
}


def test_what_stands_beside_goes():
    for name, piece in BESIDE.items():
        for body in (
            f"{piece}<article>{ARTICLE}</article>", f"<article>{ARTICLE}</article>{piece}",
            f"<article>{ARTICLE}{piece}</article>" if name != "header" else f"{piece}<main>{ARTICLE}</main>",
            f"<div class=page>{piece}<div>{ARTICLE}</div></div>",
        ):
            assert main_text(page(body)) == CLEAN, (name, body[:60])
    everything = "".join(BESIDE.values())
    assert main_text(page(f"{everything}<article>{ARTICLE}</article>{everything}")) == CLEAN
    assert main_text(page(f"{everything}<article>{ARTICLE}</article>{everything}").removesuffix("</body></html>")) == CLEAN


def test_article_text_stays():
    body = "<p>" + "long text " * 40 + "</p>"
    text = ("long text " * 40).strip()
    for outer in ("<div class=page>{}</div>", "<div><div class=page>{}</div></div>", "{}"):
        got = main_text(page(outer.format(f"<h1>Head</h1><p>lead</p><div>{body}</div>")))
        assert got == f"Head\n\nlead\n\n{text}"
    assert main_text(page(f"<article>{body}</article><article><p>Short one.</p></article>")) == f"{text}\n\nShort one."
    for opened in (
        '<article class="post comments-open">', '<article class="post tag-social-media">', '<div class="has-sidebar"><article>',
        '<div class="layout-sidebar"><article>', '<div class="sidebar"><article>', '<div class="sidebar-layout"><div>',
        '<div class="layout with-comments"><div>', '<div class="page-header-layout"><section class="related-all"><article>',
    ):
        assert main_text(page(f"{opened}{body}")) == text, opened
        assert main_text(page(f"{opened}{body}<div class=related-links><p>Read more</p></div>")) == text, opened
    related = "<section class='related-posts'><article><p>Teaser</p></article></section>"
    assert main_text(page(f"<article>{body}</article>{related}")) == text
    assert main_text(page(f"<div>{body}</div>{related}")) == text
    assert main_text(page(f"<article>{body}</article><div class=comments><article class=comment>{body}</article></div>")) == text


def test_short_articles_and_odd_pages():
    assert main_text(page(f"{BESIDE['ad']}<article><p>Tiny.</p></article>{BESIDE['footer']}")) == "Tiny."
    assert main_text(page("<article></article>" + BESIDE["nav"])) == ""
    assert main_text(None) == "" and main_text("") == "" and main_text("   ") == ""
    assert main_text("plain words") == "plain words" and main_text("</div></p>a<b>c") == "ac"
    assert main_text(page("<article><p>a &lt;b&gt; &#233;&nbsp;c</p></article>")) == "a <b> é c"
    assert main_text(page("<p>" * 3_000 + "deep")) == "deep"
    assert len(main_text(page("<article>" + "<p>word</p>" * 20_000 + "</article>"))) == 4 * 20_000 + 2 * 19_999


def test_smoothing_keeps_constants_and_spreads():
    assert np.allclose(smoothed(np.full(7, 3.0)), 3.0)
    bump = smoothed(np.array([0.0, 0, 0, 10, 0, 0, 0]))
    assert bump.argmax() == 3 and bump[2] > bump[1] > 0 and np.allclose(bump, bump[::-1])


def test_table(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, "u", page(f"<article>{ARTICLE}</article>"), "t", 1), (None, None, None, None, None), (1, "u", "", "", 0)]
    got = sorted(extract(spark.createDataFrame(rows, schema)).collect(), key=lambda r: -r["n_chars"])
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in got[:1]] == [(1, CLEAN, len(CLEAN))]
    assert [r["text"] for r in got[1:]] == ["", ""] and len(got) == 3
    assert extract(spark.createDataFrame([], schema)).count() == 0


LONG = "long text of the article that goes on and on " * 10
LINKS = "".join(f"<li><a href=x{k}>Other story {k}</a></li>" for k in range(12))


def test_ratios_decide_over_marks(monkeypatch):
    cards = "".join(f"<article class=card><a href=x><b>Card</b> <i>{k}</i></a></article>" for k in range(12))
    body = "".join(f"<p>{k} {LONG}</p>" for k in range(4))
    text = "\n\n".join(f"{k} {LONG.strip()}" for k in range(4))
    assert main_text(page(f"{cards}<div class=story>{body}</div>")) == text
    assert main_text(page(f"<div>{cards}</div><div><h1>Head</h1>{body}</div><div>{cards}</div>")) == f"Head\n\n{text}"
    with_links = page(f"<article>{body}<ul>{LINKS}</ul></article>")
    assert main_text(with_links) == text
    plain_list = "".join(f"<li>Point {k}</li>" for k in range(12))
    points = "\n\n".join(f"Point {k}" for k in range(12))
    assert main_text(page(f"<article>{body}<ul>{plain_list}</ul></article>")) == f"{text}\n\n{points}"
    assert main_text(page(f"<article><ul>{LINKS}</ul></article>")).count("Other story") == 12
    monkeypatch.setattr("sanitaria.llm.htmltext.content_lines", lambda lines, prior: np.ones(len(lines), dtype=bool))
    assert main_text(with_links) != text


def test_odd_pages_take_linear_time():
    begun = time.process_time()
    for piece in ('<a b="', "<!--", "<div>x", "<div class=menu>x", "</section><div>y", "<article>", "<![CDATA[", "<!x "):
        main_text(page(f"<article><p>{LONG}</p></article>") + piece * 20_000)
        main_text(piece * 20_000 + f"<p>{LONG}</p>" + "</div>" * 20_000)
    assert time.process_time() - begun < 40
    assert main_text("<article><p>Whole.</p></article><p>cut <a href='") == "Whole."
