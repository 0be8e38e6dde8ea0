from .conftest import PAGES, SF

from ledgerlens.llm import html_main_text as m

PAGE = """<!DOCTYPE html><html><head><title>Site title words</title><style>p{color:red}</style>
<script>if (a < b) { document.write("<p>not text</p>"); }</script></head><body class="home">
<header class="site-header"><a href="/">Home of the site</a></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="ad">Buy this now and here</div>
<article><header><h1>The   heading</h1></header><p>First &amp; best &eacute; par&#97;graph, with a <b>bold</b> word.
Second line of it.</p><div class="ad-banner">Advert inside of the article</div>
<p>Second paragraph<br>after a break, 1 < 2.<p>Third, left open<aside>Related things to read</aside><p>Last one.</article>
<div id="comments"><p>A reader says something rather long about this article here</p></div>
<form><input value="x"><button>Send</button>Your name</form><footer>&copy; someone, all rights</footer></body></html>"""

TEXT = ("The heading\nFirst & best é paragraph, with a bold word. Second line of it.\n"
        "Second paragraph after a break, 1 < 2.\nThird, left open\nLast one.")


def test_priors_and_learned_weights_find_the_article(spark):
    pages = spark.createDataFrame([(i, "u", PAGE) for i in range(5)], PAGES)
    assert m.main_text(PAGE, m.Weights()) == TEXT
    assert m.main_text(PAGE, m.learned(pages)) == TEXT


def test_pages_without_an_article_element():
    page = PAGE.replace("<article><header>", "<div class='post'>").replace("</h1></header>", "</h1>").replace(
        "</article>", "</div>")
    assert m.main_text(page, m.Weights()) == TEXT


WRAPPERS = ("layout has-sidebar", "no-sidebar", "with-nav", "search-results", "social-media-post")


def test_wrappers_with_the_names_of_parts_keep_the_article():
    skip = "<body class=\"home\"><a href='#x'>Skip to content</a> 3 May 2020 "
    for name in WRAPPERS:
        for tag in ("div", "section", "main"):
            page = PAGE.replace('<body class="home">', f"{skip}<{tag} class='{name}'>").replace("</body>", f"</{tag}></body>")
            assert m.main_text(page, m.Weights()).endswith(TEXT), (name, tag)
        page = PAGE.replace('<body class="home">', skip).replace("<article>", f"<article class='{name}'>")
        assert m.main_text(page, m.Weights()).endswith(TEXT), name
        body = " ".join(f"w{i}" for i in range(400))  # no article element
        page = f"{skip}<div class='{name}'><div class='sidebar'>Some links to read</div><p>{body}</p></div></body>"
        assert m.main_text(page, m.Weights()).split("\n")[-1] == body, name
        assert "Some links" not in m.main_text(page, m.Weights()), name


def test_parts_beside_an_article_stay_out_whatever_they_hold():
    thread = " ".join(f"c{i}" for i in range(400))
    page = PAGE.replace("A reader says", f"<article class='comment'>{thread}</article><article>{thread}</article> says")
    assert m.main_text(page, m.Weights()) == TEXT


def test_best_run_is_the_maximum_scoring_subsequence():
    import itertools
    import random

    rng = random.Random(3)
    for _ in range(300):
        s = [rng.choice([-3, -1, 0.5, 1, 2]) for _ in range(rng.randint(0, 12))]
        b, e = m.best_run(s)
        best = max([0.0, *(sum(s[i:j]) for i, j in itertools.combinations(range(len(s) + 1), 2))])
        assert sum(s[b:e]) == best


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain words only"), (3, "u", "<p>a"), (3, "u", "<p>a"),
            (4, "u", "<" * 50), (5, "u", "<article>" + "<p>word</p>" * 20_000 + "</article>"), (6, "u", "<!-- open")]
    pages = spark.createDataFrame([r + ("clash",) for r in rows], PAGES + ", text string")
    got = [tuple(r) for r in m.extracted(pages, m.learned(pages)).collect()]
    assert [(r[0], r[2]) for r in got[:5]] == [(1, ""), (2, ""), (None, "plain words only"), (3, "a"), (3, "a")]
    assert got[6][2] == "\n".join(["word"] * 20_000) and all(r[3] == len(r[2]) for r in got) and len(got) == 8
    none = spark.createDataFrame([], PAGES)
    assert m.extracted(none, m.learned(none)).count() == 0


def test_given_pages_match_a_plain_reading(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in m.extracted(pages, m.learned(pages)).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S).group(1)
        inner = re.sub(r"<[^>]+>", lambda t: "" if re.match(r"</?(b|br)\b", t[0]) else "\n", inner)
        lines = [" ".join(html.unescape(x).split()) for x in inner.split("\n")]
        assert got[r.page_id] == "\n".join(x for x in lines if x)


def article(inside):
    return f"<html><body><nav>Menu of links</nav><article><p>First words here.</p>{inside}<p>Last words here.</p></article></body></html>"


def test_elements_that_nothing_ends_drop_nothing_after_them():
    for name in ("svg", "iframe", "textarea", "object", "template", "noscript", "math"):
        for tag in (f'<{name} class="i"/>', f"<{name}/>", f"<{name} src=x>", f"<{name.upper()}>"):
            got = m.main_text(article(f"<p>x {tag} after it</p><p>middle</p>"), m.Weights())
            assert got == "First words here.\nx after it\nmiddle\nLast words here.", (tag, got)


def test_text_of_math_object_and_noscript_stays_and_code_goes():
    got = m.main_text(article("<p>where <math><mi>alpha</mi><mo>=</mo></math> holds</p><object data=x><p>in the object</p></object>"
                              "<noscript><p>without scripts</p></noscript><p>a<svg><title>no</title></svg>b "
                              "<script>if (a<b) no();</script><style>no{}</style><iframe>no</iframe><template>no</template>c</p>"), m.Weights())
    assert got == "First words here.\nwhere alpha= holds\nin the object\nwithout scripts\nab c\nLast words here."


def test_topics_inside_the_article_are_no_parts_beside_it():
    prose = "A paragraph about this very matter, with a <a href=x>link</a> in it."
    for tag in ("div", "section"):
        for name in ("related-work", "social", "search-algorithm", "ad-hoc-networks", "notice-period", "share"):
            got = m.main_text(article(f'<{tag} class="{name}"><p>{prose}</p></{tag}>'), m.Weights())
            assert "this very matter" in got and got.endswith("Last words here."), name
        for inside in ('<{0} class="comments">{1}</{0}>', '<{0} id="comment-list">{1}</{0}>', '<{0} class="ad">{1}</{0}>',
                       '<{0} class="notice">{1}</{0}>', '<{0} role="search">{1}</{0}>', '<{0} class="x ad-slot">{1}</{0}>',
                       '<{0} class="related"><a href=a>Some other page</a> <a href=b>and this very matter</a></{0}>',
                       '<{0} class="share-buttons"><a href=a>this very matter</a></{0}>'):
            got = m.main_text(article(inside.format(tag, prose)), m.Weights())
            assert "this very matter" not in got and got.endswith("Last words here."), inside


def plain_scan(page):
    """The definition of ``scan`` read literally, looking at the whole rest for every sign."""
    out, text, i, quotes = [], "", 0, True
    alone = ("script", "style", "svg", "iframe", "textarea", "template")

    def named(rest):
        return next((k for k in range(len(rest)) if rest[k] in " \t\n\r\x0b\x0c/>"), len(rest))

    def find(name, at, ends_only):
        low = page.lower()
        for k in range(at, len(page)):
            for sign in ("</",) if ends_only else ("</", "<"):
                if low.startswith(sign + name, k) and not low[k + len(sign + name):k + len(sign + name) + 1].strip(
                        " \t\n/>'\"=<!?").isalnum() and low[k + len(sign + name):k + len(sign + name) + 1] != "-":
                    return k, sign == "</"
        return None

    while i < len(page):
        if page[i] != "<":
            text += page[i]
            i += 1
            continue
        if page.startswith("<!--", i):
            end = page.find("-->", i + 2)
            if text:
                out.append(("text", "", text))
            text, i = "", end + 3 if end >= 0 else len(page)
            continue
        if ">" not in page[i:]:
            text += page[i:]
            break
        close = page.startswith("</", i)
        at = i + 1 + close
        is_tag = page[at:at + 1].isascii() and page[at:at + 1].isalpha()
        if not is_tag and page[i + 1] not in "!?":
            text += "<"
            i += 1
            continue
        name_end = at + named(page[at:])
        end = None
        if is_tag and quotes:
            k, inside = name_end, None
            while k < len(page) and end is None:
                if inside:
                    inside = None if page[k] == inside else inside
                elif page[k] == ">":
                    end = k
                elif page[k] in "\"'" and page[name_end:k].rstrip().endswith("="):
                    inside = page[k]
                k += 1
            quotes = end is not None
        if end is None:
            end = page.index(">", i)
        if text:
            out.append(("text", "", text))
        text, start, i = "", i, end + 1
        if not is_tag:
            continue
        name, body = page[at:name_end].lower(), page[name_end:end]
        if close or name not in alone:
            out.append(("close" if close else "open", name, body))
            continue
        out.append(("alone", name, ""))
        single = body.endswith("/")
        if single and name not in ("script", "style"):
            continue
        found = find(name, i, name in ("script", "style") and not single)
        if found is None:
            if name in ("script", "style") and not single:
                return out
            continue
        if found[1]:
            end = page.find(">", found[0] + 2 + len(name))
            i = end + 1 if end >= 0 else len(page)
    return out + [("text", "", text)] * bool(text)


def test_scan_of_malformed_pages_against_reading_them_literally():
    import random

    rng = random.Random(9)
    parts = ["<", ">", "</", "/>", "<p>", "</p>", "<svg", "</svg>", "<svg/>", "<script>", "</script>", "<script/>", "<STYLE>", "</style >",
             "<iframe", "</iframe", "<!--", "-->", "<!x", "<a b='", "'", '"', "=", "= \"", " ", "w", "<textarea>", "</Textarea>", "<br/>",
             "<template x>", "</template>", "<svgx>", "1<2", "&lt;", "-"]
    for _ in range(6000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert [x[:3] for x in m.scan(page)] == plain_scan(page), page
        m.main_text(page, m.Weights())


def test_broken_pages_cost_what_they_are_long():
    import time

    pages = ["<a " * 100_000, '<a "' * 100_000, "<a x='" * 60_001, "<script" * 60_000, "<a x='>' " * 40_000, "<a x='>" * 50_001 + ">",
             "<svg>" * 70_000, "<script/>" * 40_000, "<!" * 150_000, "<!--" * 90_000, "<section>" * 30_000 + "</div>" * 30_000,
             "<iframe></iframe " * 20_000, "<div class='social'>" * 15_000, "<p class=" * 40_000 + ">", "<" * 300_000, "</" * 150_000]
    for page in pages:
        began = time.process_time()
        m.main_text(page, m.Weights())
        assert time.process_time() - began < 2, page[:20]


def test_the_sample_is_drawn_from_labelled_pages(spark, monkeypatch):
    monkeypatch.setattr(m, "LABELLED_PAGES", 20)
    rows = [(i, "u", PAGE if i % 50 == 0 else "<p>no label</p>") for i in range(2_000)]
    counts = {}
    count = m.labelled_counts

    def counted(pages):
        counts["n"] = pages.count()
        return count(pages)

    monkeypatch.setattr(m, "labelled_counts", counted)
    assert m.learned(spark.createDataFrame(rows, PAGES)).tags and 5 <= counts["n"] <= 40
