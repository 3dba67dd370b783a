import random

from ordermill.llm import extraction
from tests.llm import cases

LONG = "The quick fox is in the garden and it was with the hen that had been there for a year, as they say in this part of the country."
NOTE = "We use cookies on this site and that is the way it is for all of you who read this with us, as you know from the last time."
LINKS = "".join(f'<li><a href="/{k}">Link number {k}</a></li>' for k in range(8))


def text_of(html):
    texts, _, kept = extraction.labelled([html])
    return " ".join(t for t, k in zip(texts, kept, strict=True) if k)


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>{LONG}</title><style>p {{}}</style></head><body class="home has-sidebar"><header><h1>Site</h1><p>{LONG}</p></header>
    <nav><ul>{LINKS}</ul></nav><!-- <p>{LONG}</p> --><div id="cookie-notice"><p>{NOTE}</p></div><div class="ad">{NOTE}</div>
    <article><header><h1>A title</h1><p class="by">By Ann</p></header><p>Sh is.</p><p>{LONG}</p><p>One<b>word</b> &amp; two&nbsp;more &lt;p&gt;<br>line</p>
    <form><p>{NOTE}</p></form><p>Inner <span class="ad">buy now</span>words.</p><aside>{NOTE}</aside><p>The end.</p><footer>Tags</footer></article>
    <section class="comments"><article><p>{LONG}</p></article></section><div class="sidebar"><p>{NOTE}</p></div><footer>&copy; 2020 {LONG}</footer>
    <script>if (a < b) document.write("<p>{LONG}</p>");</script></body></html>"""
    assert text_of(page) == f"A title Sh is. {LONG} Oneword & two more <p> line Inner words. The end."


def test_page_without_marks_goes_by_words_length_and_neighbours():
    page = f"""<div><ul>{LINKS}</ul></div><div><h2>Some heading</h2><p>Short first.</p><p>{LONG}</p><p>Short middle.</p><p>{LONG}<p>Short end.</div>
    <div><p>zqx wvk qqz trw plk mnb vcx zas dfg hjk lpo iuy tre wqa sdf ghj klm nbv cxz asd fgh jkl poi qwe rty</p><p>Impressum</p></div><div><p>{LONG}</p><p>Last.</p></div>"""
    assert text_of(page) == f"Some heading Short first. {LONG} Short middle. {LONG} Short end. {LONG} Last."


def test_short_article_and_article_without_stop_words():
    assert text_of("<nav><ul>" + LINKS + "</ul></nav><article><h1>Ab cd.</h1><p>Xy.</p></article><footer>Foot</footer>") == "Ab cd. Xy."
    odd = "zqx wvk qqz trw plk mnb vcx zas dfg hjk lpo iuy tre wqa sdf ghj klm nbv cxz asd fgh jkl poi qwe rty"
    assert text_of(f"<main><p>{odd}</p></main><p>{LONG}</p>") == odd


def test_links_decide_about_a_block():
    assert text_of(f"<article><p>{LONG}</p><ul>{LINKS}</ul><p>See <a href='x'>the garden</a> and the hen that was in it for all of the year with them.</p></article>") == (
        f"{LONG} See the garden and the hen that was in it for all of the year with them.")


def test_broken_markup_is_read_to_its_end():
    for page in ("<article><p><b>Text <i>here<p>and here", "<article><p>Text here</div></span><p>and here<!-- open", "<article><p>Text here<p>and here<script>var a = '<p>x</p>'",
                 "<article><p class='it's odd\">Text here</p><p title=\"a > b\">and here</p>", "<article><p>Text here<p>and here</article"):
        assert text_of(page) == "Text here and here", page
    assert text_of("a < b and <3 &am &amp c &#233;&eacute;&notareference;") == ""  # a short line on its own is no article
    assert text_of("<article>a < b and <3 &am &amp c &#233;&eacute;&nothing;</article>").startswith("a < b and <3 &am & c éé")


def test_attributes_are_read_by_name():
    assert not extraction.marked(' data-hidden="x" title="class=ad hidden" class="article-body bread"')
    assert extraction.marked(' CLASS="Top Cookie-Bar"') and extraction.marked(" hidden") and extraction.marked(" id=comments") and extraction.marked(' style="DISPLAY: none"')


def test_order_and_neighbours_equal_a_plain_loop():
    """The second pass against a search block by block."""
    import numpy as np

    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 40)
        page = np.sort([rng.randint(0, 3) for _ in range(n)])
        container = np.array([rng.randint(0, 3) for _ in range(n)])
        label = np.array([rng.choice([0, 0, 1, -1]) for _ in range(n)], np.int8)
        heading, article = (np.array([rng.random() < share for _ in range(n)]) for share in (0.2, 0.3))
        expected = []
        for k in range(n):
            def sides(same):
                group = [i for i in range(n) if same(i)]
                me = group.index(k)
                before = next(((label[i], d) for d, i in enumerate(reversed(group[:me]), 1) if label[i]), (0, 99))
                after = next(((label[i], d) for d, i in enumerate(group[me + 1:], 1) if label[i]), (0, 99))
                return before, after

            (b, db), (a, da) = sides(lambda i: page[i] == page[k] and container[i] == container[k])
            if label[k]:
                verdict = label[k]
            elif a or b:
                verdict = a if heading[k] and a else b if db < da else a if da < db else max(a, b)
            elif article[k]:
                verdict = 1
            else:
                (b, _), (a, _) = sides(lambda i: page[i] == page[k])
                verdict = a if heading[k] else min(a, b)
            expected.append(verdict > 0)
        assert extraction.second_pass(label, page, container, heading, article).tolist() == expected


def test_pages(spark):
    rows = [(1, "u", f"<article><p>{LONG}</p></article>"), (1, "u", f"<article><p>{LONG}</p></article>"), (2, None, None), (3, "v", ""), (None, None, "<p></p>"),
            (4, "w", "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = extraction.main_text(cases.clashing(pages, "text", "N_chars"))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    expected = [(1, "u", LONG, len(LONG))] * 2 + [(2, None, "", 0), (3, "v", "", 0), (None, None, "", 0)]
    whole = " ".join([LONG] * 3000)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([*expected, (4, "w", whole, len(whole))], key=repr)
    assert extraction.main_text(spark.createDataFrame([], pages.schema)).count() == 0
