import random
import time

import pytest

from quayside.llm.html_text import INLINE_WEIGHT, TAG_WEIGHT, PageModel, Token, _best_run, _zone, extract, extract_pages, fit

PRIOR = PageModel({}, {})
LAYOUT = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{}}</style></head><body>
<header class="site"><a href=/>Home of the paper</a></header><nav><ul><li>One<li>Two more</ul></nav>
<div id="cookie-notice"><p>We use cookies on this site to do things you want us to do.</p></div>
{open}<h1>A &lt;title&gt; &amp;&amp; more</h1><p>First   para with <a href=x>a
link</a> and<br>bold<p>Second one is longer, with many more words than the first one had.
<ul><li>item one here<li>item two here</ul><div class="ad-box">Buy now</div><aside>Related</aside><form>Subscribe</form>
<script>var x="<p>no</p>";</script><!-- <p>no</p> --><p>The last paragraph of the text.</p>{close}
<div class="sidebar"><p>Popular posts with many words in the sidebar are here</p></div>
<section class="comments"><p>Reader: I think that this is great</p></section><footer>&copy; 2020</footer></body></html>"""
TEXT = """A <title> && more
First para with a link and
bold
Second one is longer, with many more words than the first one had.
item one here
item two here
The last paragraph of the text."""


def test_layouts():
    for open_, close in (("<article>", "</article>"), ('<div class="main-content">', "</div>"), ("<main>", "</main>")):
        assert extract(LAYOUT.format(open=open_, close=close), PRIOR) == TEXT


def test_odd_pages():
    assert extract(None, PRIOR) == extract("", PRIOR) == extract("<nav>only a menu</nav>", PRIOR) == ""
    assert extract("no markup a < b", PRIOR) == "no markup a < b"
    assert extract("<p>open <b>never <i>closed", PRIOR) == "open never closed"
    long = "<article>" + "<p>word and word</p>" * 20_000 + "</article>"
    assert extract(long, PRIOR) == "\n".join(["word and word"] * 20_000)


def test_learned_weights(spark):
    """A box without a telling name is told apart on marked pages, and then on others too."""
    box = "<div class='zz9'><p>seen on every page of this place</p></div>"
    rows = [(i, f"<body>{box}<article><p>content number {i} with words</p></article>{box}</body>") for i in range(40)]
    rows += [(100, f"<body>{box}<div class='q'><p>plain page with its own words in it</p></div></body>"), (101, None), (101, None)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumnRenamed("url", "text")
    model = fit(df)
    assert model.weight("div.zz9", "p") < 0 < model.weight("article", "p")
    got = {r["page_id"]: r["text"] for r in extract_pages(df, model).collect()}
    assert got[7] == "content number 7 with words"
    assert got[100] == "plain page with its own words in it"
    assert got[101] == ""
    assert fit(df.limit(0)).zones == {}


def test_scripts_are_not_markup():
    """What a raw element holds ends at its end tag only, whatever it looks like."""
    scripts = (
        "for(i=0;i<n;i++){f(i)}", "for(i=0;i<n;i++){f(\"it's\")}", "x = '<!-- never closed';", "<![CDATA[ x", "<!doctype", 'a<b?"\'', "a<b",
        "s='</scripted>'+'</ script>'",
    )
    for script in scripts:
        for end in ("</script>", "</SCRIPT >", "</script\n>"):
            page = f"<body><script>{script}{end}<article><p>Text of the article</p></article><script>g()</script></body>"
            assert extract(page, PRIOR) == "Text of the article", (script, end)
    assert extract("<p>Text before</p><style>a<b {} <p>no</p>", PRIOR) == "Text before"
    assert extract("<title>1 <2 & <!-- 3</Title><p>Text behind</p>", PRIOR) == "Text behind"


def test_zones_with_many_names(spark):
    """Names count however late they stand, and zones that differ in a late name only are two."""
    many = " ".join(f"a{i:03}-utility" for i in range(40))
    story = "<p>The story has a few words of its own.</p>"
    side = f'<div class="{many} sidebar"><p>Popular things with many more words than the story itself has, all of them in a box</p></div>'
    assert extract(f"<body>{side}<div class=q>{story}</div>{side}</body>", PRIOR) == "The story has a few words of its own."
    rest = "<div class='q1'><p>some</p></div>" * 20
    assert extract(f'<div class="{many} story"><p>Few</p></div>{rest}', PRIOR).startswith("Few")
    assert PRIOR.weight(_zone("div", f'class="{many} story"'), "p") == 3.0
    assert PRIOR.weight(_zone("div", f'class="{many} sidebar"'), "p") == -3.0
    assert PRIOR.weight(_zone("div", f'class="{many}"'), "p") == 0.5
    rows = [(i, f'<div class="{many} z1"><p>box of page</p></div><article><div class="{many} z2"><p>content {i}</p></div></article>')
            for i in range(40)]
    model = fit(spark.createDataFrame(rows, "page_id long, html string"))
    assert model.weight(_zone("div", f'class="{many} z1"'), "p") < 0 < model.weight(_zone("div", f'class="{many} z2"'), "p")


STORY = "<h1>A title of the story</h1><p>The story has a few words of its own.</p><p>And some more of them here.</p>"
TOLD = "A title of the story\nThe story has a few words of its own.\nAnd some more of them here."
MENU = "<nav><ul><li>One<li>Two more</ul></nav><div class='sidebar'><ul><li class='post'>Popular things are here</ul></div>"


@pytest.mark.parametrize("frame", [
    '<body class="has-sidebar">{}</body>', '<html class="header-fixed"><body class="single-post">{}</body></html>',
    '<body><div id="page" class="header-fixed"><div class="search share">{}</div></div></body>', '<form id="aspnetForm">{}</form>',
    '<body><a href=#c>Skip</a><div class="no-sidebar">{}</div></body>',
])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<main class='header-fixed'>{}</main>", "<div class=content>{}</div>", "<div class=q>{}</div>"])
def test_frames_around_the_content(frame, inner):
    """Names of what encloses the content do not speak against it; those of what stands beside it do."""
    assert extract(frame.format(MENU + inner.format(STORY) + "<footer>The foot</footer>"), PRIOR) == TOLD


def test_boxes_are_not_frames():
    box = "<div class='{}'><div class='content'><p>Many words stand in this box, more than in the story, and all are beside it. Read on.</p></div></div>"
    for name in ("sidebar", "comments", "related"):
        for inner in ("<article>{}</article>", "<div class=content>{}</div>", "<main>{}</main>"):
            assert extract(f"<body>{inner.format(STORY)}{box.format(name)}</body>", PRIOR) == TOLD
            assert extract(f"<body class='has-sidebar'>{box.format(name)}{inner.format(STORY)}</body>", PRIOR) == TOLD
    assert extract("<footer><div class=content>Only a footer</div></footer>", PRIOR) == ""
    assert extract("<div class=sidebar><p>Only a box</p></div>", PRIOR) == ""


def test_counted_zones_outvote_names(spark):
    rows = [(i, f"<div class='header-fixed' id='page'>{MENU}<article><div class='zz'><p>content {i} has words</p></div></article></div>")
            for i in range(40)]
    model = fit(spark.createDataFrame(rows, "page_id long, html string"))
    assert model.weight("nav", "li") < 0 < model.weight("div.zz", "p")
    assert extract(rows[3][1], model) == "content 3 has words"
    assert extract(f"<div class='share-box'><div class='zz'>{STORY}</div></div>", model) == TOLD


@pytest.mark.parametrize("page", [
    "<a " * 60_000, "<div>" * 20_000 + "</span>" * 20_000, "<!" * 90_000, '<a ">" ' * 30_000 + "'", "<a '" * 50_000 + ">",
    "<div class=sidebar>" * 9_000 + "text", "<main>" * 30_000, "<p><div>" + "<span>" * 9_000 + "<p></p>" * 9_000, "< " * 90_000,
    "<b>" * 30_000 + "</b>" * 30_000, "<svg/>" * 30_000,
])
def test_time_grows_with_length_only(page):
    begin = time.process_time()
    extract(page, PRIOR)
    assert time.process_time() - begin < 2


def test_scripts_in_any_spelling_are_no_text():
    article = "<article><p>The words of the article.</p>{}<p>And more of them.</p></article>"
    for script in ("<script async/>var a = 1; call(a)</script>", "<script src=/a/b/>x y z</script>", "<SCRIPT>if (a<b) {</script >",
                   "<style media=x/>p { }</style>", "<textarea/>typed</textarea>"):
        assert extract(article.format(script), PRIOR) == "The words of the article.\nAnd more of them."
    # Nothing ends the element: it is empty, as in a page in the manner of XML.
    assert extract(article.format("<script src='x'/>"), PRIOR) == "The words of the article.\nAnd more of them."
    assert extract("<p>2 < 3 <b>and</b> a<b c", PRIOR) == "2 < 3 and a<b c"


def _maximum_run(scores):
    """Best sum over all runs, by trying each."""
    best = 0.0
    for i in range(len(scores)):
        total = 0.0
        for score in scores[i:]:
            total += score
            best = max(best, total)
    return best


def test_the_run_scores_most_of_all_runs():
    rng = random.Random(2)
    for _ in range(150):
        tokens, scores = [], []
        for k in range(rng.randint(0, 40)):
            zone = rng.choice(["div.content", "div.menu", "div"])
            if rng.random() < 0.4:
                breaks = rng.random() < 0.5
                tokens.append(Token(None, zone, "p", False, breaks, False, False, zone))
                scores.append(TAG_WEIGHT if breaks else INLINE_WEIGHT)
            else:
                n = rng.randint(1, 4)
                tokens.append(Token(f" w{k}" * n, zone, "p", False, False, False, False, zone))
                scores.append(PRIOR.weight(zone, "p") * n)
        text = _best_run(tokens, PRIOR, [t.zone for t in tokens])
        kept = set(text.split())
        best = _maximum_run(scores)
        # The words of the run found, and the tags between them, score what the best run does.
        places = [i for i, t in enumerate(tokens) if t.text and kept & set(t.text.split())]
        found = sum(scores[places[0] : places[-1] + 1]) if places else 0.0
        assert abs(found - best) < 1e-9


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "<p>a b c d</p>", "old", 5, None), (1, None, "old", 6, "x")], "page_id long, html string, text string, zone int, main_text string")
    got = extract_pages(df, PRIOR).orderBy("zone").collect()
    assert [(r.text, r.zone, r.main_text) for r in got] == [("a b c d", 5, None), ("", 6, "x")]
