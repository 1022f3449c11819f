import html as ht
import itertools
import random
import re

from labelfold.llm import html_mincut as m


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in m.extract_text(pages).collect()}
    for r in pages.collect():
        a = r.html[r.html.index("<article>") + 9:]
        a = a[:a.index("</article>")]
        want = " ".join(ht.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", a))).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def brute_cut(costs, parents):
    """The cheapest labelling by trying all of them."""
    best = None
    hubs = sorted(set(parents))
    for labels in itertools.product((True, False), repeat=len(costs)):
        for hub in itertools.product((True, False), repeat=len(hubs)):
            side = dict(zip(hubs, hub))
            c = sum(abs(round(z * m.SCALE)) for z, on in zip(costs, labels) if (z >= 0) != on)
            c += sum(round(m.NEIGHBOUR * m.SCALE) for a, b in zip(labels, labels[1:]) if a != b)
            c += sum(round(m.SIBLING * m.SCALE) for on, p in zip(labels, parents) if on != side[p])
            best = c if best is None else min(best, c)
    return best


def cost_of(labels, costs, parents):
    hubs = {}
    for on, p in zip(labels, parents):
        hubs.setdefault(p, []).append(on)
    c = sum(abs(round(z * m.SCALE)) for z, on in zip(costs, labels) if (z >= 0) != on)
    c += sum(round(m.NEIGHBOUR * m.SCALE) for a, b in zip(labels, labels[1:]) if a != b)
    return c + sum(round(m.SIBLING * m.SCALE) * min(sum(x), len(x) - sum(x)) for x in hubs.values())


def test_cut_is_minimal():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 7)
        costs = [rng.choice([-1, 1]) * rng.uniform(0.05, 2) for _ in range(n)]
        # signs alternate or parents differ, so every block is a run of its own
        parents = list(range(n)) if rng.random() < 0.5 else [i % 2 for i in range(n)]
        runs = [(z >= 0, p) for z, p in zip(costs, parents)]
        if any(a == b for a, b in zip(runs, runs[1:])):
            continue
        labels = m.label_blocks(costs, parents)
        assert cost_of(labels, costs, parents) == brute_cut(costs, parents)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header>
<nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><div class="cookie-notice">We use cookies. Accept them.</div>
<main><article><header><h1>The&nbsp;title &amp more</h1></header><p>First <b>bold</b>text, one.<p>Second&#33; <a href=x>link</a>
with <i>more</i>.<div class="ad">Buy now.</div><script>var x = "<p>no</p>";</script><blockquote>A quote stands here.</blockquote>
<form><label>Mail</label><input></form><section id="comments"><p>Nice article, I like it a lot.</p></section></article></main>
<aside><p>Read also this other long story about things.</p></aside><footer><p>Copyright by us.</p></footer></body></html>"""


def test_parts_of_a_page():
    assert m.main_text(PAGE) == "The title & more First boldtext, one. Second! link with more. A quote stands here."


def test_broken_pages():
    for i in range(0, len(PAGE), 7):
        assert isinstance(m.main_text(PAGE[:i]), str)
    assert m.main_text("") == "" and m.main_text("<p>") == "" and m.main_text("</p></div>") == ""
    assert m.main_text("<article><p>cut off in <b>the mid") == "cut off in the mid"
    assert m.main_text("<article>" + "<div>" * 3000 + "deep text stands here.") == "deep text stands here."


def test_odd_rows(odd_pages):
    rows = m.extract_text(odd_pages).collect()
    assert len(rows) == odd_pages.count()
    assert {r.page_id: r.text for r in rows}[3] == ""
    assert m.extract_text(odd_pages.limit(0)).count() == 0


TEXT = [f"Paragraph {i} of the main text tells a long and quiet story about the river, the hills and the {w} that people "
        "see there on their way through the country in the summer months." for i, w in enumerate(("birds", "fish", "trees"))]
PARAS = "".join(f"<p>{t}</p>" for t in TEXT)
MENU = "<ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul>"


def test_marks_do_not_swallow_a_page():
    want = " ".join(TEXT)
    assert m.main_text(f"<form id='aspnetForm'><nav>{MENU}</nav><div>{PARAS}</div></form>") == want
    for name in ("content has-sidebar", "header-fixed", "page has-sidebar", "with-widget"):
        assert m.main_text(f"<div class='{name}'><nav>{MENU}</nav>{PARAS}<footer>Copyright by us.</footer></div>") == want
    assert m.main_text(f"<nav>{MENU}<div>{PARAS}</div>") == want  # never closed
    assert m.main_text(f"<nav>{MENU}<article>{PARAS}</article>") == want
    assert m.main_text(f"<div class='sidebar'><main>{PARAS}</main></div><div>x</div>") == want
    head = "<div class='entry-header'><h1>The title</h1></div>"
    assert m.main_text(f"<article>{head}{PARAS}</article>") == "The title " + want
    assert m.main_text(f"<article><div class='post form'>{PARAS}</div></article>") == want


def test_a_teaser_does_not_hide_the_text():
    got = m.main_text(f"<div id=content>{PARAS}</div><div><article><p>Short teaser here.</p></article></div>")
    assert " ".join(TEXT) in got


def test_marked_parts_stay_out():
    want = " ".join(TEXT)
    assert m.main_text(f"<article>{PARAS}</article><section id=comments><article class=comment><p>{TEXT[0]}</p></article>"
                       "</section><aside><article><p>Read also this story.</p></article></aside>") == want
    assert m.main_text(f"<nav>{MENU}</nav><div class='main-menu'>{MENU}</div>") == ""


def test_cut_is_minimal_with_runs():
    rng = random.Random(8)
    for _ in range(120):
        n = rng.randint(1, 8)
        costs = [rng.choice([-0.3, 0.3, rng.uniform(-2, 2), rng.uniform(-0.5, 0.5)]) for _ in range(n)]
        parents = [rng.randrange(2) for _ in range(n)] if rng.random() < 0.6 else [0] * n
        labels = m.label_blocks(costs, parents)
        assert cost_of(labels, costs, parents) == brute_cut(costs, parents)
    assert m.label_blocks([3.0] * 4 + [-0.3] * 6 + [3.0] * 4, [0] * 14) == [True] * 14


def test_many_undecided_blocks():
    """Long pages of blocks that nothing decides at once stay fast."""
    import time
    rng = random.Random(9)
    for parents in ([0] * 20_000, [i // 7 for i in range(20_000)], list(range(20_000))):
        start = time.time()
        m.label_blocks([rng.uniform(-1.5, 1.5) for _ in parents], parents)
        assert time.time() - start < 20


def test_broken_markup_is_read_in_one_pass():
    import time
    for piece in ('<a x="', "<a x='", "<!-- ", "<b><p>", "<b><b><b><div></div>", "<", "</i>", "<script>", "<![CDATA[", "<p a=b ", "</",
                  "<p/a=", "<li><ul>", "<a x=\"'"):
        start = time.time()
        blocks = m.read_blocks("<p>before</p>" + piece * (400_000 // len(piece)))
        assert time.time() - start < 5, piece
        assert blocks[0][1] == "before"


def test_tags_as_browsers_read_them():
    def texts(page):
        return [t for _, t in m.read_blocks(page)]
    assert texts("a<p title='x>y'>b</P >c<br/>d") == ["a", "b", "c", "d"]
    assert texts('<p a="1"b=2 c d = "<p>" / e>one</p><!-- <p>no --> two <!doctype x> three') == ["one", "two three"]
    assert texts("<p>1 < 2 &lt; 3 &amp 4 <5</p>") == ["1 < 2 < 3 & 4 <5"]
    assert texts("<script>if (a </b) '</p>'</script>x<style>p{}</STYLE >y") == ["x", "y"]
    assert texts("<p>x<![CDATA[ <b>no</b> ]]>y<?php no ?>z</>!") == ["xyz!"]
    assert texts("<p>kept<p class='cut off") == ["kept"]
    assert texts("<!-->a<!--->b") == ["ab"]


def test_no_mark_is_beyond_the_classifier():
    assert all(abs(v) < m.MOST for v in m.ZONE_ODDS.values())
