import itertools
import math
import time

from terracask.llm import html_extract as hx
from terracask.llm.dom import blocks

from .conftest import write

PAGES = "page_id bigint, url string, html string"


def texts(html):
    return [b.text for b in blocks(html)]


def test_blocks():
    assert texts("<p>a <b>b</b>\n c<br>d<p>e &amp; f&amp g &#233; &copy;</p>") == ["a b c d", "e & f& g é ©"]
    assert texts("<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><div>yes</div>") == ["yes"]
    assert texts("<ul><li>one<li>two</ul><table><tr><td>x<td>y</table>") == ["one", "two", "x", "y"]
    assert texts("text < 5 <p title='a>b' class=\"x\">ok</p> <script>unclosed") == ["text < 5", "ok"]
    assert texts("") == [] and texts("   \n ") == [] and texts("<p></p><!-- open") == []
    chain = blocks('<article class="Post main"><div id=body><p>x</p></div></article>')[0].chain
    assert chain == ("article.post.main", "div.body", "p")


def test_inline_content_keeps_its_block():
    assert texts("<p>a <svg><g><text>b</text></g></svg> c<script>x</script>d <math><mi>e</mi><mo>=</mo></math> <object><b>f</b></object> <canvas>g</canvas></p>") == ["a b cd e= f g"]
    assert texts("<svg><g><p>a</p><p>b</p>") == ["a", "b"] and texts("<svg/><div>a</div>b") == ["a", "b"]
    assert texts("a<xmp><p>1 &lt;\n2</p></xmp>b") == ["a", "<p>1 &lt; 2</p>", "b"]
    assert texts("<!-- a --!>b<!-- c --> d <!-- e --!> f<!-->g-->") == ["b d fg-->"]
    assert texts("<p>a<b <p>c") == ["ac"] and texts("x <b") == ["x <b"]
    many = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(40))
    assert len(blocks(f'<div class="{many}">x</div>')[0].node.words) == len({w for w in many.split()})


def test_hostile_pages_take_linear_time():
    start = time.perf_counter()
    for page in ("<b " * 350_000, '<b "' * 300_000 + ">", "<div>x" * 100_000, "<table>" + "<div>a</p>" * 100_000, "<!-- x -->a" * 100_000, "<script </script " * 60_000, "<" * 1_000_000):
        hx.extract_text(page, hx.built_in())
    deep = "".join(f"<x{i} class='c{chr(97 + i % 26)}'>t" for i in range(100_000))
    assert len(blocks(deep)) == 100_000
    assert time.perf_counter() - start < 60


#: Pages made by hand, in layouts that the labelled pages don't have, and their main text.
BY_HAND = [
    (
        """<html><body id="top"><div class="site-header"><a href="/">The Harbour Post</a><ul class="nav"><li><a href="/a">World</a></li><li><a href="/b">Sport</a></li></ul></div>
        <div id="content"><div class="post"><h1>Ferry service resumes after storm</h1><p>The ferry between the islands <a href="/x">resumed its service</a> on Monday.</p>
        <p>Harbour officials said that the damage to the pier was small, and that they share the relief of the islanders.</p></div></div>
        <div class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten walks</a></li><li><a href="/2">A new bridge</a></li></ul></div>
        <div class="footer">&copy; 2024 The Harbour Post. All rights reserved.</div></body></html>""",
        ["Ferry service resumes after storm", "The ferry between the islands resumed its service on Monday.", "Harbour officials said that the damage to the pier was small, and that they share the relief of the islanders."],
    ),
    (
        """<body><nav><a href="/">Home</a> <a href="/about">About</a></nav><main><h1>How to prune roses</h1><p>Cut above an outward bud.</p><div class="ad">Buy our shears now.</div><ol><li>Wear gloves.</li><li>Use sharp shears.</li></ol>
        <p>Water the plant well afterwards.</p></main><section class="comments"><h2>Comments</h2><p>anna wrote:</p><p>This helped me a lot, thank you for writing it.</p></section><footer><p>Privacy | Contact</p></footer></body>""",
        ["How to prune roses", "Cut above an outward bud.", "Wear gloves.", "Use sharp shears.", "Water the plant well afterwards."],
    ),
    (
        """<div class="cookie-notice"><p>We use cookies to improve this site. <button>Accept</button></p></div><article class="entry"><header><h1>Notes on tides</h1></header><p>Tides follow the moon.</p><blockquote>The sea is never still.</blockquote>
        <p>They also follow the sun, though less.</p></article><form class="newsletter"><label>Subscribe to our newsletter</label><input name=m><button>Sign up</button></form>""",
        ["Tides follow the moon.", "The sea is never still.", "They also follow the sun, though less."],
    ),
]


def test_pages_made_by_hand():
    """Main text is found whole; what is not, is left out. (A heading within a header may go either way.)"""
    for page, main in BY_HAND:
        found = hx.extract_text(page, hx.built_in()).split("\n\n")
        assert [b for b in found if b != "Notes on tides"] == main


def test_query_against_brute_force(spark, tmp_path):
    """The labelling with the best total, found by trying all, from features put together anew."""
    model = hx.built_in()
    w = model.weights
    pages = [p for p, _ in BY_HAND] + ["<p>a</p><nav><p>b</p></nav>", "x<article>y<p>z</article>", '<div class="ad menu"><div id="ad"><p>q</p></div></div><main><p>Long text of the page, with a stop.</p></main>']
    got = hx.op7_html_extraction(spark, write(spark, tmp_path, pages=spark.createDataFrame(list(enumerate(["u"] * len(pages))), "page_id bigint, url string").join(spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string"), "page_id"))).collect()
    by = {r["page_id"]: r["text"] for r in got}
    for i, page in enumerate(pages):
        sequence = blocks(page)
        totals = []
        for b in sequence:
            tags = [e.split(".")[0] for e in b.chain]
            named = next((e.split(".")[1:] for e in reversed(b.chain) if "." in e), [])
            near = next((t for t in reversed(tags) if t in ("article", "main", "nav", "header", "footer", "aside", "form", "section")), "none")
            features = ["bias", f"near={near}", f"tag={tags[-1] if tags else 'none'}"] + [f"in={t}" for t in set(tags)] + [f"word={x}" for x in {x for e in b.chain for x in e.split(".")[1:]}]
            totals.append(sum(w.get(f, 0.0) for f in features + [f"named={x}" for x in set(named)] + hx.text_features(b)))

        def value(y):
            return model.start[y[0]] + sum(t for t, k in zip(totals, y) if k) + sum(model.moves[a][b] for a, b in zip(y, y[1:]))

        best = max(itertools.product((0, 1), repeat=len(sequence)), key=value)
        assert by[i] == "\n\n".join(b.text for b, y in zip(sequence, best) if y)


def test_marginals_and_viterbi_against_enumeration():
    scores, moves, start = [0.3, -1.2, 0.8, 0.1], [[0.4, -0.3], [-0.6, 0.9]], [0.2, -0.1]

    def total(y):
        return start[y[0]] + sum(s for s, k in zip(scores, y) if k) + sum(moves[a][b] for a, b in zip(y, y[1:]))

    ways = list(itertools.product((0, 1), repeat=4))
    z = sum(math.exp(total(y)) for y in ways)
    single, pairs = hx.marginals(scores, moves, start)
    for i in range(4):
        assert math.isclose(single[i][1], sum(math.exp(total(y)) for y in ways if y[i]) / z)
    assert math.isclose(pairs[0][1], sum(math.exp(total(y)) * sum(a < b for a, b in zip(y, y[1:])) for y in ways) / z)
    model = hx.Crf({}, moves, start)
    model.score = scores.__getitem__
    assert tuple(model.decode([0, 1, 2, 3])) == max(ways, key=total)


def test_held_out_accuracy():
    right = whole = 0
    for sequence, labels in hx.labelled_pages(150, seed=1234):
        found = hx.built_in().decode(sequence)
        right += sum(a == b for a, b in zip(found, labels))
        whole += len(labels)
    assert right / whole > 0.98


def test_query(spark, tmp_path):
    page = (
        "<html><head><title>T</title></head><body><nav><ul><li><a href=/a>menu</a></li></ul></nav><div class=\"ad\">Buy.</div>"
        "<article><h1>Head</h1><p>First  part.<br>More.</p><p>Second &lt;part&gt;.</p></article><section class=\"comments\"><p>bob wrote:</p><p>I like this text.</p></section><footer>&copy; me</footer></body></html>"
    )
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "x", ""), (3, "y", "<p>" + "long text. " * 50_000 + "</p>"), (4, "z", "<nav>only menu</nav>")]
    got = hx.op7_html_extraction(spark, write(spark, tmp_path, pages=spark.createDataFrame(rows, PAGES))).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and by[1] == "Head\n\nFirst part. More.\n\nSecond <part>." and by[2] == by[None] == by[4] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    clash = hx.extract(spark.createDataFrame([(1, "t", page)], "page_id int, text string, html string"), out="main")
    assert clash.first()["text"] == "t"
    assert hx.extract(spark.createDataFrame([("t", page)], "text string, html string")).columns == ["text", "html", "text_"]
    assert hx.op7_html_extraction(spark, write(spark, tmp_path / "e", pages=spark.createDataFrame([], PAGES))).count() == 0
