"""Operator 7: main text extraction with a linear-chain conditional random field.

A page is cut into DOM leaf blocks (``dom.blocks``). Each has features of its ancestors
(tags, words of class, id and role attributes, the nearest sectioning element) and of its
text (length, share of links, marks and words), and a linear-chain CRF labels the sequence as
main text or not. It is trained by gradient ascent on the exact likelihood (forward and
backward sums) over labelled pages, and decoded by Viterbi. The labelled pages are made by
rule with a fixed seed: many layouts, each block's label known.

Defined cases: null or empty HTML, or a page without any main block, gives an empty text;
white space is that of ASCII; white space inside a block, line breaks included, becomes one
space; unclosed tags, comments and attributes are read as browsers do or left out; pages may be
of any length and nesting, reading and labelling them is linear; repeated rows are extracted
each; an empty table gives an empty result; extra columns are carried and keep their values: an
output whose name is taken gets underscores behind it.
"""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shingles as S
from .common import fresh, table
from .dom import Block, Node, blocks

#: Labelled pages that the model is trained on, and passes over them.
PAGES = 500
EPOCHS = 12
PHRASES = ("cookie", "copyright", "©", "subscribe", "sign up", "log in", "newsletter", "all rights", "privacy", "share", "reply", "advert", "sponsored")


# ------------------------------------------------------------------- features


def own_features(node: Node) -> list[str]:
    """What the innermost element tells by itself."""
    return ["bias", f"near={node.near}", f"tag={node.tag}", *(f"named={w}" for w in node.named)]


def chain_features(node: Node) -> list[str]:
    """All features of a block's ancestors, each tag and word once."""
    out = own_features(node)
    while node.parent is not None:
        out += node.added
        node = node.parent
    return out


def text_features(block: Block) -> list[str]:
    text = block.text
    share = block.link_chars / max(1, len(text))
    low = text.lower()
    size = min(6, int(math.log2(text.count(" ") + 1)))
    out = [f"words={size}", f"links={'no' if share == 0 else 'few' if share < 0.4 else 'many' if share < 0.9 else 'all'}"]
    out.append("stop" if text[-1] in ".!?:;\"')»”…。" else "open")
    out += [f"has={p}/{size}" for p in PHRASES if p in low]  # what a phrase tells depends on how long the text is
    return out


# ------------------------------------------------------------------------ CRF


class Crf:
    """Two labels, 0 and 1. ``weights``: feature to the log odds of label 1; ``moves``: [from][to]."""

    def __init__(self, weights: dict[str, float], moves: list[list[float]], start: list[float]):
        self.weights, self.moves, self.start = weights, moves, start

    def chain_score(self, node: Node) -> float:
        """The weight of all features of a block's ancestors; each element adds to those around it."""
        w = self.weights
        open_, at = [], node
        while at is not None and at.score is None:
            open_.append(at)
            at = at.parent
        for n in reversed(open_):
            n.score = (n.parent.score if n.parent is not None else 0.0) + sum(w.get(f, 0.0) for f in n.added)
        return node.score + sum(w.get(f, 0.0) for f in own_features(node))

    def score(self, block: Block) -> float:
        w = self.weights
        return self.chain_score(block.node) + sum(w.get(f, 0.0) for f in text_features(block))

    def decode(self, sequence: list[Block]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        if not sequence:
            return []
        back: list[tuple[int, int]] = []
        (m00, m01), (m10, m11) = self.moves
        a, b = self.start[0], self.start[1] + self.score(sequence[0])
        for block in sequence[1:]:
            stay, leave = a + m00, b + m10
            enter, keep = a + m01, b + m11
            back.append((int(leave > stay), int(keep >= enter)))
            a, b = max(stay, leave), max(enter, keep) + self.score(block)
        label = int(b > a)
        labels = [label]
        for pair in reversed(back):
            label = pair[label]
            labels.append(label)
        return labels[::-1]


def _log_sum(x: float, y: float) -> float:
    high = max(x, y)
    return high + math.log1p(math.exp(min(x, y) - high))


def marginals(scores: list[float], moves: list[list[float]], start: list[float]) -> tuple[list[list[float]], list[list[float]]]:
    """Probabilities of each position's labels, and the expected counts of moves."""
    n = len(scores)
    fore = [[start[0], start[1] + scores[0]]]
    for s in scores[1:]:
        a, b = fore[-1]
        fore.append([_log_sum(a + moves[0][0], b + moves[1][0]), _log_sum(a + moves[0][1], b + moves[1][1]) + s])
    rear = [[0.0, 0.0] for _ in range(n)]
    for i in range(n - 2, -1, -1):
        c, d = rear[i + 1][0], rear[i + 1][1] + scores[i + 1]
        rear[i] = [_log_sum(moves[0][0] + c, moves[0][1] + d), _log_sum(moves[1][0] + c, moves[1][1] + d)]
    whole = _log_sum(*fore[-1])
    single = [[math.exp(f[k] + r[k] - whole) for k in (0, 1)] for f, r in zip(fore, rear)]
    pairs = [[0.0, 0.0], [0.0, 0.0]]
    for i in range(1, n):
        for k in (0, 1):
            for m in (0, 1):
                pairs[k][m] += math.exp(fore[i - 1][k] + moves[k][m] + (scores[i] if m else 0.0) + rear[i][m] - whole)
    return single, pairs


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-4, seed: int = 7) -> Crf:
    """Stochastic gradient ascent on the conditional log likelihood, with AdaGrad steps."""
    draw = random.Random(seed)
    weights: dict[str, float] = {}
    squares: dict = {}
    moves, start = [[0.0, 0.0], [0.0, 0.0]], [0.0, 0.0]
    ready = [([chain_features(b.node) + text_features(b) for b in seq], labels) for seq, labels in pages if seq]

    def step(key, gradient: float) -> float:
        squares[key] = squares.get(key, 1e-6) + gradient * gradient
        return rate * gradient / math.sqrt(squares[key])

    for _ in range(epochs):
        draw.shuffle(ready)
        for features, labels in ready:
            scores = [sum(weights.get(f, 0.0) for f in fs) for fs in features]
            single, pairs = marginals(scores, moves, start)
            gradient: dict[str, float] = {}
            for fs, y, p in zip(features, labels, single):
                if (miss := y - p[1]) != 0.0:
                    for f in fs:
                        gradient[f] = gradient.get(f, 0.0) + miss
            for f, g in gradient.items():
                w = weights.get(f, 0.0)
                weights[f] = w + step(f, g - decay * w)
            for k in (0, 1):
                start[k] += step(("start", k), (labels[0] == k) - single[0][k])
                for m in (0, 1):
                    seen = sum(x == k and y == m for x, y in zip(labels, labels[1:]))
                    moves[k][m] += step(("move", k, m), seen - pairs[k][m])
    return Crf(weights, moves, start)


# -------------------------------------------------------------- labelled pages

VOWELS, CONSONANTS = "aeiouéü", "bcdfghlmnprstvw"
BOILERPLATE = {
    "nav": ["nav", "div.menu", "div.navbar", "ul.nav", "div#menu", "div.breadcrumbs", "div.topbar", "div.navigation"],
    "header": ["header", "div.header", "div#header", "div.masthead", "div.site-header"],
    "footer": ["footer", "div.footer", "div#footer", "div.site-footer", "div.copyright"],
    "aside": ["aside", "div.sidebar", "div#sidebar", "div.related", "div.widget", "section.recommended", "div.popular"],
    "ad": ["div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "div.promo", "div.banner", "aside.ad", "ins.adsbygoogle"],
    "notice": ["div.notice", "div.cookie-notice", "div.cookie-banner", "div#consent", "div.newsletter", "div.alert", "div.popup", "section.notice"],
    "form": ["form", "form.search", "form#subscribe", "div.login", "form.comment-form"],
    "comments": ["section.comments", "div#comments", "div.comment", "ol.commentlist", "div.comment-list", "section#discussion", "div.replies", "div.disqus-thread"],
    "share": ["div.share", "div.social", "ul.tags", "div.pagination", "div.meta-links"],
}
MAIN = ["article", "article.post", "main", "main>article", "div.content", "div#content", "div.article-body", "div.post", "div.entry-content", "section.story", "div.main-text", "main>div.text", "body"]


def labelled_pages(pages: int = PAGES, seed: int = 7) -> list[tuple[list[Block], list[int]]]:
    """Pages of many layouts, read by ``dom.blocks``, with a label for each block.

    Main text holds prose, headings, lists, quotes, tables and odd lines (short, full of
    signs, or like a licence), and may be broken by adverts, forms and the like; reader
    comments are prose as well.
    """
    draw = random.Random(seed)

    def word() -> str:
        return "".join(draw.choice(CONSONANTS) + draw.choice(VOWELS) for _ in range(draw.randint(1, 4))) + draw.choice(("", "n", "s", "r"))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(draw.randint(low, high)))

    def prose() -> str:
        text = plain_prose()
        if draw.random() < 0.15:  # ordinary prose has words of notices, too
            at = draw.choice([i for i, c in enumerate(text + " ") if c == " "])
            text = f"{text[:at]} {draw.choice(PHRASES)}{text[at:]}"
        return text

    def plain_prose() -> str:
        kind = draw.random()
        if kind < 0.62:
            return ". ".join(words(4, 14) for _ in range(draw.choice((1, 2, 3, 4, 6, 12)))).capitalize() + "."
        if kind < 0.74:
            return words(1, 4).capitalize() + "."
        if kind < 0.82:
            return "".join(w + draw.choice(("%%% ", "*** ", "&amp;&amp;&amp; ", "### ")) for w in words(3, 12).split())
        if kind < 0.88:
            return f"{draw.choice(('Licensed', 'Released', 'Copyright'))} {words(2, 4)} License, {words(1, 2)}."
        if kind < 0.94:
            return f'{words(3, 8)} <a href="/{word()}">{words(1, 4)}</a> {words(3, 8)}.'
        return f"{words(1, 3)} | {words(1, 3)} | {draw.randint(1, 9999)} {words(0, 3)}"

    def wrap(path: str, inner: str) -> str:
        for part in reversed(path.split(">")):
            tag, _, name = part.partition(".") if "." in part else part.partition("#")
            mark = "id" if "#" in part else "class"
            extra = draw.choice(("", "", " clearfix", " wrap")) if name and mark == "class" else ""
            inner = f"<{tag}{f' {mark}={chr(34)}{name}{extra}{chr(34)}' if name else ''}>{inner}</{tag}>"
        return inner

    def paragraph(text: str) -> str:
        form = draw.random()
        if form < 0.15:
            return f"<p><b>{text}<br>"
        return f"<p>{text}</p>" if form < 0.9 else f"<p>{text}"

    def heading(text: str) -> str:
        tag = draw.choice(("h2", "h2", "h3", "h4"))
        return f"<{tag}>{text}</{tag}>"

    def boilerplate(kind: str) -> str:
        if kind in ("nav", "share"):
            items = "".join(f'<li><a href="/{word()}">{words(1, 2)}</a></li>' for _ in range(draw.randint(2, 7)))
            inner = f"<ul>{items}</ul>" if draw.random() < 0.7 else items.replace("<li>", "<span>").replace("</li>", "</span> ")
        elif kind == "header":
            inner = f"<div>{words(1, 3)}</div>" + (f"<p>{words(2, 6)}</p>" if draw.random() < 0.5 else "") + (boilerplate("nav") if draw.random() < 0.5 else "")
        elif kind == "footer":
            inner = f"&copy; {word()}.example.com &middot; {prose()}" if draw.random() < 0.6 else f"<p>{prose()}</p><p>All rights reserved {words(1, 3)}</p>"
        elif kind == "form":
            inner = f"<label>{words(1, 3)}</label><input name=q><select><option>{word()}</option><option>{word()}</option></select><button>{words(1, 2)}</button>"
        elif kind == "comments":
            inner = heading(draw.choice(("Comments", "Replies", words(1, 2)))) + "".join(
                f'<div class="comment"><p>{words(1, 2)} wrote:</p>{paragraph(prose())}</div>' if draw.random() < 0.7 else f"<li>{prose()}</li>" for _ in range(draw.randint(1, 4))
            )
        else:
            inner = prose() if draw.random() < 0.6 else "".join(f"<p>{prose()}</p>" for _ in range(draw.randint(1, 3)))
            if kind == "aside":
                inner = heading(words(1, 3)) + inner
        return wrap(draw.choice(BOILERPLATE[kind]), inner)

    def main_part() -> str:
        kind = draw.random()
        if kind < 0.72:
            return paragraph(prose())
        if kind < 0.8:
            return heading(words(1, 6).capitalize())
        if kind < 0.87:
            return "<ul>" + "".join(f"<li>{prose()}</li>" for _ in range(draw.randint(1, 4))) + "</ul>"
        if kind < 0.91:
            return f"<blockquote>{prose()}</blockquote>"
        if kind < 0.95:
            return f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>"
        return draw.choice((f"<pre>{words(2, 8)}</pre>", f"<figure><img src=x><figcaption>{words(2, 8)}</figcaption></figure>", f"<div>{prose()}</div>"))

    def marked(piece: str, label: int, seen: list[tuple[str, int]]) -> str:
        seen.append((piece, label))
        return piece

    out = []
    while len(out) < pages:
        seen: list[tuple[str, int]] = []
        before = [k for k in ("notice", "header", "nav", "ad", "aside", "form") if draw.random() < (0.8 if k == "nav" else 0.4)]
        after = [k for k in ("share", "comments", "aside", "ad", "form", "notice", "footer") if draw.random() < (0.8 if k == "footer" else 0.4)]
        head = "".join(marked(boilerplate(k), 0, seen) for k in before)
        inner = marked(f"<h1>{words(2, 8).capitalize()}</h1>", 1, seen) if draw.random() < 0.85 else ""
        for _ in range(draw.randint(1, 14)):
            inner += marked(main_part(), 1, seen)
            if draw.random() < 0.08:
                inner += marked(boilerplate(draw.choice(("ad", "aside", "share", "form", "notice"))), 0, seen)
        if draw.random() < 0.15:
            inner += marked(boilerplate("comments"), 0, seen)
        path = draw.choice(MAIN)
        body = head + (inner if path == "body" else wrap(path, inner)) + "".join(marked(boilerplate(k), 0, seen) for k in after)
        if draw.random() < 0.2:
            body = f'<div class="{draw.choice(("container", "page", "wrapper", "site"))}">{body}</div>'
        page = f"<!DOCTYPE html><html><head><title>{words(2, 5)}</title><style>p{{}}</style></head><body>{body}<script>var t='</p>';</script></body></html>"
        of: dict[str, int] = {}
        clash = False
        for piece, label in seen:
            for b in blocks(piece):
                clash |= of.setdefault(b.text, label) != label
        sequence = blocks(page)
        if not clash and all(b.text in of for b in sequence):
            out.append((sequence, [of[b.text] for b in sequence]))
    return out


@functools.cache
def built_in() -> Crf:
    return train(labelled_pages())


# ----------------------------------------------------------------------- Spark


def extract_text(page: str | None, model: Crf) -> str:
    sequence = blocks(page or "")
    return "\n\n".join(b.text for b, y in zip(sequence, model.decode(sequence)) if y)


def extract(df: DataFrame, model: Crf | None = None, html: str = "html", out: str = "text") -> DataFrame:
    """Adds ``out``, the main text of each page."""
    model, out = model or built_in(), fresh(df, out)
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.moves, model.start))  # a few hundred features
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Crf(*shared.value)
        for whole in batches:
            for batch in S.slices(whole, html):
                texts = [extract_text(p, own) for p in batch.column(html).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return df.mapInArrow(run, schema)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


QUERIES = {"op7_html_extraction": op7_html_extraction}
#: A trained model has no SQL form; tests hold it against labelled pages and the tables' own layout.
SQL: dict[str, str] = {}
