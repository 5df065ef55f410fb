"""HTML extraction: boosted trees over the nodes of a page, decoded over its tree.

Each block element is a node with features of its tag, attribute words, those
of its ancestors, depth, siblings and subtree (density, links, share of the
text). Boosted trees give every node a margin for holding main text; the nodes
kept are the choice of largest total margin in which no node is kept below one
that is dropped. Scripts, styles, form controls and the like never count.

Training needs no labels from outside: a bounded number of text blocks, spread over
each page of a bounded sample, of any length, or built-in ones where no page has
text, are laid out anew as main text and boilerplate in many forms (article, main or classed
containers; menus, headers, footers, sidebars, adverts, notices, forms, comment
threads and related links around and inside), where every node's part is known.

Defined results: a null or empty html gives an empty text, and so does a page
without main text; broken markup is read as far as it goes; rows with a null id
keep it; repeated rows each get their row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import html
import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.dom import FEATURES, Dom, decode, features, kept_text, parse
from tierwise.llm.trees import Boosted, train

#: Pages of the training sample; blocks of one page, spread over all of it, and characters of a block.
SAMPLE_PAGES = 160
SAMPLE_BLOCKS = 200
BLOCK_CHARS = 2000
LAYOUTS_PER_PAGE = 3
#: Nodes whose features are held together, or one page's.
BATCH_NODES = 20_000

#: Blocks to lay out where a table has none.
_BUILT_IN = [
    "A short walk along the river", "The path begins behind the old mill and follows the water for two miles.",
    "After the second bridge it climbs, slowly at first, through beech and oak, and the valley opens below.",
    "Most people turn back at the chapel. Those who go on are rewarded with a view of both villages, and, "
    "on clear days, of the hills beyond them.", "In spring the lower part is often under water.",
    "The inn at the top serves soup until four. It has been run by the same family for three generations, "
    "and little about it has changed.", "How to get there", "Trains leave every hour.",
    "Allow three hours for the whole round, four with children, and take something warm.",
]

#: Attribute marking, in a laid-out training page, the elements that hold main text.
_MAIN = "data-main"

_BOXES = {  # part of a page -> ways to mark it up
    "menu": ["nav", "div class='{nav}'", "ul class='menu'", "div id='navigation' role='navigation'",
             "div class='navbar'", "div class='breadcrumbs'"],
    "head": ["header", "div class='site-header'", "div id='masthead'", "div class='header' role='banner'"],
    "foot": ["footer", "div class='footer'", "div id='site-footer'", "div class='copyright'"],
    "side": ["aside", "div class='sidebar'", "div id='sidebar'", "section class='widget'", "div class='right-rail'"],
    "ad": ["div class='ad'", "div class='advertisement'", "div id='ad-1'", "section class='sponsored'",
           "aside class='promo'", "div class='ads banner'", "p class='advert'"],
    "notice": ["div class='cookie-notice'", "div id='cookie-banner'", "div class='notice'", "div role='alert'",
               "div class='gdpr consent'", "p class='notice'", "section class='alert'", "div class='popup modal'"],
    "form": ["form", "form class='newsletter'", "div class='subscribe-form'", "form id='login'", "div class='search-form'"],
    "talk": ["div class='comments'", "section id='comments'", "div id='disqus_thread'", "ol class='comment-list'",
             "section class='reader-comments'", "div class='responses'", "div class='discussion'"],
    "more": ["div class='related'", "section class='related-posts'", "ul class='share'", "div class='recommended'",
             "div class='social-share'", "div class='author-meta'"],
}
_MAINS = ["article", "main", "div class='content'", "div class='post-content'", "div id='main-content'",
          "section class='entry'", "div role='main'", "div class='article-body'", "article class='post'",
          "div id='story'", "div class='page-text'", "section", "div"]


def _element(opening: str, inner: str, main: bool = False) -> str:
    tag = opening.split()[0]
    return f"<{opening}{' ' + _MAIN if main else ''}>{inner}</{tag}>"


def layout(blocks: list[str], spare: list[str], rng: random.Random) -> str:
    """A page around ``blocks`` of main text, with boilerplate made of ``spare`` sentences and words."""
    def sentence() -> str:
        return html.escape(rng.choice(spare)) if spare else "lorem ipsum"

    def words(n: int) -> list[str]:
        return (sentence().split() * n)[:n] or ["home"]

    def links(n: int) -> str:
        items = "".join(f"<li><a href='/{k}'>{w}</a></li>" for k, w in enumerate(words(n)))
        return f"<ul>{items}</ul>"

    def boilerplate(part: str) -> str:
        opening = rng.choice(_BOXES[part]).format(nav="main-nav")
        prose = "".join(f"<p>{sentence()}</p>" for _ in range(rng.randint(1, 3)))
        if part in ("menu", "more") and rng.random() < 0.8:
            inner = links(rng.randint(2, 8))
            if opening.startswith("ul"):
                inner = inner[4:-5]
        elif part == "form":
            inner = f"<label>{' '.join(words(3))}</label><input type='text'><p>{sentence()}</p><button>{words(1)[0]}</button>"
        elif part == "talk":
            each = rng.choice(["div class='comment'", "li", "article class='comment'", "div", "p"])
            inner = "<h3>" + " ".join(words(2)) + "</h3>" + "".join(
                _element(each, sentence() if each == "p" else f"<p>{sentence()}</p>")
                for _ in range(rng.randint(1, 6)))
        elif part == "foot":
            inner = f"&copy; {' '.join(words(3))} &middot; {sentence()}"
        elif part == "head":
            inner = f"<div class='logo'>{' '.join(words(2))}</div>" + (links(3) if rng.random() < 0.5 else prose)
        elif part == "side":
            inner = f"<h3>{' '.join(words(2))}</h3>" + (links(5) if rng.random() < 0.5 else prose)
        elif opening.startswith("p "):
            inner = sentence()
        else:
            inner = rng.choice([prose, sentence(), links(3)])
        return _element(opening, inner)

    def text_block(block: str, first: bool) -> str:
        if first and rng.random() < 0.7:
            return _element(rng.choice(["h1", "h1 class='title'", "h2"]), html.escape(block[:80]), True)
        if rng.random() < 0.08:
            return _element(rng.choice(["blockquote", "pre", "h2", "h3"]), html.escape(block), True)
        if rng.random() < 0.06:
            parts = block.split(". ")
            return _element("ul", "".join(_element("li", html.escape(p), True) for p in parts), True)
        inner = html.escape(block)
        if rng.random() < 0.15:
            return f"<p {_MAIN}><b>{inner}<br>"
        return _element(rng.choice(["p"] * 8 + ["div"]), inner, True)

    inside = [text_block(b, k == 0) for k, b in enumerate(blocks)]
    for part in rng.sample(["ad", "notice", "side", "more", "form"], rng.randint(0, 2)):
        inside.insert(rng.randint(0, len(inside)), boilerplate(part))
    body = _element(rng.choice(_MAINS), "".join(inside), True)
    if rng.random() < 0.4:
        body = _element(rng.choice(["div class='wrapper'", "div id='page'", "main", "div", "section class='container'"]),
                        "".join([boilerplate("side")] * (rng.random() < 0.4)) + body, True)
    before = [boilerplate(p) for p in rng.sample(["menu", "head", "notice", "ad", "form", "menu"], rng.randint(1, 4))]
    after = [boilerplate(p) for p in rng.sample(["talk", "more", "side", "ad", "foot", "form", "notice"], rng.randint(1, 5))]
    return f"<html><body {_MAIN}>{''.join(before)}{body}{''.join(after)}</body></html>"


def text_blocks(page: str, most: int = SAMPLE_BLOCKS) -> list[str]:
    """Text of a page by node, without links; at most ``most`` blocks, evenly spread, cut to ``BLOCK_CHARS``."""
    blocks: dict[int, list[str]] = {}
    for node, text, link in parse(page).text:
        if node >= 0 and not link:
            blocks.setdefault(node, []).append(text)
    joined = [" ".join("".join(t).split()) for t in blocks.values()]
    long = [t[:BLOCK_CHARS] for t in joined if len(t) > 1]
    step = max(1, -(-len(long) // most))
    return long[::step]


def training_rows(texts: list[list[str]], layouts: int = LAYOUTS_PER_PAGE) -> tuple[np.ndarray, np.ndarray]:
    """Node features and 0/1 labels of laid-out pages, from the blocks of each page."""
    texts = [t for t in texts if t] or [_BUILT_IN] * 20
    spare = [s.strip() for t in texts for b in t[1:4] for s in b.split(". ")[:2] if s.strip()][:5000]
    rng, rows, labels = random.Random(11), [], []
    for blocks in texts:
        for _ in range(layouts):
            begin = rng.randrange(len(blocks))
            own = blocks[begin:begin + rng.randint(1, 40)]
            # main text has short blocks too, anywhere
            own = [" ".join(b.split()[:rng.randint(1, 6)]) if rng.random() < 0.2 else b for b in own]
            page = layout(own, spare, rng)
            marked = parse(page.replace(f" {_MAIN}", " itemprop='xmainx'"))
            rows.append(features(parse(page)))
            labels.append(_labels(page, marked))
    return np.concatenate(rows), np.concatenate(labels)


def _labels(page: str, dom: Dom) -> np.ndarray:
    """Nodes in order of their start tags: 1 where the tag carries the mark."""
    marks, at = [1], 0
    for tag in dom.tag[1:]:
        at = page.index(f"<{tag}", at)
        end = page.index(">", at)
        marks.append(int(_MAIN in page[at:end]))
        at = end
    return np.array(marks)


def train_extractor(spark: SparkSession, pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Boosted | None:
    """Trees from laid-out pages made of text blocks of at most ``sample_pages`` pages."""
    parts = 1 << 30
    share = int(parts * min(1.0, 4 * sample_pages / max(1, pages.count())))
    order = [F.xxhash64("page_id"), F.col("page_id"), F.xxhash64("html")]
    chosen = (pages.where((F.pmod(F.xxhash64("page_id"), F.lit(parts)) < share) & F.col("html").isNotNull())
              .select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
              .orderBy(*order).limit(sample_pages))
    found = chosen.mapInArrow(_sampled, "page_id long, blocks array<string>").collect()
    rows, labels = training_rows([r.blocks for r in found])
    names = [f"f{k}" for k in range(len(FEATURES))]
    table = pa.table([pa.array(np.ascontiguousarray(c)) for c in rows.T] + [pa.array(labels)],
                     names=[*names, "label"])
    model = train(spark.createDataFrame(table).persist(), names, rounds=16, depth=4)
    return model


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch(
            [batch.column(0), pa.array([text_blocks(page.as_py()) for page in batch.column(1)],
                                       pa.list_(pa.string()))], names=["page_id", "blocks"])


def _margins(trees: Boosted | None, rows: np.ndarray) -> np.ndarray:
    if trees is None:
        return np.ones(len(rows))
    return np.concatenate([trees.margins(rows[a:a + BATCH_NODES]) for a in range(0, len(rows), BATCH_NODES)])


def _page_texts(trees: Boosted | None, pages: Iterator[str | None]) -> Iterator[str]:
    """The texts in order; features of several small pages, or of one large page, are held at a time."""
    doms: list[Dom] = []

    def done() -> Iterator[str]:
        if doms:
            margins, begin = _margins(trees, np.concatenate([features(d) for d in doms])), 0
            for dom in doms:
                yield kept_text(dom, decode(dom, margins[begin:begin + len(dom.tag)]))
                begin += len(dom.tag)
            doms.clear()

    nodes = 0
    for page in pages:
        dom = parse(page or "")
        if nodes + len(dom.tag) > BATCH_NODES:
            yield from done()
            nodes = 0
        doms.append(dom)
        nodes += len(dom.tag)
    yield from done()


def _extract(model: object) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(_page_texts(model.value, (page.as_py() for page in batch.column(2))))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                  names=["page_id", "url", "text"])
    return run


def extract_text(spark: SparkSession, pages: DataFrame, model: Boosted | None) -> DataFrame:
    """(page_id, url, text): the main text of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract(spark.sparkContext.broadcast(model)),
                           "page_id long, url string, text string")
