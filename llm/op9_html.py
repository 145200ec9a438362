"""Main text of web pages by tag-path ratios.

A page is read into blocks: runs of text between block-level tags, each with
its root-to-leaf path of tags (and classes).  Per path, text length and
punctuation are summed and divided by the number of blocks.  The logarithms of the
two ratios are smoothed along the page, added and weighted by what the path's names say (menus, footers, forms, adverts, comments and so on weigh
nothing, article containers weigh more).  Paths whose value reaches a share of the
page's largest select the containers they lie in: the outermost article container,
else the element around the block (around its list, table or quotation, below the
body).  Every block of nonzero weight in a selected container is content, however
short.  So headlines, bylines, list items and cells next to paragraphs stay, and a
lone short line in another container goes; an h1 beside the selected container stays.

A name is read as a whole or by its last telling word: comment-list and
sidebar-left are boilerplate; has-sidebar and share-enabled say nothing of the
element.  Names on html and body say nothing; article and main elements and
content names win over boilerplate names of the same element; article-header
and an article's own header hold a title.  What lies inside boilerplate stays
boilerplate, but an article or main element outweighs a form, alert or overlay around it.

Every page is judged by itself, where it is scanned: no shuffle, no state.

Defined results
* null or empty html, or a page without text: empty text, 0 characters.
* broken markup: open tags end with the page, a head ends where something else begins, a new paragraph ends an open one,
  stray end tags are ignored, an incomplete character reference stays as text.
* white space (also line breaks by tag) inside a block becomes one space; blocks
  without text vanish.  Nothing else is dropped, whatever the length.
* repeated rows give repeated results; other columns are passed through.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import read

# Tag names of the HTML standard and usual names of page parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span "
             "strike strong sub sup time tt u var wbr br img".split())
SILENT = set("script style noscript template head title iframe object select textarea button canvas "
             "audio video datalist".split())
# What a head may hold; any other tag, or text, ends it.
HEAD_TAGS = set("title meta link base style script noscript template".split())
# Pictures and formulas inside the text: their text is kept in line, but for these parts.
FOREIGN, FOREIGN_SILENT = set("svg math".split()), set("title desc metadata style script defs annotation annotation-xml".split())
BOILERPLATE_TAGS = set("nav footer aside header form dialog menu".split())
BOILERPLATE_NAMES = set(
    "nav navbar navigation menu header footer sidebar aside ad ads advert adverts advertisement advertising sponsor "
    "sponsored promo promotion banner cookie cookies consent notice notices popup modal overlay newsletter subscribe "
    "subscription share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments "
    "disqus reply replies form login signup search widget copyright contentinfo complementary masthead toolbar "
    "disclaimer alert meta tags".split())
# Wrappers that an article or main element inside them outweighs.
SOFT_TAGS, SOFT_NAMES = set("form".split()), set("alert overlay modal popup banner".split())
CONTENT_TAGS = set("article main".split())
CONTENT_NAMES = set("article articlebody content post entry story main body text".split())

# First words of names that tell about the rest of the page, and last ones that only tell a part of what comes before.
STATE_WORDS = set("has with without no not".split())
PART_WORDS = set("list area box bar block wrapper wrap container inner outer section group item items link links button "
                 "buttons slot unit left right top bottom posts articles widgets".split()) | CONTENT_NAMES
# What "header" is no page part with: article-header, entry-header.
TITLE_WORDS = set("article post entry story content".split())
# Tags that end an open picture or formula.
BREAKS = set("p div ul ol li dl dt dd table tr td th h1 h2 h3 h4 h5 h6 section article main aside nav header footer form "
             "blockquote pre figure body html hr br".split())
# Parts of a list, table or quotation: the container is what lies around them.
PARTS = set("p li ul ol dt dd dl tr thead tbody tfoot table blockquote figure".split())

CONTENT_WEIGHT = 5.0
# Share of the page's largest path value from which a path selects its containers.
THRESHOLD = 0.5
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[^a-z0-9]+")
BOILERPLATE, CONTENT, TITLE, SOFT = 1, 2, 3, 4
# Weights of the block before, the block itself and the block after in the smoothed ratios.
KERNEL = (0.15, 0.7, 0.15)
_PUNCTUATION = re.compile(r"[.,;:!?。，！？]")


@lru_cache(maxsize=1 << 16)
def name_kind(name: str) -> int:
    """What one whole name (of a class, say) tells: BOILERPLATE, SOFT (boilerplate unless an
    article lies inside), CONTENT, TITLE (of an article) or nothing."""
    words = [w for w in _NAME.split(name.split("--")[0]) if w]  # without the modifier of block__element--modifier
    if not words or (len(words) > 1 and words[0] in STATE_WORDS):
        return 0
    last = len(words) - 1
    while last and (words[last] in PART_WORDS or words[last].isdigit()) and words[last] not in BOILERPLATE_NAMES:
        last -= 1
    if words[last] == "header" and TITLE_WORDS & set(words[:last]):
        return TITLE
    if words[last] in BOILERPLATE_NAMES:
        return SOFT if words[last] in SOFT_NAMES else BOILERPLATE
    return CONTENT if words[-1] in CONTENT_NAMES or "".join(words) in CONTENT_NAMES else 0


class BlockReader(HTMLParser):
    """Splits a page into (path, weight, text, element, article container) blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.paths: dict[tuple[int, str], int] = {}  # (parent path, step) -> path number
        # Open elements: tag, path, weight, silent, number of the element, of the outermost article container (or 0),
        # and whether its weight is 0 for wrappers only that an article inside outweighs.
        self.stack: list[tuple[str, int, float, bool, int, int, bool]] = [("", -1, 1.0, False, 0, 0, False)]
        self.foreign: list[str] = []  # open elements of a picture or formula
        self.tags, self.parents = [""], [0]  # of each element; a parent's number is the smaller one
        self.titles: list[int] = []  # elements that hold an article's title
        self.blocks: list[tuple[int, float, str, int, int]] = []
        self.text: list[str] = []

    def end_block(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            self.text = []
            if text:
                _, path, weight, _, own, article, _ = self.stack[-1]
                self.blocks.append((path, weight, text, own, article))

    def end_head(self) -> None:
        """Whatever does not belong into a head ends one that was left open."""
        depth = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i][0] == "head"), 0)
        if depth and depth == len(self.stack) - 1:
            del self.stack[depth:]

    def handle_starttag(self, tag, attrs):
        if self.foreign:
            if tag in BREAKS:
                self.foreign.clear()
            else:
                self.foreign.append(tag)
                return
        if tag not in HEAD_TAGS:
            self.end_head()
        if tag in FOREIGN:
            if not self.stack[-1][3]:
                self.foreign.append(tag)
            return
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
            elif self.stack[-1][3]:
                return
            if not self.kinds(attrs) & {BOILERPLATE, SOFT} or self.kinds(attrs) & {CONTENT, TITLE}:
                return
            if tag in VOID:
                return
        elif tag in VOID:
            self.end_block()
            return
        self.end_block()
        if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option", "h1", "h2", "h3", "h4", "h5", "h6"):
            self.close_open(tag)
        _, path, weight, silent, parent, article, soft = self.stack[-1]
        names, kinds = self.names(attrs), self.kinds(attrs) if tag not in ("html", "body") else set()
        if tag == "header" and not kinds & {BOILERPLATE, SOFT} and any(x[0] == "article" for x in self.stack):
            kinds.add(TITLE)  # an article's own header
        content = tag in CONTENT_TAGS or CONTENT in kinds or TITLE in kinds
        if soft and tag in CONTENT_TAGS and not kinds & {BOILERPLATE, SOFT}:
            weight, soft = 1.0, False
        if ((tag in BOILERPLATE_TAGS and not (tag == "header" and TITLE in kinds))
                or (kinds & {BOILERPLATE, SOFT} and not content)):
            mild = not tag in BOILERPLATE_TAGS - SOFT_TAGS and BOILERPLATE not in kinds
            weight, soft = 0.0, mild and (soft or weight > 0)
        elif weight and content:
            weight, article = CONTENT_WEIGHT, article or len(self.tags)
            if TITLE in kinds:
                self.titles.append(len(self.tags))
        path = self.paths.setdefault((path, ".".join([tag, *sorted(names)])), len(self.paths))
        self.stack.append((tag, path, weight, silent or tag in SILENT, len(self.tags), article, soft))
        self.tags.append(tag)
        self.parents.append(parent)

    @staticmethod
    def names(attrs) -> set[str]:
        out = set()
        for key, value in attrs:
            if key in ("class", "id", "role", "itemprop") and value:
                out.update(x for x in _NAME.split(value.lower()) if x)
        return out

    @staticmethod
    def kinds(attrs) -> set[int]:
        return {name_kind(x) for key, value in attrs if key in ("class", "id", "role", "itemprop") and value
                for x in value.lower().split()} - {0}

    def close_open(self, tag: str) -> None:
        """A new paragraph or cell ends an open one of its kind inside the same container."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag or (self.stack[i][0] == "p" and tag != "p"):
                del self.stack[i:]
                return
            if self.stack[i][0] in ("div", "section", "article", "main", "ul", "ol", "dl", "table", "body", "blockquote"):
                return

    def handle_endtag(self, tag):
        if self.foreign:
            if tag in self.foreign:
                del self.foreign[len(self.foreign) - 1 - self.foreign[::-1].index(tag):]
                return
            if tag not in BREAKS:
                return
            self.foreign.clear()
        depth = next((i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i][0] == tag), 0)
        if depth:
            self.end_block()
            del self.stack[depth:]

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        if data.strip():
            self.end_head()
        if not self.stack[-1][3] and not FOREIGN_SILENT.intersection(self.foreign):
            self.text.append(data)

    def finish(self) -> list[tuple[int, float, str, int, int]]:
        self.close()
        self.end_block()
        return self.blocks


def smoothed(values: list[float]) -> list[float]:
    """Each value averaged with its neighbours in page order, by ``KERNEL``; the page's edges have one neighbour."""
    out = []
    for i in range(len(values)):
        near = [(w, values[i + k]) for k, w in zip((-1, 0, 1), KERNEL) if 0 <= i + k < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def path_values(blocks) -> dict[int, float]:
    """Per path the mean, over its blocks, of its smoothed and fused ratios, times its weight.

    A path's ratios are text length and punctuation per block.  Their logarithms, written for every block in
    page order, form two curves, which are smoothed and added (fused).  Blocks without weight are no part of
    the curves."""
    total: dict[int, list[float]] = {}
    for path, weight, text, _, _ in blocks:
        t = total.setdefault(path, [0, 0, 0, weight])
        t[0] += 1
        t[1] += len(text)
        t[2] += len(_PUNCTUATION.findall(text))
    order = [path for path, weight, *_ in blocks if weight]
    lengths = smoothed([math.log1p(total[p][1] / total[p][0]) for p in order])
    marks = smoothed([math.log1p(total[p][2] / total[p][0]) for p in order])
    out = dict.fromkeys(total, 0.0)
    for p, chars, n_marks in zip(order, lengths, marks):
        out[p] += total[p][3] * (chars + n_marks) / total[p][0]
    return out


def containers(reader: BlockReader) -> list[int]:
    """The container (number of an element) of each block."""
    tags, parents = reader.tags, reader.parents
    around = [False] * len(tags)  # has blocks further in
    for _, weight, _, own, _ in reader.blocks:
        while weight and own and not around[parents[own]]:
            own = parents[own]
            around[own] = True
    lifted = list(range(len(tags)))
    for e in range(1, len(tags)):
        if tags[e] in PARTS and tags[parents[e]] not in ("", "html", "body"):
            lifted[e] = lifted[parents[e]]
    return [article or lifted[own if around[own] else parents[own]] for _, _, _, own, article in reader.blocks]


def add_headline(reader: BlockReader, blocks, selected: list[bool]) -> None:
    """Select a page title that lies beside the selected container: an h1 before it whose own container
    holds the selected one.  Only where no selected container has an h1 itself."""
    tags, parents = reader.tags, reader.parents
    inside = selected[:]
    for e in range(1, len(inside)):
        inside[e] = inside[e] or inside[parents[e]]
    chosen = [e for e in range(1, len(selected)) if selected[e]]
    heads = [own for _, weight, _, own, _ in blocks if weight and tags[own] == "h1"]
    if not chosen or any(inside[h] for h in heads):
        return
    around = set()
    for e in chosen:
        while e:
            e = parents[e]
            around.add(e)
    for h in heads:
        if parents[h] in around and h < chosen[0]:
            selected[h] = True


def main_text(html: str | None) -> str:
    """Content blocks of a page in page order, joined by line feeds."""
    if not html:
        return ""
    reader = BlockReader()
    reader.feed(html)
    blocks = reader.finish()
    if not blocks:
        return ""
    by_path = path_values(blocks)
    limit = THRESHOLD * max(by_path.values())
    selected = [False] * len(reader.tags)
    for (path, weight, _, _, _), c in zip(blocks, containers(reader)):
        if weight and by_path[path] >= limit:
            selected[c] = True
    for e in reader.titles:
        selected[e] = True
    add_headline(reader, blocks, selected)
    for e in range(1, len(selected)):
        selected[e] = selected[e] or selected[reader.parents[e]]
    return "\n".join(text for _, weight, text, own, _ in blocks if weight and selected[own])


def extract(df: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """``df`` plus the main text of ``html`` as column ``name``."""
    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())
    return df.withColumn(name, run(F.col(html)))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
