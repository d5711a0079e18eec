"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at block-level tags into text blocks. A block is described by its word count and link density, those of the
blocks before and behind it, and where it stands: inside an article, inside page furniture (menus, footers, adverts and
so on, told by tag, class, id or role), as a heading, with sentence marks. A decision tree trained on a small labelled
table (pages made by rule, below) says which blocks are main text. Each page is worked on in one row; nothing is shuffled.

Defined cases: a null or empty page has an empty text; broken markup is read as far as it goes; equal rows get equal
results; an empty table gives no rows. Added columns replace input columns of the same name; other columns are kept.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from itertools import product

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh

# The roles of HTML elements.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template textarea title iframe svg math canvas object audio video select option button head datalist".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
FURNITURE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu header masthead topbar footer bottom sidebar side aside rail widget cookie cookies consent gdpr notice notices alert banner popup modal overlay "
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion form search login signin signup subscribe newsletter comment comments respond reply replies "
    "discussion disqus related recommended share sharing social breadcrumb breadcrumbs pagination pager copyright legal disclaimer toolbar skip tags complementary contentinfo".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|([^<]++|<)", re.S)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])([^\s\"'>/=]++)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
FRAMES = frozenset("html body main article".split())  # their names tell of the page, not of their text
CONDITIONS = frozenset("has with without no open opened closed active enabled disabled visible hidden fixed".split())  # names of a state, not of a part
FEATURES = ("words", "links", "words_before", "links_before", "words_behind", "links_behind", "article", "outside_article", "furniture", "heading", "sentence")


def furniture(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is furniture by its tag, or by a name that is not just a condition of a frame (``has-sidebar``)."""
    if tag in FURNITURE_TAGS and not (tag == "header" and in_article):
        return True
    if tag in FRAMES:
        return False
    for attribute, value in ATTRIBUTE.findall(attributes):
        if attribute.lower() not in ("class", "id", "role"):
            continue
        for token in value.strip("\"'").split():
            names = re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", token).lower())
            if any(n in FURNITURE_WORDS for n in names) and not any(n in CONDITIONS for n in names) and not (in_article and "header" in names):
                return True
    return False


class Open:
    """The open elements, with counts of what they are, so that no step looks through all of them."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.count: Counter = Counter()
        self.outer: list[int] = []  # places of the elements that are not inline
        self.forms: list[int] = []

    def push(self, tag: str, kinds: tuple[str, ...], form: int | None) -> None:
        if tag not in INLINE:
            self.outer.append(len(self.stack))
        if form is not None:
            self.forms.append(form)
        self.stack.append((tag, kinds))
        self.count.update((f"<{tag}>", *kinds))

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            tag, kinds = self.stack.pop()
            self.count.subtract((f"<{tag}>", *kinds))
            if tag == "form":
                self.forms.pop()
        while self.outer and self.outer[-1] >= k:
            self.outer.pop()

    def close(self, tag: str) -> None:
        if self.count[f"<{tag}>"]:
            k = len(self.stack) - 1
            while self.stack[k][0] != tag:
                k -= 1
            self.cut(k)

    def close_p(self) -> None:
        if self.outer and self.stack[self.outer[-1]][0] == "p":
            self.cut(self.outer[-1])


def blocks(page: str) -> list[dict]:
    """Text blocks in page order: text, n words, linked words, and the state of the open elements.

    A form that holds most words of a page is a frame around it and no furniture.
    """
    out: list[dict] = []
    opened, text = Open(), []
    linked, at, size, n_forms = 0, 0, len(page), 0
    article = False
    count = opened.count

    def close():
        nonlocal text, linked
        words = references.unescape("".join(text)).split()
        if words:
            out.append({
                "text": " ".join(words), "words": len(words), "links": min(linked, len(words)) / len(words), "article": count["article"] > 0,
                "furniture": count["furniture"] > 0, "forms": tuple(opened.forms), "heading": count["heading"] > 0,
                "sentence": words[-1][-1] in ".!?…:;\"'”»", "main": count["main"] > 0,
            })
        text, linked = [], 0

    while at < size:
        m = TOKEN.match(page, at)
        if not m:  # an open quote that never ends: the mark is text
            text.append(page[at])
            at += 1
            continue
        at = m.end()
        slash, tag, attributes, chars = m.groups()
        if chars:
            if not count["silent"]:
                text.append(chars)
                if count["<a>"]:
                    linked += len(chars.split())
            continue
        if not tag:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            close()
        elif tag == "br":
            text.append(" ")
        if slash:
            opened.close(tag)
            continue
        article |= tag in ("article", "main")
        if tag in CLOSES_P:
            opened.close_p()
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            is_kind = (
                ("silent", tag in SILENT), ("article", tag in ("article", "main")), ("heading", tag in HEADINGS), ("main", "data-main" in attributes),
                ("furniture", tag != "form" and furniture(tag, attributes, count["article"] > 0)),
            )
            n_forms += tag == "form"
            opened.push(tag, tuple(k for k, held in is_kind if held), n_forms if tag == "form" else None)
    close()
    inside: Counter = Counter()
    for b in out:
        inside.update({f: b["words"] for f in b["forms"]})
    most = sum(b["words"] for b in out) / 2
    for b in out:
        b["page_has_article"] = article
        b["furniture"] |= any(inside[f] <= most for f in b.pop("forms"))
    return out


def features(page_blocks: list[dict]) -> list[list[float]]:
    none = {"words": 0, "links": 0.0}
    rows = []
    for k, b in enumerate(page_blocks):
        before = page_blocks[k - 1] if k else none
        behind = page_blocks[k + 1] if k + 1 < len(page_blocks) else none
        near = [b["words"], b["links"], before["words"], before["links"], behind["words"], behind["links"]]
        rows.append([float(x) for x in (*near, b["article"], b["page_has_article"] and not b["article"], b["furniture"], b["heading"], b["sentence"])])
    return rows


def labelled_pages() -> list[str]:
    """The labelled table: pages made by rule, whose main blocks carry the mark ``data-main``.

    Articles of several lengths stand in an article element, in a main element or in plain divisions, with furniture that
    is named or told by its links alone.
    """
    say = lambda n: " ".join("word" for _ in range(n)) + "."
    def menu(n):  # of items of changing length, so that their number of words tells nothing
        return "".join(f"<li><a href='/x'>{'word ' * ((1, 4, 2, 9, 3)[(k + n + len(pages)) % 5])}</a></li>" for k in range(n))

    pages = []
    for frame, length, side, paragraphs, head in product(("article", "main", "div"), (1, 8, 20, 45, 90), (3, 40, 100), (1, 3), (0, 2, 12)):
        body = f"<h1 data-main>{'word ' * min(head, length)}</h1>" * (head > 0) + "".join(f"<p data-main>{say(length + 7 * k)}</p>" for k in range(paragraphs))
        # headings over paragraphs: outside an article only what follows tells them from headings over links
        body += "".join(f"<h3 data-main>word word</h3><p data-main>{say(max(20, length) + k)}</p>" for k in range(paragraphs))
        if frame != "div":
            body += "".join(f"<p data-main>{say(k)}</p>" for k in (1, 2, 3, 4)) + "<p data-main>word</p><p data-main>word word</p>"
            body += "".join(f"<p data-main>{'word ' * (length - k)}<a href='/q'>{'word ' * k}</a></p><p data-main>{say(length)}</p>" for k in {length // 2, 2 * length // 3} if length > 3)
        elif length < 20:
            continue  # too short to tell without any cue
        inner = f"<div class='ad'>{say(side)}</div><aside><p>{say(side)}</p></aside><section class='comments'><h3>word word</h3><p>{say(side)}</p><p>{say(3)}</p></section>"
        stray = f"<p>{say(side)}</p>" if frame != "div" else "<p>word word</p>"
        pages.append(
            f"<nav><ul>{menu(6)}</ul></nav><div class='ad'>{say(side)}</div><div class='cookie-notice'><p>{say(side)}</p></div><{frame}>{body}{inner}</{frame}>"
            f"<form><p>{say(9)}</p></form><div class='sidebar'><h2>word word</h2><p>{say(side)}</p></div><p><a href='/z'>{say(side)}</a></p><footer><h4>word word</h4>{say(side)}</footer>"
        )
        pages.append(f"<ul>{menu(4)}</ul><{frame}>{body}</{frame}><h3>word word</h3><ul>{menu(3)}</ul><p><a href='/z'>{say(side)}</a></p>")
        pages.append(
            f"<ul>{menu(8)}</ul>{stray}<{frame}>{body}<ul>{menu(5)}</ul><p><a href='/z'>{say(side)}</a></p></{frame}>"
            f"<p><a href='/y'>word word word</a> word</p><h3>word word</h3><ul>{menu(4)}</ul><p><a href='/z'>{say(side)}</a> word</p>{stray}"
        )
    return pages


def train_tree(spark: SparkSession, depth: int = 8):
    """The tree as nested tuples (feature, threshold, left, right), leaves as 0.0 or 1.0."""
    counts: Counter = Counter()
    for page in labelled_pages():
        found = blocks(page)
        counts.update((*f, float(b["main"])) for f, b in zip(features(found), found))
    rows = [(Vectors.dense(row[:-1]), row[-1], float(n)) for row, n in sorted(counts.items())]
    table = spark.createDataFrame(rows, ["features", "label", "n"])
    model = DecisionTreeClassifier(maxDepth=depth, seed=1, weightCol="n").fit(table)

    def node(n):
        if n.getClass().getSimpleName() == "LeafNode":
            return n.prediction()
        return n.split().featureIndex(), n.split().threshold(), node(n.leftChild()), node(n.rightChild())

    return node(model._java_obj.rootNode())


def predict(tree, row: list[float]) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree > 0.5


def main_text(page: str | None, tree) -> str:
    found = blocks(page or "")
    return "\n".join(b["text"] for b, f in zip(found, features(found)) if predict(tree, f))


def extract_text(pages: DataFrame) -> DataFrame:
    """Pages with ``text`` (main text, blocks joined by newlines, empty if none) and ``n_chars``, its code points."""
    tree, name = train_tree(pages.sparkSession), fresh("text")

    def run(batches):
        for batch in batches:
            texts = pa.array([main_text(x.as_py(), tree) for x in batch.column("html")], pa.string())
            columns = [texts if c == name else batch.column(i) for i, c in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    marked = pages.withColumn(name, F.lit("").cast("string"))
    out = marked.mapInArrow(run, marked.schema)
    added = {"text": F.col(name), "n_chars": F.length(name).cast("bigint")}
    return out.select(*[c for c in pages.columns if c not in added], *[v.alias(k) for k, v in added.items()])
