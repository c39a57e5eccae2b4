"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags.  The first pass decides blocks by the
containers they lie in, their length, the share of their text that is linked, and the
share of their words that are stop words.  Short and middling blocks stay ambiguous; the
second pass gives each of them the label of the nearest decided block of its container.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from layerframe.llm import text

SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.15, 0.30
LINKS_MOST = 0.5

# Element names as HTML gives them.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small strike strong sub sup time tt u var".split())
_SKIPPED = set("script style title textarea noscript template iframe noframes noembed xmp svg math canvas object audio video select datalist".split())
_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_LIST_PARTS = {"li", "dt", "dd", "td", "th", "option"}
# what a start tag closes when it is open, up to the element that keeps it
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"})}
_CLOSES |= {cell: ({"td", "th"}, {"table"}) for cell in ("td", "th")} | {"tr": ({"tr", "td", "th"}, {"table"})}

# Containers that are never, or always, the article.
_BAD_TAGS = set("nav footer aside form menu dialog button fieldset label legend".split())
_GOOD_TAGS = {"article", "main"}
_BAD_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_GOOD_ROLES = {"main", "article"}
_BAD_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe signup login sidebar widget menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer copyright comment comments disqus "
    "respond reply replies share sharing social related recommended popular trending pagination pager search form".split()
)
_BAD_ARTICLES = set("ad ads advert advertisement promo sponsored comment comments reply related teaser widget".split())
_BARE = {"has", "no", "with", "without", "is", "not"}
_GOOD_CLASS = re.compile(r"^(?:article|post|entry|story|main)[-_]?(?:content|body|text|main)?$")

# The most frequent function words of six languages.
_STOP = set(
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which will with you "
    "au aux avec ce ces dans de des du elle en est et il ils la le les leur mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une vous "
    "als auch auf aus bei das dem den der die ein eine einen einer es für hat ich im ist mit nach nicht sich sie sind und von war werden wie wird zu zum zur "
    "al como con del el ella era es esta este la las lo los más muy no o para pero por que se si sin su sus también una y "
    "che da di è gli ha il nel non per sono alla della ao com da do dos em não na os pelo um uma een het met niet op te van voor zijn".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[\"'=])*+)(?:>|\Z)"
    r"|</?[!?/][^>]*+(?:>|\Z)|</>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]+)))?")
_NAMED = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """A stretch of text between block-level tags."""

    tag: str
    container: int  # number of the innermost marked container, 0 outside all
    mark: int  # of that container: 1 article, -1 surroundings, 0 outside all
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    good: bool | None = None


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _mark(tag: str, raw: str, inside: int) -> int | None:
    """What a start tag says of its content: 1 article, -1 surroundings, None nothing.  ``inside`` is what holds around it."""
    attributes = _attributes(raw) if "=" in raw or "hidden" in raw else {}
    role = attributes.get("role", "").lower()
    if tag in _BAD_TAGS or (tag == "header" and inside != 1) or role in _BAD_ROLES:
        return -1
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return -1
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split() if tag not in ("html", "body") else []
    bad = _BAD_ARTICLES if tag in _GOOD_TAGS else _BAD_WORDS
    good = tag in _GOOD_TAGS or role in _GOOD_ROLES or attributes.get("itemprop", "").lower() == "articlebody"
    for name in names:
        words = [w.lower() for w in _NAMED.findall(name)]
        if words and (words[0] in bad or words[-1] in bad) and not _BARE.intersection(words) and not (inside == 1 and tag == "header"):
            return -1
        good = good or bool(_GOOD_CLASS.match(name.lower()))
    return 1 if good else None


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page, in order, none of them empty."""
    blocks: list[Block] = []
    stack: list[tuple[str, int, int]] = []  # open elements with container and mark
    held: Counter[str] = Counter()
    containers = 0
    linked = False
    block: Block | None = None
    at, end = 0, len(page)

    def close(names: set[str], keepers: set[str]) -> None:
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in keepers:
                return
            if stack[depth][0] in names:
                drop(depth)
                return

    def drop(depth: int) -> None:
        for name, _, _ in stack[depth:]:
            held[name] -= 1
        del stack[depth:]

    while at < end:
        low = page.find("<", at)
        token = None
        while low >= 0 and not (token := _TOKEN.match(page, low)):
            low = page.find("<", low + 1)
        stop = low if low >= 0 else end
        if stop > at:
            chunk = entities.unescape(page[at:stop])
            if block is None and not chunk.isspace():
                tag, container, mark = stack[-1] if stack else ("", 0, 0)
                block = Block(tag, container, mark)
                blocks.append(block)
            if block is not None:
                block.parts.append(chunk)
                if linked:
                    block.linked += len("".join(chunk.split()))
        if token is None:
            break
        at = token.end()
        if token[2] is None:
            continue
        closing, tag = token[1], token[2].lower()
        if tag in _SKIPPED and not closing:
            shut = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            at = shut.start() if shut else end
            continue
        if tag == "br":
            if block is not None:
                block.parts.append(" ")
        elif tag == "a":
            linked = not closing and "href" in token[3].lower()
        if tag in _BLOCK:
            block = None
        if tag in _VOID or tag in _INLINE or tag in _SKIPPED:
            continue
        if closing:
            if held[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                changed = stack[-1][1] != (stack[depth - 1][1] if depth else 0)
                drop(depth)
                if changed:
                    block = None
            continue
        if tag in _BLOCK and held["p"]:
            close({"p"}, {"table", "button", "object", "td", "th", "caption"})
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        _, container, mark = stack[-1] if stack else ("", 0, 0)
        said = _mark(tag, token[3], mark) if mark >= 0 else None
        if said is not None:
            containers += 1
            container, mark = containers, said
            block = None
        if not token[3].rstrip().endswith("/") or tag in _BLOCK:
            stack.append((tag, container, mark))
            held[tag] += 1
    for b in blocks:
        b.text = " ".join("".join(b.parts).split())
    return [b for b in blocks if b.text]


def _decide(block: Block, article: bool, stops: bool) -> bool | None:
    """First pass: good, bad, or None where the block alone cannot tell."""
    if block.mark < 0 or (article and block.mark == 0):
        return False
    inside = block.mark > 0
    n = len(block.text)
    links = block.linked / max(1, len(block.text.replace(" ", "")))
    if links > LINKS_MOST and (not inside or block.tag in _LIST_PARTS):
        return False
    if n < SHORT:
        return None if inside or not (block.linked or "©" in block.text) else False
    words = _WORD.findall(block.text.lower())
    density = sum(w in _STOP for w in words) / max(1, len(words))
    if density >= STOP_HIGH or not stops:
        return True if n > LONG else None
    return None if inside or density >= STOP_LOW else False


def classify(blocks: list[Block]) -> list[Block]:
    """Labels every block of a page: both passes."""
    article = any(b.mark > 0 for b in blocks)
    stops = any(
        len(words) >= 8 and sum(w in _STOP for w in words) >= STOP_LOW * len(words) for words in (_WORD.findall(b.text.lower()) for b in blocks)
    )
    for b in blocks:
        b.good = _decide(b, article, stops)
    decided = [b.good for b in blocks]
    following: dict[int, int] = {}
    after = [-1] * len(blocks)
    for i in range(len(blocks) - 1, -1, -1):
        after[i] = following.get(blocks[i].container, -1)
        if decided[i] is not None:
            following[blocks[i].container] = i
    before: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if decided[i] is not None:
            before[b.container] = i
            continue
        last, coming = before.get(b.container, -1), after[i]
        if b.tag in _HEADINGS and coming >= 0:
            b.good = decided[coming]
        elif last < 0 and coming < 0:
            # nothing decided in the container: it speaks for itself
            b.good = b.mark > 0 or (len(b.text) >= SHORT and not article)
        elif last < 0 or coming < 0:
            b.good = decided[max(last, coming)]
        elif i - last == coming - i:
            b.good = decided[last] if decided[last] == decided[coming] else b.mark > 0
        else:
            b.good = decided[last] if i - last < coming - i else decided[coming]
    return blocks


def main_text(page: str | None) -> str:
    """The good blocks of a page, joined by one space."""
    return " ".join(b.text for b in classify(blocks_of(page or "")) if b.good)


def extract_text(pages: DataFrame, keys: tuple[str, ...] = ("page_id", "url"), column: str = "html", blocks: bool = False) -> DataFrame:
    """The ``keys`` columns, text and n_chars of every row's whole page; with ``blocks`` also every block and its label.

    A null or empty page, and one without an article, gives the empty text and 0.  A
    page cut off anywhere is read as far as it goes.  Repeated rows give repeated
    results; null keys are kept; columns not named are not read.  An empty table gives
    no rows.  One map over the scan, no shuffle; memory is bounded by the longest page.
    """
    kinds = [f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys]
    schema = [*kinds, "text string", "n_chars long"]
    if blocks:
        schema.append("blocks array<struct<tag:string,text:string,good:boolean>>")
    names = [*keys, "text", "n_chars", "blocks"][: len(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.batches_by_size(batches, "_page"):
            labelled = [classify(blocks_of(page or "")) for page in batch.column("_page").to_pylist()]
            texts = [" ".join(b.text for b in page if b.good) for page in labelled]
            columns = [batch.column(f"_key{i}") for i in range(len(keys))]
            columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            if blocks:
                kind = pa.list_(pa.struct([("tag", pa.string()), ("text", pa.string()), ("good", pa.bool_())]))
                columns.append(pa.array([[{"tag": b.tag, "text": b.text, "good": b.good} for b in page] for page in labelled], kind))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = pages.select(*(pages[f"`{k}`"].alias(f"_key{i}") for i, k in enumerate(keys)), pages[f"`{column}`"].alias("_page"))
    return rows.mapInArrow(run, ", ".join(schema))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(text.table(spark, sf_dir, "pages"))
