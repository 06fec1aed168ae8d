"""Main text of web pages as the best-scoring contiguous run of tokens.

A page is a sequence of words and tags. Words score by where they stand (the nearest enclosing zone and
block), positive where text is content; tags score negative. Weights are log odds counted on pages that
mark their main text with an element; other pages are scored with the same weights. One linear scan
finds the contiguous run with the largest sum.
"""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import checkpointed

# Bounds of the fit: marked pages (the first by a hash of the id) and kinds of places that get weights.
SAMPLE_PAGES = 4_000
MAX_KINDS = 20_000
# Content outside of an element that is spoken against: from this share of all on, the element stays so.
CLEAR_SHARE = 0.05
# Names of a zone beyond so many characters are kept as a hash.
ZONE_CHARS = 200
# Frames around the content, one in the other, that are seen through; what stands in more of them is no content.
MAX_FRAMES = 16
TAG_WEIGHT = -0.5
INLINE_WEIGHT = -0.1
# Log odds before anything is counted, and how many words that opinion counts for.
PRIOR = 3.0
PRIOR_WORDS = 4.0

# Elements by their role.
MARKED = ("article", "main")
WHOLE = ("html", "body")
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
ZONES = frozenset("article aside dialog div footer form main menu nav section table td ul ol figure details".split())
UNSEEN = frozenset("head title script style noscript template iframe object svg math canvas audio video textarea select button".split())
RAW = frozenset("script style noscript iframe textarea title template xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
APART = frozenset("nav footer aside form menu dialog header".split())
# Names in class, id and role attributes that speak against and for content.
AGAINST = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer form header "
    "login menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies reply search share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
FOR = frozenset("article body content entry main post story text".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_MARKUP = re.compile(r"<(?=/?[a-zA-Z]|[!?])")
_STOP = re.compile(r"[>\"']")
# A slash at the end of a tag that belongs to an attribute's value without quotes.
_OWN_SLASH = re.compile(r"=\s*[^\s\"'=]+/$")
# Where a raw element ends; nothing before is markup.
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


@dataclass(frozen=True)
class Token:
    """A tag (no text) or the text between two tags; ``zone`` and ``block`` tell where it stands.
    ``aside`` is true in what stands apart inside a content zone, such as an advert in an article; ``inner``
    is the nearest zone where one around it, spoken against, is the ``zone``."""

    text: str | None
    zone: str
    block: str
    marked: bool
    breaks: bool
    hidden: bool
    aside: bool
    inner: str


@dataclass
class _Element:
    """An open element and what follows from those around it; the later fields are set by ``_judge``."""

    parent: int
    tag: str
    zone: str
    opinion: float
    block: str
    marked: bool
    hidden: bool
    near: int
    encloses: bool = False
    against: int = -1
    levels: int = 0
    content: bool = False
    aside: bool = False
    kind: int = 0


def _zone(tag: str, attributes: str) -> str:
    names = sorted({n.lower() for m in _NAMES.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").split()})
    if not names:
        return tag
    zone = f"{tag}.{'.'.join(names)}"
    if len(zone) <= ZONE_CHARS:
        return zone
    # Of a longer one the telling words and a hash of all, in digits, which are no words themselves.
    telling = sorted({p for n in names for p in _PARTS.findall(n)} & (AGAINST | FOR))
    digest = hashlib.blake2b(zone.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return f"{tag}.{'.'.join([*telling, f'#{int.from_bytes(digest)}'])}"


def _markup_end(page: str, at: int) -> int:
    """Place of the ">" that ends a tag, outside of quotes; -1 if there is none. A quote that nothing closes is a
    character like others."""
    while (stop := _STOP.search(page, at)) is not None:
        if stop[0] == ">":
            return stop.start()
        closing = page.find(stop[0], stop.end())
        at = closing + 1 if closing >= 0 else stop.end()
    return -1


def _parts(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", tag, attributes) and ("close", tag, ""), in one pass: whatever is looked for and
    not found is not looked for again."""
    at = 0
    while at < len(page):
        found = _MARKUP.search(page, at)
        if found is None:
            yield "text", page[at:], ""
            return
        if found.start() > at:
            yield "text", page[at : found.start()], ""
        at = found.start()
        if page.startswith(("<!--", "<![CDATA["), at):
            mark = "-->" if page.startswith("<!--", at) else "]]>"
            end = page.find(mark, at + 4)
            at = len(page) if end < 0 else end + 3
            continue
        tag = _TAG.match(page, at)
        special = tag is None
        end = page.find(">", at) if special else _markup_end(page, tag.end())
        if end < 0:
            # Nothing that follows is a tag.
            yield "text", page[at:], ""
            return
        at = end + 1
        if special:
            continue
        name, attributes = tag[2].lower(), page[tag.end() : end]
        if tag[1]:
            yield "close", name, ""
            continue
        yield "open", name, attributes
        if name in RAW:
            last = _ENDS[name].search(page, at)
            if last is None and attributes.rstrip().endswith("/"):
                # A page in the manner of XML; the element is empty.
                yield "close", name, ""
                continue
            if last is None:
                return
            at = last.end()
            yield "close", name, ""


class _Stack:
    """Open elements from the outside in, with the places of each tag and of zones among them."""

    def __init__(self) -> None:
        self.open = [0]
        self.tags = [""]
        self.places: dict[str, list[int]] = {}
        self.zones: list[int] = []
        # So many from the outside are known to enclose a main element.
        self.enclosing = 0

    def push(self, number: int, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in ZONES:
            self.zones.append(len(self.open))
        self.open.append(number)
        self.tags.append(tag)

    def place(self, tag: str) -> int:
        """Where the innermost open element of a tag is; 0 if there is none."""
        found = self.places.get(tag)
        return found[-1] if found else 0

    def end_at(self, place: int) -> None:
        while len(self.open) > place:
            self.open.pop()
            tag = self.tags.pop()
            self.places[tag].pop()
            if tag in ZONES:
                self.zones.pop()
        self.enclosing = min(self.enclosing, place)


def tokens_of(page: str) -> Iterator[Token]:
    """Tokens of a page in order. Unclosed elements end with the element around them; what scripts,
    styles and comments hold is not text. The time grows with the page's length, whatever it holds."""
    elements = [_Element(-1, "", "", 0.0, "body", False, False, -1)]
    found: list[tuple[str | None, int, bool]] = []
    stack = _Stack()
    for kind, tag, attributes in _parts(page):
        if kind == "text":
            found.append((html.unescape(tag), stack.open[-1], False))
            continue
        if kind == "close":
            if place := stack.place(tag):
                stack.end_at(place)
        elif tag not in VOID and (tag in RAW or not attributes.rstrip().endswith("/") or _OWN_SLASH.search(attributes[-500:])):
            if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option"):
                # A paragraph or item ends where the next begins, inside the same zone.
                place = stack.place(tag)
                if place and (not stack.zones or place > stack.zones[-1]):
                    stack.end_at(place)
            around = elements[stack.open[-1]]
            zone, n = _zone(tag, attributes), len(elements)
            elements.append(_Element(
                stack.open[-1], tag, zone, 0.0 if tag in WHOLE else _opinion(zone), tag if tag in BLOCKS else around.block,
                around.marked or tag in MARKED, around.hidden or tag in UNSEEN, n if tag in ZONES else around.near,
                encloses=tag in WHOLE,
            ))
            if tag == "main":
                for i in stack.open[stack.enclosing :]:
                    elements[i].encloses = True
                stack.enclosing = len(stack.open)
            stack.push(n, tag)
        found.append((None, stack.open[-1], tag in BLOCKS))
    words = [0] * len(elements)
    for text, i, _ in found:
        if text is not None and not elements[i].hidden:
            words[i] += len(text.split())
    _judge(elements)
    for _ in range(MAX_FRAMES):
        if not _enclosing(elements, words):
            break
        _judge(elements)
    for text, i, breaks in found:
        e = elements[i]
        near = elements[e.near] if e.near >= 0 else None
        inner = "body" if near is None else f"!{near.zone}" if near.encloses and near.opinion < 0 else near.zone
        zone = elements[e.against].zone if e.against >= 0 else inner
        yield Token(text, zone, e.block, e.marked, breaks, e.hidden, e.aside, inner)


def _judge(elements: list[_Element]) -> None:
    """Set for every element the outermost one around it that is spoken against and does not enclose the
    content (``against``, with the number of such in ``levels``), and the nearest telling one's ``kind``:
    2 marked, 1 named as content, 0 else."""
    for i, e in enumerate(elements[1:], 1):
        around = elements[e.parent]
        e.against, e.levels, e.aside, e.content, e.kind = around.against, around.levels, around.aside, around.content, around.kind
        if e.opinion < 0:
            if not e.encloses and not (around.content and e.zone == "header"):
                e.levels, e.kind = e.levels + 1, 0
                if e.against < 0:
                    e.against, e.aside = i, around.content
        elif e.opinion >= PRIOR:
            e.kind = max(2 if e.tag in MARKED else 1, e.kind)
            e.content |= e.against < 0


def _enclosing(elements: list[_Element], words: list[int]) -> bool:
    """Find elements that are spoken against but enclose the content of the page: hardly any content
    stands outside of them. Names such as "has-sidebar" of a frame around everything tell nothing. Where
    no content is marked or named, it is a frame if it has other elements spoken against inside. A nav,
    footer or the like is one only if marked content is in it. False if there are none."""
    clear = [0, 0, 0]
    inside: dict[int, list[int]] = {}
    framed: set[int] = set()
    for e, n in zip(elements, words, strict=True):
        if n and e.against < 0:
            clear[e.kind] += n
        elif n:
            inside.setdefault(e.against, [0, 0, 0])[e.kind] += n
            if e.levels > 1:
                framed.add(e.against)
    if not inside:
        return False
    gains = {i: k[2] + k[1] * (k[2] > 0 or elements[i].tag not in APART or elements[i].tag == "form") for i, k in inside.items()}
    top = max(gains.values())
    if top:
        named = not any(inside[i][2] for i, gain in gains.items() if 2 * gain >= top)
        if clear[1] + clear[2] >= CLEAR_SHARE * (clear[1] + clear[2] + sum(gains.values())) or named and clear[0] >= top:
            return False
        chosen = [i for i, gain in gains.items() if 2 * gain >= top]
    else:
        chosen = [i for i in framed if elements[i].tag not in APART or elements[i].tag == "form"]
        if sum(clear) >= CLEAR_SHARE * (sum(clear) + sum(sum(inside[i]) for i in chosen)):
            return False
    for i in chosen:
        elements[i].encloses = True
    return bool(chosen)


def _opinion(zone: str) -> float:
    """Prior log odds that words of a zone are content, from its names; those of a frame around the
    content ("!" before it) tell nothing."""
    tag, _, names = zone.partition(".")
    parts = {p.lower() for p in _PARTS.findall(names)}
    if zone.startswith("!"):
        return 0.5
    if tag == "main":
        return PRIOR
    if parts & AGAINST or tag in APART:
        return -PRIOR
    if parts & FOR or tag in MARKED:
        return PRIOR
    return 0.5


@dataclass(frozen=True)
class PageModel:
    """Words counted inside and outside of marked text, by zone and by zone and block."""

    zones: dict[str, tuple[int, int]]
    places: dict[tuple[str, str], tuple[int, int]]

    def weight(self, zone: str, block: str) -> float:
        """Log odds of the place, smoothed by those of its zone, and these by the prior opinion."""
        odds = _opinion(zone)
        for counts in (self.zones.get(zone), self.places.get((zone, block))):
            if counts:
                share = 1 / (1 + math.exp(-odds))
                inside, outside = counts[0] + PRIOR_WORDS * share, counts[1] + PRIOR_WORDS * (1 - share)
                odds = math.log(inside / outside)
        return max(-8.0, min(8.0, odds))


def extract(page: str | None, model: PageModel) -> str:
    """Text of the best run: its blocks joined by one newline, white space inside a block turned into one
    space. Inside the run, words of places that speak against content are left out; those that stand apart
    in a content zone weigh no more than a tag. If nothing is left, zones with names that were counted outvote a
    zone around them that was not."""
    tokens = list(tokens_of(page or ""))
    text = _best_run(tokens, model, [t.zone for t in tokens])
    if not text and model.zones:
        counted = [t.inner if "." in t.inner and t.inner in model.zones and t.zone not in model.zones else t.zone for t in tokens]
        text = _best_run(tokens, model, counted)
    return text


def _best_run(tokens: list[Token], model: PageModel, zones: list[str]) -> str:
    best, best_at, total, begin = 0.0, (0, 0), 0.0, 0
    weights: dict[tuple[str, str], float] = {}
    scores = []
    for i, token in enumerate(tokens):
        if token.text is None:
            score = TAG_WEIGHT if token.breaks else INLINE_WEIGHT
        else:
            key = (zones[i], token.block)
            if key not in weights:
                weights[key] = model.weight(*key)
            words = len(token.text.split())
            score = TAG_WEIGHT * (words > 0) if token.hidden or token.aside else weights[key] * words
        scores.append(score)
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, best_at = total, (begin, i + 1)
    blocks, current = [], []
    for token, score in zip(tokens[slice(*best_at)], scores[slice(*best_at)], strict=True):
        if token.text is None:
            if token.breaks:
                blocks.append(current)
                current = []
        elif score >= 0 and not token.hidden and not token.aside:
            current.append(token.text)
    blocks.append(current)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            for token in tokens_of(page or ""):
                if token.text is not None and not token.hidden and not token.aside and (n := len(token.text.split())):
                    counts[(token.zone, token.block, token.marked)] += n
    keys = sorted(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
         pa.array([counts[k] if k[2] else 0 for k in keys], pa.int64()),
         pa.array([0 if k[2] else counts[k] for k in keys], pa.int64())],
        names=["zone", "block", "inside", "outside"],
    )


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> PageModel:
    """Count words on at most ``sample_pages`` marked pages. The ``MAX_KINDS`` places with the most words
    get weights of their own, others those of their zone or the prior. No marked page leaves the prior."""
    given = pages.select(pages[id_col].cast("string").alias("id"), pages[html_col].cast("string").alias("page"))
    marked = given.filter(F.col("page").rlike(r"(?i)<(article|main)[\s>]"))
    chosen = F.broadcast(
        checkpointed(marked.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_pages))
    )
    sample = marked.join(chosen, "id", "left_semi").select("page")
    rows = (
        sample.mapInArrow(_counted, "zone string, block string, inside long, outside long")
        .groupBy("zone", "block").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .orderBy(F.desc(F.col("inside") + F.col("outside")), "zone", "block").limit(MAX_KINDS).collect()
    )
    zones: dict[str, tuple[int, int]] = {}
    for r in rows:
        a, b = zones.get(r["zone"], (0, 0))
        zones[r["zone"]] = (a + r["inside"], b + r["outside"])
    return PageModel(zones, {(r["zone"], r["block"]): (r["inside"], r["outside"]) for r in rows})


def extract_pages(pages: DataFrame, model: PageModel, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of each; null and empty pages, and pages without content, give an
    empty text. Repeated rows are extracted each. Pages are never cut; the time for one grows with its length, whatever
    it holds (below two seconds for a hostile megabyte). ``out`` replaces a column of that name; others stay."""
    @F.pandas_udf("string")
    def main_text(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(p, model) for p in pages], dtype=object)

    return pages.withColumn(out, main_text(pages[html_col].cast("string")))
