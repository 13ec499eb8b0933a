"""Main text of web pages by the maximum-scoring subsequence of words and tags."""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Labelled pages that training reads at most, about.
TRAINING_PAGES = 5_000
# Evidence that a weight needs before it counts in full, and the range of weights.
PRIOR = 20.0
WORD_RANGE = (-4.0, 1.0)
# Tags that part regions, those of lists and tables, and those inside running text.
BLOCK_RANGE, LIST_RANGE, TEXT_RANGE = (-8.0, -0.02), (-2.0, -0.02), (-0.75, -0.02)
# Weights of what training has not seen: words in links are more often menus than text.
UNSEEN_WORD, UNSEEN_LINKED, UNSEEN_BLOCK, UNSEEN_TEXT = 1.0, -0.5, -2.0, -0.1

# Fixed values of HTML.
HIDDEN = frozenset("script style noscript template head title iframe object embed svg math canvas audio video select option textarea button input datalist".split())
APART = frozenset("nav header footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
TEXT_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre hr".split())
LISTS = frozenset("ul ol li dl dt dd table caption tbody thead tfoot tr td th".split())
# Elements whose start closes an open paragraph or item.
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}

# Words that name, in a class, id or role, a part that is not the article.
APART_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe signup login menu nav navbar navigation breadcrumb "
    "breadcrumbs toolbar sidebar side aside widget widgets footer foot header masthead topbar comment comments reply replies "
    "respond disqus discussion related recommended recommendations share sharing social pagination pager skip tags search".split()
)
# Words that turn such a name into one of the layout around the article.
LAYOUT_WORDS = frozenset("has with no without layout".split())
# Words of such names that speak for the article, and those that never do.
CONTENT_WORDS = frozenset("article articles content main post entry story page body text blog news".split())
NEVER_WORDS = frozenset("comment comments reply replies respond disqus discussion cookie cookies consent gdpr".split())
NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
INVISIBLE = re.compile(r"""\s(?:hidden(?=[\s=>/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
# A quote opens a value only after an equals sign, as in HTML's own rules; one that is never closed opens nothing.
PARTS = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)",
    re.S,
)
WORDS = re.compile(r"\S+")


def _words(name: str) -> set[str]:
    return {w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w}


def _names_apart(names: str) -> tuple[bool, bool]:
    """Whether names of a class, id or role tell a part apart from the article, and whether they may still wrap it."""
    found = [_words(name) for name in names.split()]
    apart = any(APART_WORDS & words and not LAYOUT_WORDS & words for words in found)
    words = set().union(*found)
    return apart, bool(CONTENT_WORDS & words) and not NEVER_WORDS & words


# How an element stands to the article by its markup alone.
OPEN, GONE, ASIDE, WRAPS = range(4)


class _Stack:
    """Open elements; each step costs the elements it closes, however deep the page is."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.numbers: list[int] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, name: str, number: int) -> None:
        place = len(self.names)
        self.names.append(name)
        self.numbers.append(number)
        self.places.setdefault(name, []).append(place)
        if name in BLOCK:
            self.blocks.append(place)

    def close(self, name: str, past_blocks: bool) -> None:
        """Close the innermost element of that name and all inside it; ``past_blocks`` tells whether blocks inside stop it."""
        places = self.places.get(name)
        if not places or (not past_blocks and self.blocks and self.blocks[-1] > places[-1]):
            return
        place = places[-1]
        while len(self.names) > place:
            self.places[self.names.pop()].pop()
            self.numbers.pop()
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()

    def current(self) -> int:
        return self.numbers[-1] if self.numbers else 0


class _Elements:
    """Elements in the order of their starts; number 0 is the page."""

    def __init__(self) -> None:
        self.parents, self.kinds, self.words, self.heads = [0], [OPEN], [0], [0]

    def add(self, parent: int, kind: int, is_head: bool) -> int:
        self.parents.append(parent)
        self.kinds.append(kind)
        self.words.append(0)
        self.heads.append(int(is_head))
        return len(self.parents) - 1

    def apart(self) -> list[bool]:
        """Which elements are never the article. One that is so by its name or kind, but holds most words of the page outside
        of links, and a heading, an ``article`` or a fitting name besides, is a wrapper around it."""
        words, heads = self.words[:], self.heads[:]
        for number in range(len(words) - 1, 0, -1):
            if self.kinds[number] != GONE:
                words[self.parents[number]] += words[number]
                heads[self.parents[number]] += heads[number]
        found = [False] * len(words)
        for number in range(1, len(words)):
            kind, parent = self.kinds[number], self.parents[number]
            own = kind == GONE or kind in (ASIDE, WRAPS) and not (2 * words[number] > words[0] and (kind == WRAPS or heads[number]))
            found[number] = found[parent] or own
        return found


def _kind(name: str, rest: str, by_name: bool) -> int:
    if name in HIDDEN or INVISIBLE.search(" " + rest):
        return GONE
    if name in APART:
        return WRAPS if name in ("form", "header") else ASIDE
    if by_name and rest and name not in ("body", "html", "main", "article"):
        for a, b, c in NAMES.findall(rest):
            apart, content = _names_apart(a or b or c)
            if apart:
                return WRAPS if content else ASIDE
    return OPEN


def tokens(page: str, by_name: bool = True) -> list[tuple[str, str, bool]]:
    """``(kind, value, apart)``: kind ``tag`` with its name, ``break`` at a block's edge,
    or ``text`` with decoded text; ``apart`` inside parts that are never the article, by their
    element or (``by_name``) by their class, id or role."""
    found: list[tuple[str, str, int]] = []
    stack, elements, linked, at = _Stack(), _Elements(), 0, 0
    while at < len(page):
        part = PARTS.search(page, at)
        text = page[at : part.start()] if part else page[at:]
        if text:
            found.append(("text", html.unescape(text), stack.current()))
            if not linked:
                elements.words[stack.current()] += len(WORDS.findall(text))
        if not part:
            break
        at = part.end()
        closing, name, rest = part.group(1), (part.group(2) or "").lower(), part.group(3) or ""
        if not name:
            continue
        if closing:
            if name in BLOCK:
                found.append(("break", name, stack.current()))
            found.append(("tag", "/" + name, stack.current()))
            linked = max(0, linked - 1) if name == "a" else linked
            stack.close(name, past_blocks=name in BLOCK)
            continue
        if name in CLOSES_P:
            stack.close("p", past_blocks=False)
        if name in BLOCK:
            found.append(("break", name, stack.current()))
        number = elements.add(stack.current(), _kind(name, rest, by_name), name in ("h1", "article", "main"))
        found.append(("tag", name, number))
        linked += name == "a"
        if name in RAW:
            end = _raw_end(name).search(page, at)
            at = end.end()
        elif name not in VOID and not rest.endswith("/"):
            stack.push(name, number)
    apart = elements.apart()
    return [(kind, value, apart[number]) for kind, value, number in found]


@functools.cache
def _raw_end(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I)


def label(page: str) -> tuple[Counter, Counter]:
    """Counts inside and outside the one ``article`` of a labelled page: words by their
    enclosing element, and tags. A page without exactly one article is no label."""
    inside, outside = Counter(), Counter()
    found = tokens(page)
    starts = [i for i, (kind, value, _) in enumerate(found) if kind == "tag" and value == "article"]
    ends = [i for i, (kind, value, _) in enumerate(found) if kind == "tag" and value == "/article"]
    if len(starts) != 1 or len(ends) != 1 or ends[0] < starts[0]:
        return inside, outside
    for i, (feature, count) in enumerate(_features(found)):
        if feature:
            (inside if starts[0] < i < ends[0] else outside)[feature] += count
    return inside, outside


def _features(found: list[tuple[str, str, bool]]) -> Iterator[tuple[str | None, int]]:
    """For each token its weight's name and how often it counts."""
    linked, element = 0, "body"
    for kind, value, apart in found:
        if kind == "break":
            element = value
            yield None, 0
        elif kind == "tag":
            linked = linked + 1 if value == "a" else max(0, linked - 1) if value == "/a" else linked
            yield "tag " + value.lstrip("/"), 1
        else:
            words = len(WORDS.findall(value))
            place = "apart" if apart else "linked" if linked else element
            yield ("word " + place if words else None), words


def learn(pages: DataFrame, rows: int = TRAINING_PAGES) -> dict[str, float]:
    """Weights from labelled pages: those whose own markup has exactly one ``article``.

    A weight is the log-odds of standing inside the article, drawn to zero where
    evidence is thin; words and tags keep to their ranges, and tags below zero. About ``rows`` labelled
    pages, drawn by a hash of the id, are read.
    """
    labelled = pages.where(F.col("html").cast("string").rlike("(?i)<article[\\s>]"))
    count = labelled.count()
    if count > rows:
        labelled = labelled.where(F.pmod(F.xxhash64("page_id"), F.lit(1 << 20)) < int((1 << 20) * rows / count))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0).to_pylist():
                within, without = label(page)
                inside += within
                outside += without
        names = sorted({*inside, *outside})
        yield pa.RecordBatch.from_pydict(
            {"name": names, "inside": [inside[n] for n in names], "outside": [outside[n] for n in names]},
            schema=pa.schema([("name", pa.string()), ("inside", pa.int64()), ("outside", pa.int64())]),
        )

    counts = labelled.select(F.col("html").cast("string").alias("html")).mapInArrow(counted, "name string, inside long, outside long")
    sums = counts.groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    # Names of elements are few, but a hostile page may invent them: rare ones teach nothing.
    usual = sums.where("inside + outside >= 20").orderBy(F.desc(F.col("inside") + F.col("outside")), "name").limit(1000)
    return weights_of([(r["name"], r["inside"], r["outside"]) for r in usual.collect()])


def weights_of(counts: list[tuple[str, int, int]]) -> dict[str, float]:
    total_in = sum(i for _, i, _ in counts) + 1.0
    total_out = sum(o for _, _, o in counts) + 1.0
    weights = {}
    for name, inside, outside in counts:
        share = (inside + outside) / (inside + outside + PRIOR)
        odds = math.log((inside + 0.5) / total_in) - math.log((outside + 0.5) / total_out)
        low, high = _range(name)
        weights[name] = min(high, max(low, share * odds))
    return weights


def _range(name: str) -> tuple[float, float]:
    kind, _, value = name.partition(" ")
    if kind == "word":
        return WORD_RANGE
    return LIST_RANGE if value in LISTS else BLOCK_RANGE if value in BLOCK - TEXT_BLOCK else TEXT_RANGE


def _unseen(name: str) -> float:
    kind, _, value = name.partition(" ")
    if kind == "word":
        return UNSEEN_LINKED if value == "linked" else UNSEEN_WORD
    return UNSEEN_BLOCK if value in BLOCK - TEXT_BLOCK - LISTS else UNSEEN_TEXT


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The blocks of the best contiguous region, one per line.

    Words score by where they stand (1 unless learned otherwise), tags below zero; parts
    that are never the article score nothing, unless they hold most of the page's words and so wrap it. The region of greatest total wins, the
    first one among equals. Where names of classes leave nothing, only elements count as such parts.
    """
    return _best_region(page or "", weights, True) or _best_region(page or "", weights, False)


def _best_region(page: str, weights: dict[str, float], by_name: bool) -> str:
    found = tokens(page, by_name)
    best, best_range, total, start = 0.0, (0, 0), 0.0, 0
    for i, ((kind, _, apart), (feature, count)) in enumerate(zip(found, _features(found))):
        if feature is None or apart:
            continue
        weight = weights.get(feature)
        total += count * (_unseen(feature) if weight is None else weight)
        if total > best:
            best, best_range = total, (start, i + 1)
        if total <= 0:
            total, start = 0.0, i + 1
    blocks: list[str] = []
    parts: list[str] = []
    for kind, value, apart in found[best_range[0] : best_range[1]]:
        if kind == "break":
            blocks.append("".join(parts))
            parts = []
        elif kind == "text" and not apart:
            parts.append(value)
        elif kind == "tag" and value == "br":
            parts.append(" ")
    blocks.append("".join(parts))
    lines = (" ".join(block.split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page; weights are learned from the pages if not given.

    Null, empty and unmarked html, broken and unclosed markup are ordinary input: a null page is empty,
    a text without tags is one block. Pages of any length are read whole. Without labelled
    pages the weights of unseen words and tags hold. Repeated and null ids are ordinary rows;
    an empty table gives no rows; other columns are ignored.
    """
    learned = learn(pages) if weights is None else weights

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, learned) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(extracted, f"{kinds}, text string, n_chars long")
