"""Main text of web pages by two passes of block rules.

Elements that never hold the article (menus, footers, forms, comments and the like)
are set aside. Of all other blocks the first pass decides those it can: much link
text is boilerplate, enough stop words for its length is text. The second gives the
ambiguous ones, short or without stop words, the label of their nearest decided
neighbours; being ambiguous alone never drops a block.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .textarray import slices, tidy

# Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    (
        "a an and are as at be been but by for from had has have he her his i in is it its not of on or our she so that the their them there they this to was we were what when which who will with would you "
        "aber als am an auch auf aus bei bis das dass dem den der des die doch durch ein eine einem einen einer er es für hat ich ihr im in ist mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wie wir zu zum zur "
        "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais me même mon ne nos notre nous on ou par pas pour qu que qui sa se ses son sur ta te tu un une vous y "
        "al como con de del el ella en entre era es esta este ha la las le lo los más me mi no nos o para pero por que se si sin sobre su sus también te tu un una uno y ya"
    ).split()
)

# Elements of HTML by their role.
RAW = frozenset("script style noscript template svg math iframe object textarea title canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
ASIDE = frozenset("nav footer aside form menu button select dialog fieldset head".split())
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that mark what isn't the article.
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|comments?|disqus|contentinfo|cookies?|consent|copyright|footer|gdpr|login|masthead|menu|modal|nav|navbar|navigation|navlinks|newsletter|notice|notification|pager|pagination|popup|promo|promoted|related|replies|search|share|sharing|sidebar|signup|skip|social|sponsor|sponsored|subscribe|toolbar|topbar|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/><]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^><])*+)>|<[!?][^<>]*>|<[/a-zA-Z!?][^<>]*\Z", re.DOTALL)
_CLOSE = {name: re.compile(rf"</{name}[^>]*>", re.IGNORECASE) for name in RAW}
_WORD = re.compile(r"[^\W\d_]+")

SHORT, LONG = 70, 200
STOPS_LOW, STOPS_HIGH = 0.15, 0.30
LINKS = 0.4


class Block:
    __slots__ = ("parts", "linked", "place", "heading")

    def __init__(self, place: str, heading: bool):
        self.parts: list[str] = []
        self.linked = 0
        self.place = place  # "aside" if it is never text, "main" in an article, else ""
        self.heading = heading


def _mark(name: str, attributes: str, inside_main: bool) -> str:
    """What an element says of the text in it."""
    if name in ASIDE or name == "header" and not inside_main or attributes and _HIDDEN.search(attributes):
        return "aside"
    role = ""
    for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role" and value.lower() == "main":
            role = "main"
        elif name not in ("body", "html", "article", "main") and _MARKS.search(value):
            return "aside"
    return "main" if name in MAIN else role


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, as its tags have them; the page may be cut off anywhere."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []  # open elements and what their text is
    current: Block | None = None
    solid: list[int] = []  # places of block elements in the stack
    names: Counter[str] = Counter()  # of the stack
    marks: Counter[str] = Counter()
    at, breaks = 0, 0

    def close(k: int) -> None:
        for name, mark in stack[k:]:
            names[name] -= 1
            marks[mark] -= 1
        del stack[k:]
        while solid and solid[-1] >= k:
            solid.pop()

    def add(text: str) -> None:
        nonlocal current
        if not text:
            return
        if current is None:
            if not text.strip():
                return
            current = Block("aside" if marks["aside"] else "main" if marks["main"] else "", any(names[h] for h in HEADINGS))
            out.append(current)
        current.parts.append(text)
        if names["a"]:
            current.linked += len(text)

    while at < len(page):
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        text = page[at : m.start()]
        if text.strip():
            breaks = 0
        add(text)
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), m[1] == "/"
        if name in RAW:
            if not closing and not m[3].endswith("/"):
                end = _CLOSE[name].search(page, at)
                at = end.end() if end else len(page)
            continue
        if name == "br":
            breaks += 1
            add(" ")
            if breaks > 1:
                current = None
            continue
        if name in BLOCK:
            current, breaks = None, 0
        if name in VOID:
            continue
        if closing:
            if names[name] > 0:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
            continue
        if name in BLOCK and stack:
            # an open paragraph ends where a block begins, and what is inline in it too
            k = solid[-1] if solid else -1
            if k >= 0 and stack[k][0] == "p" or k >= 0 and name == stack[k][0] and name in ("li", "dd", "dt", "td", "th", "tr", "option"):
                close(k)
        if m[3].endswith("/") and name not in BLOCK:
            continue
        if name in BLOCK:
            solid.append(len(stack))
        stack.append((name, _mark(name, m[3], marks["main"] > 0)))
        names[name] += 1
        marks[stack[-1][1]] += 1
    return out


def first_pass(b: Block) -> bool | None:
    """Whether a block that isn't set aside is text, by its links, length and stop words; None where these don't tell."""
    text = "".join(b.parts)
    size = len(text.strip())
    if b.heading:
        return None
    if b.linked > LINKS * max(1, len(text)):
        return False
    if size < SHORT:
        return None
    words = _WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    return True if stops >= STOPS_HIGH or stops >= STOPS_LOW and size >= LONG else None


def second_pass(labels: list[bool | None], heading: list[bool], edge: bool | None = None) -> list[bool]:
    """Labels of a run of blocks, the undecided ones from their nearest decided neighbours, text on a tie.

    ``edge`` is what stands before the first and after the last, None if that says nothing; a run of which nothing is decided is text.
    """
    labels, heading = [edge, *labels, edge], [False, *heading, False]
    decided = [i for i, x in enumerate(labels) if x is not None]
    out = []
    for i, x in enumerate(labels[1:-1], 1):
        if x is None:
            k = bisect_left(decided, i)
            before, after = decided[k - 1] if k else None, decided[k] if k < len(decided) else None
            if before is None and after is None:
                x = True
            elif before is None or after is None:
                x = labels[after if before is None else before]
            elif heading[i]:
                x = labels[after]  # a heading belongs to what follows
            elif i - before == after - i:
                x = labels[before] or labels[after]
            else:
                x = labels[before if i - before < after - i else after]
        out.append(bool(x))
    return out


def classify(found: list[Block]) -> list[bool]:
    """Which blocks are article text. Blocks in and outside of an ``article`` are no neighbours, and its edges count as text; without one all are."""
    out = [False] * len(found)
    for place in ("main", ""):
        at = [i for i, b in enumerate(found) if b.place == place]
        labels = [first_pass(found[i]) for i in at]
        if not place and True not in labels and any(b.place == "main" for b in found):
            continue  # what little stands beside an article isn't text unless some of it reads like text
        for i, x in zip(at, second_pass(labels, [found[i].heading for i in at], True if place else None), strict=True):
            out[i] = x
    return out


def main_text(page: str) -> str:
    found = blocks(page)
    texts = [" ".join(html.unescape("".join(b.parts)).split()) for b, good in zip(found, classify(found), strict=True) if good]
    return "\n\n".join(t for t in texts if t)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from one scan.

    Null and empty html give an empty text and 0; so does a page of nothing but
    menus and the like, or an empty table no rows. A page of any length is read whole, in time
    in proportion to it however deep or broken its elements are, and holds a task's memory
    for its own length only. Ids may be null, tie or repeat: a row in, a row out. Other
    columns don't matter, whatever their names.
    """

    def scan(batches):
        for batch in batches:
            for part in slices(batch.column(2)):
                texts = [main_text(part.data[a:b].tobytes().decode()) for a, b in zip(part.offsets[:-1], part.offsets[1:], strict=True)]
                first = [c.slice(part.first, len(texts)) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*first, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select("page_id", "url", "html")
    return source.mapInArrow(tidy(scan), f"page_id {source.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


#: What the rules come to on pages whose article is one ``article`` element of headings and paragraphs without links, as all of ``pages`` are.
ORACLE_SQL = r"""
with a as (
  select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') as body from pages),
b as (
  select page_id, url, list_transform(regexp_split_to_array(regexp_replace(regexp_replace(body, '<br>', ' ', 'g'), '</?b>', '', 'g'), '</?(?:p|h1)>|<[^<>]*$'), lambda x:
    trim(regexp_replace(regexp_replace(replace(replace(replace(x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) as blocks from a),
c as (select page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)) as text from b)
select page_id, url, text, cast(length(text) as bigint) as n_chars from c
"""
