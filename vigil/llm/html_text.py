"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. What stands in scripts, styles,
menus, page headers, footers, sidebars, forms, or in elements whose class, id or
role names a notice, advert, comment or the like is no candidate. The first pass decides
blocks by length, link density and stop-word density: good, bad, or ambiguous if too
short or in between; few stop words alone make none bad, as they may be of another language. Undecided neighbours that
hold more than ``LONG`` characters together are text, and so good. In the second pass an ambiguous block takes the label of its
nearest decided neighbours of the same part of the page (both equal, or the nearer
one, or the good one of two as near). Where a page marks its article (article or main elements), all blocks inside
are good, and no others.

Each page is one row's work; a page's size is the only thing held at a time besides the Arrow batch.

Defined results: null or empty html, and pages without good blocks, give empty text and
n_chars 0; unclosed tags and entities cut off at the end are read as browsers do; a
null page_id or url is passed on; repeated pages are treated each; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from vigil.llm.scratch import ship_by_value

# Frequent function words of the languages to expect.
STOP_WORDS = frozenset("""
a about after all also an and are as at be been but by can could did do for from had has have he her his how i if in into is it its
more no not of on one or our out she so some such than that the their them then there these they this to up was we were what when which who will with would you your
aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer eines er es für hat haben ich ihr im in ist ja kein
man mehr mit nach nicht noch nur oder sein sich sie sind so über um und uns unter vom von vor war wenn werden wie wird wir zu zum zur
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais me même ne nous on ou où par pas plus pour qu que qui sa sans se ses son sont sur un une vous
al algo como con de del desde donde el ella en entre era es esta este esto fue ha han hasta la las le lo los más me mi muy no nos o para pero por que se sin sobre su sus también un una uno y ya
""".split())

# Element names by what is done with them.
RAW_TEXT = frozenset("script style noscript template textarea title svg math iframe object select xmp noembed noframes".split())
DROPPED = frozenset("head nav footer aside form button dialog menu fieldset".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Start tags that end open elements (whose end tags may be omitted), and where the search for those stops.
_ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li
main menu nav ol p pre section summary table ul""".split())
_ROWS = frozenset("tbody thead tfoot".split())
IMPLIED = {"li": (frozenset(["li"]), frozenset("ul ol menu".split())), "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])), "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
           "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
           "tr": (frozenset(["tr", "caption"]), frozenset(["table"])), **{x: (_ROWS | {"caption"}, frozenset(["table"])) for x in _ROWS},
           "option": (frozenset(["option"]), frozenset("select datalist optgroup".split())), "optgroup": (frozenset(["optgroup", "option"]), frozenset(["select"]))}
IMPLIED |= {x: (frozenset([x]), frozenset("table td th button".split())) for x in ("a", "button")}
P_ONLY = (frozenset(["p"]), frozenset("table td th caption button".split()))
# Words in a class, id or role that mark what isn't the article.
MARKS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary contentinfo consent cookie cookies copyright
dialog disqus disclaimer footer header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pagination paywall popup promo promoted related
replies respond search share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags toolbar widget widgets""".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|[\s"'])hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
# Words that may stand beside those in a compound name, and names that an article's own text may bear as well.
BESIDE = frozenset("""area bar block bottom box btn button buttons container content fixed footer form global group inner item items left link links list main mobile
module outer page panel posts primary right row secondary section site slot stories articles sticky text top unit wrap wrapper""".split())
DOUBTFUL = frozenset("""banner copyright dialog disclaimer header login menu navigation notice notices notification overlay pagination related replies respond search
share sharing social sponsor sponsored subscription tags toolbar widget widgets""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAME_WORDS = re.compile(r"[a-z]+")
WORD = re.compile(r"[^\W\d_]+")

NOTICE = re.compile(r"(?:copyright\s*)?(?:©|\(c\)\s*\d{4})", re.IGNORECASE)
WIDE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")  # a character of these says as much as three letters

SHORT, LONG, MOST_LINKS, STOP_HIGH = 70, 200, 0.2, 0.32


class Block:
    """Text of a block, its characters within links, where it stands, and the number of the doubtful element that holds it, if any."""

    __slots__ = ("text", "linked", "part", "doubt")

    def __init__(self, text: str, linked: int, part: int, doubt: int = 0) -> None:
        self.text, self.linked, self.part, self.doubt = text, linked, part, doubt


def _names(value: str) -> Iterator[str]:
    """The marks among the names of a class, id or role: whole ones, and compounds of marks and words that go with them."""
    for name in value.lower().split():
        found = NAME_WORDS.findall(name)
        marks = MARKS.intersection(found)
        if marks and all(w in MARKS or w in BESIDE for w in found):
            yield from marks


def _marked(name: str, attributes: str, in_article: bool) -> bool | None:
    """Whether an element holds something else than the article; None if its blocks must tell."""
    if name in DROPPED or name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "article", "main") and not HIDDEN.search(attributes) and "comment" not in attributes.lower():
        return False
    if HIDDEN.search(attributes):
        return True
    found = set()
    for kind, a, b, c in ATTRIBUTE.findall(attributes):
        value, kind = a or b or c, kind.lower()
        if kind == "id" and (name in HEADINGS or name == "section" and not value.isalpha()):
            continue  # made from the heading's words
        found.update(_names(value))
    if not found:
        return False
    if not in_article or found - DOUBTFUL:
        return True
    return False if name == "p" or name in HEADINGS else None


def blocks_of(html: str) -> tuple[list[Block], bool]:
    """Candidate blocks in page order; whether the page marks its article."""
    out: list[Block] = []
    parts: list[tuple[str, int]] = []  # pieces of the block, and whether each is in a link
    stack: list[tuple[str, bool]] = []  # open elements, and whether what they hold is dropped
    count: dict[str, int] = {}  # open elements of each name
    outside = False  # what stands here is dropped
    doubt: tuple[int, int] | None = None  # number of the outermost doubtful element, and elements open around it
    n_doubts = 0
    article, links, any_article, at, n = 0, 0, False, 0, len(html)

    def push(name: str, dropped: bool) -> None:
        nonlocal outside
        stack.append((name, dropped))
        count[name] = count.get(name, 0) + 1
        outside = dropped

    def shorten(size: int) -> None:
        """End the elements from number ``size`` on."""
        nonlocal outside, doubt
        after = size > 0 and stack[size - 1][1]
        if after != outside or doubt and doubt[1] >= size or any(x in BLOCKS for x, _ in stack[size:]):
            flush()
        for x, _ in stack[size:]:
            count[x] -= 1
        del stack[size:]
        if doubt and doubt[1] >= size:
            doubt = None
        outside = after

    def close(names: frozenset[str], scope: frozenset[str], inline: bool = False) -> None:
        """End the innermost open element of ``names``, with all it holds, unless ``scope`` comes first; an article ends by its own tag only."""
        if not any(count.get(x) for x in names):
            return
        for k in range(len(stack) - 1, -1, -1):
            x, dropped = stack[k]
            if x in names:
                shorten(k)
                return
            if x in scope or x in ("article", "main") and not dropped or inline and x in BLOCKS:
                return

    def flush() -> None:
        text = " ".join("".join(p for p, _ in parts).split())
        if text:
            linked = len(" ".join("".join(p for p, in_link in parts if in_link).split()))
            out.append(Block(text, linked, 1 if article else 0, doubt[0] if doubt else 0))
        parts.clear()

    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            lt = n
        if lt > at and not outside:
            parts.append((unescape(html[at:lt]), links))
        if lt >= n:
            break
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if html[lt + 1: lt + 2] in ("!", "?"):
            end = html.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        tag = TAG.match(html, lt)
        if tag is None:
            after = html[lt + 1: lt + 3]
            if after[:1].isalpha() or after[:1] == "/" and after[1:].isalpha():  # a tag with an open quote, or cut off
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            else:
                if not outside:
                    parts.append(("<", links))
                at = lt + 1
            continue
        closing, name, attributes = tag.group(1), tag.group(2).lower(), tag.group(3)
        at = tag.end()
        if name in RAW_TEXT:
            if not closing and not attributes.endswith("/"):
                end = re.compile(f"</{re.escape(name)}\\s*>", re.IGNORECASE).search(html, at)
                at = n if end is None else end.end()
            continue
        if name in ("article", "main"):
            flush()
            if closing:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None) if count.get(name) else None
                if k is not None:
                    article -= sum(x in ("article", "main") and not dropped for x, dropped in stack[k:])
                    shorten(k)
                continue
            close(*P_ONLY)
            if not _marked(name, attributes, True):
                article += 1
                any_article = True
                push(name, False)  # a form or the like around the article isn't dropped
                continue
        elif closing:
            if name in BLOCKS:
                flush()
            close(frozenset([name]), frozenset(["table"]) if name not in ("table", "body", "html") and name in BLOCKS else frozenset(), name not in BLOCKS)
        else:
            if name in _ENDS_P:
                close(*P_ONLY)
            if name in IMPLIED:
                close(*IMPLIED[name])
        if outside:
            if not closing and name not in VOID and not attributes.endswith("/"):
                push(name, True)
            continue
        if name == "a":
            links = 0 if closing else 1
        if name == "br":
            parts.append((" ", links))
        if name in BLOCKS:
            flush()
            links = 0
        if not closing and name not in VOID and not attributes.endswith("/"):
            dropped = _marked(name, attributes, article > 0)
            if dropped is not False:
                flush()
            if dropped is None and not doubt:
                n_doubts += 1
                doubt = (n_doubts, len(stack))
            push(name, bool(dropped))
    flush()
    # a doubtful element stays if one of its blocks is prose: not short, and not mostly links
    prose = {b.doubt for b in out if weight(b.text) >= SHORT and b.linked <= MOST_LINKS * len(b.text)}
    return [b for b in out if not b.doubt or b.doubt in prose], any_article


def weight(text: str) -> int:
    return len(text) if text.isascii() else len(text) + 2 * len(WIDE.findall(text))


def first_pass(block: Block, marked: bool) -> bool | None:
    """Good, bad, or None for ambiguous."""
    if marked:
        return True
    text, size = block.text, weight(block.text)
    density = block.linked / len(text)
    if density > MOST_LINKS or NOTICE.match(text):
        return False
    if size < SHORT:
        return False if density > 0 else None
    found = [w.lower() for w in WORD.findall(text)]
    stop = sum(w in STOP_WORDS for w in found) / max(1, len(found))
    return True if stop >= STOP_HIGH and size > LONG else None


def text_runs(found: list[Block], labels: list[bool | None]) -> list[bool | None]:
    """``labels`` with the undecided blocks good that aren't short, where a run of undecided ones holds more than LONG; or all of them if nothing is good."""
    out, i = list(labels), 0
    sizes = [weight(b.text) if x is None else 0 for b, x in zip(found, labels, strict=True)]
    while i < len(out):
        j = i
        while j < len(out) and labels[j] is None and found[j].part == found[i].part:
            j += 1
        long = [k for k in range(i, j) if sizes[k] >= SHORT]
        if sum(sizes[k] for k in long) > LONG:
            for k in long:
                out[k] = True
        i = max(j, i + 1)
    if True not in out:
        out = [True if x is None and n >= SHORT else x for x, n in zip(out, sizes, strict=True)]
    return out


def second_pass(labels: list[bool | None], parts: list[int], marked: bool) -> list[bool]:
    """Ambiguous blocks take the label of the nearest decided neighbours of their part."""
    out = []
    for i, label in enumerate(labels):
        if label is None:
            near = []
            for step in (-1, 1):
                j = i + step
                while 0 <= j < len(labels) and parts[j] == parts[i] and labels[j] is None:
                    j += step
                if 0 <= j < len(labels) and parts[j] == parts[i]:
                    near.append((abs(j - i), labels[j]))
            if not near:  # nothing is decided: what is left of the page is its text
                label = True
            elif len({x for _, x in near}) == 1:
                label = near[0][1]
            else:
                label = marked or min(near, key=lambda x: (x[0], not x[1]))[1]  # the nearer one, a good one if as near
        out.append(label)
    return out


def main_text(html: str | None) -> str:
    """The blocks of the article, joined by two line ends."""
    found, marked = blocks_of(html or "")
    if marked:
        found = [b for b in found if b.part]
    labels = second_pass(text_runs(found, [first_pass(b, marked) for b in found]), [b.part for b in found], marked)
    return "\n\n".join(b.text for b, good in zip(found, labels, strict=True) if good)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    ship_by_value()
    rows = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                some = batch.slice(start, 1000)
                texts = [main_text(x.as_py()) for x in some.column("html")]
                yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars long")
