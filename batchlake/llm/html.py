"""Main text of web pages by the distribution of text over line blocks.

A page is first stripped of markup: a scanner walks over its tags, drops comments and the content
of elements that never hold article text (scripts, styles, navigation, forms, ...), and cuts the
rest into blocks at block-level tags. Each block is a line, weighted with its text length outside
of links. Sums over sliding windows of lines give the block distribution: a surge point is a line
at which the sum rises above a threshold that the page itself sets, a dive point one at which it
falls to nothing. What lies between a surge and the next dive is a stretch, trimmed to its first and
last line with text. The stretches choose the text of every page.

Where a page marks its article (``article``, ``main``), the marks bound and complete the stretches: a
stretch counts if its heaviest line lies in a marked element; an ``article`` with such a stretch is kept
whole, and so is a ``main`` that holds no ``article``; of the rest of a ``main`` the stretches stay. A further
``article`` without a surge is kept if it stands beside a kept one and isn't mostly links. Elsewhere a stretch is
joined with its neighbourhood: paragraphs that stand in the same element as its heaviest one, headings
that touch it or lie within a window before it in that element, and link-only list items of that
element that touch its end (or its begin, if the element is not the whole page).

Class words are hints. A word counts as a whole, or if all its hyphen-parts are such words. Words for
reader comments and advertisements drop an element wherever it stands (an ``article`` of that kind marks
nothing). Other words drop a container, but for one that holds an ``article`` or ``main`` or, on a page without
these, the page's heaviest window; inside an ``article`` or ``main`` only those words count that no part of an
article is named by.

Defined results: a null, empty or markup-only page has an empty text. Broken markup never fails: an
unclosed comment or tag runs to the end of the page, unclosed elements close with their parent.
Rows with null or repeated ids are returned as they are; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from batchlake.llm.arrow import ship, steps, with_columns

#: Fixed values of HTML: elements without content, elements whose content is raw text, and
#: elements that stand on lines of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements, roles and class words whose content is not the article's text.
DROPPED = frozenset(
    "head script style noscript template iframe object svg canvas nav footer aside form button "
    "select textarea menu dialog noembed noframes title datalist map audio video".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "signup nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer sidebar "
    "aside widget widgets related recommended share sharing social comment comments comment-list "
    "respond reply replies disqus discussion pagination pager toolbar topbar legal copyright".split()
)
#: Headings, elements of running text, list items, and lists and cells, which are no neighbourhood.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT = HEADINGS | {"p", "pre", "blockquote"}
ITEMS = frozenset({"li", "dt", "dd"})
LISTS = ITEMS | set("ul ol dl table tbody thead tfoot tr td th blockquote".split())
#: Elements in which an open element outside is out of reach, as HTML defines it.
_SCOPE = frozenset("applet caption html table td th marquee object template button svg math".split())
_WALL = (BLOCK | _SCOPE) - {"address", "div", "p"}
#: Elements that close an open one of the second set, and all within it, when they begin, unless one
#: of the third set lies between.
_TABLE = frozenset({"table", "template", "html"})
_CLOSES = {
    "li": (frozenset({"li"}), _WALL - {"li"}),
    "dt": (frozenset({"dt", "dd"}), _WALL - {"dt", "dd"}),
    "dd": (frozenset({"dt", "dd"}), _WALL - {"dt", "dd"}),
    "tr": (frozenset({"tr", "caption"}), _TABLE),
    "td": (frozenset({"td", "th"}), _TABLE | {"tr"}),
    "th": (frozenset({"td", "th"}), _TABLE | {"tr"}),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset({"tbody", "thead", "tfoot", "caption"}), _TABLE)),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
}
_P = frozenset({"p"})
#: Elements that close an open p.
_ENDS_P = BLOCK - set("body br caption html legend option tbody td tfoot th thead tr".split()) | {"dir", "search", "xmp"}

#: Class words that count wherever they stand, and those that count for containers inside a marked element.
ADS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
REPLIES = frozenset("comment comments comment-list respond reply replies disqus".split())
ASIDES = REPLIES | ADS | frozenset(
    "cookie cookies cookie-notice consent gdpr newsletter subscribe signup popup modal overlay nav navbar navigation "
    "menu breadcrumb breadcrumbs sidebar widget widgets related recommended share sharing pagination pager toolbar".split()
)
#: Elements that hold others. Inside a marked element only these are dropped for other words than ``ADS``.
CONTAINERS = frozenset("article details dl div fieldset ol section table ul".split())

#: A quote only opens a value right after "="; elsewhere, or if no other follows, it is a character.
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]*+))?+""")
_TAG = re.compile(
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>]*+))?+)*+)>?"""
)
_SPACE = re.compile(r"\s+")

#: Lines in a window, and the share of the page's heaviest window at which a stretch begins.
WINDOW, SURGE = 3, 0.08


def _dropped(name: str, attributes: str, inside: bool) -> tuple[bool, int]:
    """Whether an element's content is left out, and whether a class word speaks against it (2: as
    an advertisement, 3: as a reader's comment); ``inside``: it is part of a marked element."""
    if name in DROPPED or (name == "header" and not inside):
        return True, 0
    if name in ("html", "body", "main") or not attributes.strip():
        return False, 0
    doubtful, known = 0, CLASSES
    if name == "article":
        known = ASIDES if inside else REPLIES | ADS
    elif inside:
        known = ASIDES if name in CONTAINERS else ADS
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "role" and value in ROLES and name != "article":
            return True, 0
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True, 0
        if key in ("class", "id"):
            words = value.replace("_", "-").split()
            for w in words:
                if w in known or known.issuperset(w.split("-")):
                    replies = name in CONTAINERS and (w in REPLIES or REPLIES.issuperset(w.split("-")))
                    doubtful = max(doubtful, 3 if replies else 1 + (w in ADS))
    return False, doubtful


def _judged(
    weight: list[int], doubt: list[int], within: list[int], holds: list[bool], firm: list[bool], marked: bool
) -> np.ndarray:
    """Whether each line stays. ``doubt``: its innermost doubtful element or -1; by element:
    ``within``, the doubtful element around it or -1, ``holds``, whether it holds an article, and
    ``firm``, whether its weight counts for nothing."""
    guilty = [not x for x in holds]
    hidden = [False] * len(guilty)

    def settle() -> np.ndarray:
        for d, outer in enumerate(within):  # outer elements come first
            hidden[d] = guilty[d] or (outer >= 0 and hidden[outer])
        return np.array([d < 0 or not hidden[d] for d in doubt], dtype=bool)

    kept = settle()
    if marked or kept.all():
        return kept
    own = np.array(weight, dtype=np.int64)
    # An element's lines follow each other, but for those of firm elements in it.
    first, last = [len(doubt)] * len(guilty), [-1] * len(guilty)
    light = [False] * len(guilty)  # whether it is firm, or lies in a firm one
    for d, outer in enumerate(within):
        light[d] = (firm[d] and guilty[d]) or (outer >= 0 and light[outer])
    for k, d in enumerate(doubt):
        if d >= 0 and light[d]:
            own[k] = 0
        elif d >= 0:
            first[d], last[d] = min(first[d], k), k
    for d in range(len(within) - 1, -1, -1):
        if within[d] >= 0 and last[d] >= 0:
            first[within[d]], last[within[d]] = min(first[within[d]], first[d]), max(last[within[d]], last[d])
    heaviest = [int(window_sums(own[a : b + 1]).max()) if b >= 0 else 0 for a, b in zip(first, last, strict=True)]
    clean = int(window_sums(np.where(kept, own, 0)).max())
    most = max(heaviest)
    if most > clean:
        # The innermost element with the page's heaviest window, and those around it, stay.
        d = max(x for x, value in enumerate(heaviest) if value == most)
        while d >= 0:
            guilty[d] = False
            d = within[d]
    return settle()


def lines(page: str) -> tuple[list[str], np.ndarray, np.ndarray, list[int], list[tuple[str, int]]]:
    """Blocks of a page without markup, their text length outside of links, the marked element each lies
    in (0: none, else its number; negative in a ``main`` outside of any ``article``), the block-level element it
    stands in, and these elements (name, parent)."""
    out: list[str] = []  # pieces of lines; only an inline doubtful element cuts a line into pieces
    weight: list[int] = []
    inside: list[int] = []
    marks: list[int] = []  # the open marked elements, as in the result
    n_marks = 0
    names: Counter[str] = Counter()  # open elements
    node: list[int] = []
    elements: list[tuple[str, int]] = [("", -1)]
    blocks: list[int] = [0]  # the block-level element of each open element, after the page's own
    line: list[int] = []  # of each piece, the number of its line
    buffer: list[str] = []
    linked = n_lines = 0
    open_: list[tuple[str, bool, int, bool]] = []  # element, whether it is dropped, or doubtful, or a mark
    doubt: list[int] = []  # of each line, its innermost doubtful element
    within: list[int] = []  # of each doubtful element, the one around it
    holds: list[bool] = []
    firm: list[bool] = []
    replies: list[bool] = []
    hidden = links = open_p = 0
    doubtful = -1
    at, n = 0, len(page)

    def piece() -> None:
        """Put the buffer away as a piece of the line that is being read."""
        nonlocal linked
        if buffer:
            text = _SPACE.sub(" ", html.unescape("".join(buffer)))
            if text.strip():
                out.append(text)
                weight.append(max(0, len(text.strip()) - linked))
                inside.append(marks[-1] if marks else 0)
                doubt.append(doubtful)
                node.append(blocks[-1])
                line.append(n_lines)
            elif line and line[-1] == n_lines:
                out[-1] += " "  # a blank between two pieces
            buffer.clear()
        linked = 0

    def flush() -> None:
        nonlocal n_lines
        piece()
        n_lines += 1

    def close(k: int) -> None:
        """Close the open elements from number ``k`` on."""
        nonlocal hidden, links, doubtful, open_p
        for name, drops, doubts, marks_ in reversed(open_[k:]):
            names[name] -= 1
            hidden -= drops
            open_p -= name == "p"
            if doubts:
                piece()
                doubtful = within[doubtful]
            links -= name == "a"
            if marks_:
                flush()
                marks.pop()
        del open_[k:], blocks[k + 1 :]

    def shut(some: frozenset[str], wall: frozenset[str]) -> None:
        """Close the last open element of ``some``, if it lies in no element of ``wall``."""
        if not any(names[x] for x in some):
            return
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] in some:
                close(k)
                return
            if open_[k][0] in wall:
                return

    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            begin = n
        if begin > at and not hidden:
            buffer.append(page[at:begin])
            if links:
                linked += begin - at
        if begin == n:
            break
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            at = n if end < 0 else end + 1
            continue
        tag = _TAG.match(page, begin)
        if not tag:  # a bare "<" is text
            if not hidden:
                buffer.append("<")
            at = begin + 1
            continue
        at = tag.end()
        name = tag[2].lower()
        if name in BLOCK:
            flush()
        if tag[1]:
            for k in range(len(open_) - 1, -1, -1) if names[name] else ():
                if open_[k][0] == name:
                    close(k)
                    break
            continue
        if name in VOID:
            if name == "hr" and open_p:
                shut(_P, _SCOPE)
            continue
        if name in RAW and not (name == "noscript"):
            end = re.compile(f"</{name}\\b", re.I).search(page, at)
            at = n if not end else end.start()
        if name in _ENDS_P and open_p:
            shut(_P, _SCOPE)
        if name in _CLOSES:
            shut(*_CLOSES[name])
        drops, doubts = _dropped(name, tag[3], bool(marks))
        if doubts:
            piece()
            within.append(doubtful)
            holds.append(False)
            firm.append(doubts > 1)
            replies.append(doubts > 2)
            doubtful = len(within) - 1
        mark = name in ("article", "main") and not hidden and not drops and not doubts
        if mark:
            n_marks += 1
            in_article = bool(marks) and marks[-1] > 0
            marks.append(marks[-1] if in_article else n_marks if name == "article" else -n_marks)
            outer = doubtful
            while outer >= 0 and not holds[outer] and not in_article and not replies[outer]:
                holds[outer], outer = True, within[outer]
        open_.append((name, drops, doubts, mark))
        names[name] += 1
        if name in BLOCK:
            elements.append((name, blocks[-1]))
            blocks.append(len(elements) - 1)
        else:
            blocks.append(blocks[-1])
        hidden += drops
        open_p += name == "p"
        links += name == "a"
    flush()
    kept = _judged(weight, doubt, within, holds, firm, any(inside))
    if any(inside) and not any(w and i and k for w, i, k in zip(weight, inside, kept, strict=True)):
        # Nothing is left of the marked elements: the words were misleading, but for advertisements.
        kept = _judged(weight, doubt, within, [h or not f for h, f in zip(holds, firm, strict=True)], firm, True)
    texts: list[str] = []
    sizes: list[int] = []
    places: list[int] = []
    nodes: list[int] = []
    last = -1
    for k in np.flatnonzero(kept):
        if line[k] == last:
            texts[-1] += out[k]
            sizes[-1] += weight[k]
        else:
            texts.append(out[k])
            sizes.append(weight[k])
            places.append(inside[k])
            nodes.append(node[k])
        last = line[k]
    texts = [_SPACE.sub(" ", t).strip() for t in texts]
    return texts, np.array(sizes, dtype=np.int64), np.array(places, dtype=np.int64), nodes, elements


def window_sums(weight: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Sum of the weights of each line and the ``width`` - 1 after it."""
    total = np.concatenate(([0], np.cumsum(weight)))
    first = np.arange(len(weight))
    return total[np.minimum(first + width, len(weight))] - total[first]


def stretches(weight: np.ndarray, width: int = WINDOW, surge: float = SURGE) -> list[tuple[int, int]]:
    """Line ranges between a surge and the next dive."""
    sums = window_sums(weight, width)
    if not len(sums) or not sums.max():
        return []
    high = surge * sums.max()
    found, begin = [], -1
    for k, value in enumerate(sums):
        if begin < 0 and value >= high and weight[k]:
            begin = k
            while begin and weight[begin - 1] and (not found or begin > found[-1][1]):
                begin -= 1  # the slope before the surge: short lines joined to it
        elif begin >= 0 and value == 0:
            found.append((begin, k))
            begin = -1
    if begin >= 0:
        found.append((begin, len(weight)))
    return found


class _Places:
    """First and last line with weight in each element, and in its children of each name."""

    def __init__(self, weight: np.ndarray, node: list[int], elements: list[tuple[str, int]]):
        self.own: dict[int, tuple[int, int]] = {}
        self.under: dict[tuple[int, str], tuple[int, int]] = {}
        for k in np.flatnonzero(weight).tolist():
            name, parent = elements[node[k]]
            self.own[node[k]] = (self.own.get(node[k], (k, k))[0], k)
            self.under[parent, name] = (self.under.get((parent, name), (k, k))[0], k)

    def alike(self, home: int, name: str) -> list[tuple[int, int]]:
        found = [self.own.get(home), *(self.under.get((home, x)) for x in TEXT | {name})]
        return [x for x in found if x]


def _joined(
    a: int, b: int, weight: np.ndarray, node: list[int], elements: list[tuple[str, int]], places: _Places
) -> tuple[int, int]:
    """The stretch from line ``a`` to ``b`` with the lines of its neighbourhood that belong to it."""
    heaviest = a + int(weight[a:b].argmax())
    name, home = elements[node[heaviest]]
    if home < 0 or (name not in TEXT and node[a:b].count(node[heaviest]) > 1):
        home = node[heaviest]  # lines cut by br, or text outside of any element
    while elements[home][0] in LISTS:
        home = elements[home][1]
    page = elements[home][0] in ("", "html", "body")

    def within(k: int, names: frozenset[str] | None = None) -> bool:
        """Whether a line lies in ``home`` (in an element of ``names`` there)."""
        at, found = node[k], names is None
        while at >= 0 and at != home:
            found |= names is not None and elements[at][0] in names
            at = elements[at][1]
        return at == home and found

    alike = places.alike(home, name)
    a, b = min([a, *(x for x, _ in alike)]), max([b, *(y + 1 for _, y in alike)])
    while b < len(weight) and not weight[b] and within(b, ITEMS):
        b += 1
    while not page and a and not weight[a - 1] and within(a - 1, ITEMS):
        a -= 1
    while a:
        near = [
            k
            for k in range(max(0, a - WINDOW), a)
            if elements[node[k]][0] in HEADINGS and (k == a - 1 or within(k))
        ]
        if not near:
            break
        a = near[0]
    return a, b


def _completed(
    blocks: list[str], weight: np.ndarray, mark: np.ndarray, found: list[tuple[int, int]], node: list[int], elements: list[tuple[str, int]]
) -> np.ndarray:
    """Lines of marked elements that the stretches choose; none if no stretch lies in one."""
    kept, bounded = np.zeros(len(blocks), dtype=bool), mark != 0
    articles = bool((mark > 0).any())
    for a, b in found:
        m = mark[a + int(weight[a:b].argmax())]
        if m > 0 or (m < 0 and not articles):
            kept |= mark == m
        elif m < 0:
            kept[a:b] |= bounded[a:b]
    # Further articles without a surge.
    homes = {_parent_of_article(node[k], elements) for k in np.flatnonzero(kept & (mark > 0)).tolist()}
    for m in np.unique(mark[(mark > 0) & ~kept]).tolist():
        mine = np.flatnonzero(mark == m)
        beside = _parent_of_article(node[mine[0]], elements) in homes
        if beside and 2 * int(weight[mine].sum()) > sum(len(blocks[k]) for k in mine):
            kept[mine] = True
    return kept


def _parent_of_article(at: int, elements: list[tuple[str, int]]) -> int:
    """The element around the outermost ``article`` around an element."""
    around = -1
    while at >= 0:
        if elements[at][0] == "article":
            around = elements[at][1]
        at = elements[at][1]
    return around


def main_text(page: str | None) -> str:
    """The article of a page, blocks joined by line ends."""
    blocks, weight, mark, node, elements = lines(page or "")
    found = stretches(weight)
    kept = _completed(blocks, weight, mark, found, node, elements)
    if not kept.any():
        places = _Places(weight, node, elements)
        for a, b in found:
            if not kept[a:b].all():
                a, b = _joined(a, b, weight, node, elements, places)
                kept[a:b] = True
    return "\n".join(blocks[k] for k in np.flatnonzero(kept))


def extract(pages: DataFrame, page_id: str = "page_id", page: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: id, the columns ``keep``, ``text`` and ``n_chars`` (code points)."""
    ship(pages.sparkSession)
    names = [page_id, *keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, page):
            found = [main_text(p) for p in batch.column(page).to_pylist()]
            arrays = [pa.array(found), pa.array([len(t) for t in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *arrays], [*names, "text", "n_chars"]
            )

    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in names)
    return with_columns(pages, *names, page).mapInArrow(run, f"{schema}, text string, n_chars bigint")
