"""HTML extraction by line-block distribution."""
from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their part in a page.
UNREAD = "script style noscript template svg annotation annotation-xml iframe canvas audio video head title textarea select".split()
BOILERPLATE = "nav footer aside form menu dialog button".split()
BLOCKS = (
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
HINTS = (
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disclaimer disqus "
    "footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted "
    "related replies respond share sharing sidebar sidenav skip social sponsor sponsored subscribe toolbar topbar widget widgets"
).split()
READERS = "comment comments commentlist disqus replies respond".split()  # hints at what readers wrote; an article in there is one of theirs
BEFORE, AFTER = "has no with without".split(), "open closed enabled disabled free".split()  # say something of a page about a hint in their compound
ROLES = "navigation banner contentinfo complementary search form menu menubar dialog alertdialog".split()
# Elements whose end may be left out, by kind; the kinds a start closes, and the elements around which hide a kind from it.
ENDLESS = {"p": 0, "li": 1, "dt": 2, "dd": 2, "td": 3, "th": 3, "tr": 4, "thead": 5, "tbody": 5, "tfoot": 5, "option": 6}
CLOSED_BY = {n: (0,) for n in BLOCKS if n not in "body html td th tr thead tbody tfoot option".split()} | {
    "li": (0, 1), "dt": (0, 2), "dd": (0, 2), "td": (3,), "th": (3,), "tr": (3, 4), "thead": (3, 4, 5), "tbody": (3, 4, 5), "tfoot": (3, 4, 5), "option": (6,),
}
HIDES = {n: (1, 2) for n in BLOCKS if n not in "address div p li dt dd option".split()} | {
    "li": (2,), "dd": (1,), "dt": (1,), "table": (0, 1, 2, 3, 4, 5), "td": (0, 1, 2), "th": (0, 1, 2), "button": (0, 1, 2),
}
WINDOW = 3  # lines whose lengths are summed
SURGE = 80  # characters in a window that start a text block on pages that do not mark their article; the largest window's, where that has fewer
LINK_PART = 0.5  # a line with more of its characters in links counts as empty

TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
TOKENS = re.compile(r"[a-z]+|[A-Z][a-z]*")
SPACES = re.compile(r"\s+")
_unread, _boilerplate, _blocks, _void, _hints, _readers, _roles, _before, _after = map(
    frozenset, (UNREAD, BOILERPLATE, BLOCKS, VOID, HINTS, READERS, ROLES, BEFORE, AFTER)
)


PART, HINT, COMMENT = 1, 2, 3  # an element that is boilerplate by itself, one whose class or id hints at it, and one where that hints at readers


def _hints_at(compound: str) -> int:
    tokens = [t.lower() for t in TOKENS.findall(compound)]
    found = [t for i, t in enumerate(tokens) if t in _hints and not (set(tokens[:i]) & _before or set(tokens[i + 1 :]) & _after)]
    return COMMENT if not _readers.isdisjoint(found) else HINT if found else 0


def _boilerplate_kind(name: str, attributes: str, in_article: bool) -> int:
    if name in _boilerplate or name == "header" and not in_article:
        return PART
    if not attributes or name in ("html", "body", "main"):
        return 0
    hinted = 0
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if name == "article" and key not in ("class", "id"):
            continue
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return PART
        if key == "role" and value.lower() in _roles:
            return PART
        if key in ("class", "id"):
            hinted = max([hinted, *map(_hints_at, value.split())])
    return hinted if name != "article" or hinted == COMMENT else 0


def lines_of(page: str) -> list[tuple[str, int, int, bool, bool, bool]]:
    """Lines of a page without markup: text, characters of it in links, whether inside an article (1) or the main element (2), whether boilerplate, whether
    inside any element, whether inside one whose class or id hints at boilerplate and that holds no article.

    A block element starts a line and its end ends it; other elements leave no trace. Elements whose end may be left out close
    where HTML says so, others left open with the element around them, however many are open; an unread element without an end runs to the end of the page.
    A class or id that hints at boilerplate does not count where the element holds the main element, articles while no article lies
    outside such elements, or most of the page's text that is not in links and four times what no such element holds. It counts
    around an article or main element that lies outside such elements. An article that its own class or id, or an element around it, hands to readers is
    a comment of theirs and marks nothing.
    """
    lines: list[tuple[str, int, int, bool, int, bool]] = []  # and the innermost hinted element around it
    # per hinted element, from 1: the hinted one around it, the mark it holds, whether it lies in a mark
    around, holds, within, hint = [0], [""], [False], 0
    free: set[str] = set()  # marks outside hinted elements
    parts: list[str] = []
    links = 0
    # element, how it turns boilerplate on, whether it is the article, and per kind of ENDLESS where the one lies that may end here, or -1
    open_: list[tuple[str, int, bool, tuple[int, ...]]] = []
    number: dict[str, int] = {}  # of open elements by name
    none = (-1,) * (1 + max(ENDLESS.values()))
    skip = article = mains = link = comment = 0

    def close_line() -> None:
        nonlocal links
        if parts:
            text = SPACES.sub(" ", html_lib.unescape("".join(parts))).strip()
            if text:
                lines.append((text, min(links, len(text)), 2 if mains else int(article > 0), skip > 0, hint, bool(open_)))
            parts.clear()
        links = 0

    def pop() -> str:
        nonlocal skip, article, mains, link, hint, comment
        last, off, main, _ = open_[-1]
        if off or main:
            close_line()
        open_.pop()
        number[last] -= 1
        mains -= main and last == "main"
        skip, article, link = skip - (off == PART), article - main, link - (last == "a")
        hint, comment = around[hint] if off >= HINT else hint, comment - (off == COMMENT)
        return last

    def push(name: str, off: int, main: bool) -> None:
        nonlocal skip, article, mains, link, hint, comment
        near = open_[-1][3] if open_ else none
        if name in HIDES or name in ENDLESS:
            hidden, own = HIDES.get(name, ()), ENDLESS.get(name, -1)
            near = tuple(len(open_) if k == own else -1 if k in hidden else i for k, i in enumerate(near))
        open_.append((name, off, main, near))
        number[name] = number.get(name, 0) + 1
        skip, article, link = skip + (off == PART), article + main, link + (name == "a")
        comment += off == COMMENT
        mains += main and name == "main"
        if off >= HINT:
            around.append(hint)
            holds.append("")
            within.append(article > 0)
            hint = len(around) - 1
        if main:
            if not hint:
                free.add(name)
            up = hint
            while up and holds[up] not in ("main", name):
                holds[up], up = name, around[up]

    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            tag = size
        if tag > at:
            parts.append(page[at:tag])
            if link:
                links += tag - at
        if tag == size:
            break
        found = TAG.match(page, tag) or LOOSE.match(page, tag)
        if found is None:  # a sign, not a tag
            parts.append("<")
            at = tag + 1
            continue
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name in _unread:
            if not found[1] and not found[3].endswith("/"):
                end = re.compile(f"</{re.escape(name)}(?:[^>]*>|$)", re.I).search(page, at)
                if name != "head" or end:
                    at = end.end() if end else size
            continue
        block = name in _blocks
        if block:
            close_line()
        elif name == "br":
            parts.append(" ")
        if name in _void:
            continue
        if not found[1]:
            ends = [i for k in CLOSED_BY.get(name, ()) if open_ and (i := open_[-1][3][k]) >= 0]
            popped = [pop() for _ in range(len(open_) - min(ends))] if ends else []
            if "a" in popped and name not in ENDLESS:  # a link around a block goes on in it
                push("a", 0, False)
            starts = block or name in ("span", "a", "ins")
            off = _boilerplate_kind(name, found[3], article > 0) if starts else 0
            main = (name == "main" or name == "article" and not comment) and not off and not skip
            if off and not block:
                close_line()
            push(name, off, main)
        elif number.get(name):
            while pop() != name:
                pass
    close_line()
    own = [0] * len(around)
    for text, linked, _, skipped, h, _ in lines:
        own[h] += 0 if skipped else len(text) - linked
    whole, plain, dropped = list(own), [0] * len(own), [False] * len(own)
    for h in range(len(own) - 1, 0, -1):
        whole[around[h]] += whole[h]
    for h in range(1, len(own)):
        plain[h] = plain[around[h]] + own[around[h]]
        most = 2 * whole[h] > whole[0] and whole[h] > 4 * plain[h]
        spared = (within[h] or not free) and (holds[h] == "main" or holds[h] and "article" not in free or most)
        dropped[h] = dropped[around[h]] or not spared
    return [(text, linked, inside, skipped or dropped[h], boxed, h > 0 and not holds[h]) for text, linked, inside, skipped, h, boxed in lines]


def main_text(page: str | None) -> str:
    """The article of a page, one block a line.

    Lines of menus, adverts and the like go with the markup. Lines outside the article of a page that marks it, and lines
    of links on other pages, are blanked. A page marks its article by a main element, or by article elements that have at least as much text,
    links left out, as what lies outside, so that a teaser is not taken for the article.
    The lengths of the lines left are summed over sliding windows. A text block surges where the sum rises
    from nothing past a bound (any text where the article is marked, else ``SURGE`` characters or what the page's largest window inside an element has) and
    dives where it is nothing again; all text between is kept, short paragraphs included.
    """
    lines = lines_of(page or "")
    inner = sum(len(t) - n for t, n, a, s, *_ in lines if a and not s)
    outer = sum(len(t) - n for t, n, a, s, _, hinted in lines if not (a or s or hinted) and n <= LINK_PART * len(t))
    marked = any(a == 2 and not s for _, _, a, s, *_ in lines) or any(a and not s for _, _, a, s, *_ in lines) and inner >= outer
    sizes: list[int] = []
    owner: list[int] = []
    gap = False
    for i, (text, linked, inside, skipped, *_) in enumerate(lines):
        if skipped:
            continue
        if marked and not inside or not marked and linked > LINK_PART * len(text):
            gap = True
            continue
        if gap and sizes:  # what was blanked stands between as empty lines
            sizes += [0] * WINDOW
            owner += [-1] * WINDOW
        gap = False
        sizes.append(len(text))
        owner.append(i)
    boxed = [size if at >= 0 and lines[at][4] else 0 for size, at in zip(sizes, owner, strict=True)]
    largest = max((sum(boxed[max(0, i + 1 - WINDOW) : i + 1]) for i in range(len(boxed))), default=0)
    least = 1 if marked else min(SURGE, largest) or SURGE
    kept: list[str] = []
    start, most, total = None, 0, 0
    for at in range(len(sizes) + WINDOW):
        total += sizes[at] if at < len(sizes) else 0
        total -= sizes[at - WINDOW] if at >= WINDOW else 0
        if total and start is None:
            start, most = at, 0
        if start is not None:
            most = max(most, total)
            if not total:
                if most >= least:
                    kept += [lines[owner[k]][0] for k in range(start, min(at, len(sizes))) if owner[k] >= 0]
                start = None
    return "\n".join(kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row. A null or empty page, or one without an article, has an empty text. Pages are
    independent: nothing is shuffled or cut, repeated rows and null ids stay, very long pages are whole; no rows give none. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = [main_text(p) for p in batch.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint")
