"""The main text of web pages by the distribution of text over lines.

Markup is stripped into lines: every block tag begins a new one, and the edges of
sections leave as many empty lines as a window is long.  The characters outside
links are summed over windows of neighbouring lines.  Where the sum rises above
the surge threshold a region begins (back to the first line of the window that
has text), where it falls to nothing the region ends, and the text between is
kept.  Elements that say what they are (menus, page headers, footers, sidebars,
adverts, notices, forms, reader comments) are stripped with the markup; where a
page marks its article, lines outside it count as empty.

Nulls and edge cases: a null or empty page has an empty text.  Elements that are
never closed end with the page, but a menu or other stripped element that is
never closed takes nothing with it.  A page whose windows all stay under the
threshold keeps its largest region, so short articles aren't lost.  Character
references are decoded after markup is stripped, those that are no references
stay as they are.  Repeated rows and null ids are rows like others; extra columns
are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Lines of a window.
WINDOW = 3
#: Characters of a window at which a region begins.
SURGE = 80

#: Pages worked on at a time.
ROWS = 64

#: Fixed names of HTML.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "head", "title", "canvas", "audio", "video", "select", "textarea", "button"}
STRIPPED = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
ARTICLE = {"article", "main"}
SECTIONS = {"section", "header", "body", "html", "hr", *ARTICLE, *STRIPPED}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose end may be left out: they end where the next block begins.
OPEN_ENDED = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
#: Words of a class, id or role that say what an element is.
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle alert announcement banner breadcrumb breadcrumbs byline captcha comment comments commentlist complementary consent contentinfo"
    " cookie cookies copyright dialog discussion disqus donate footer gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice notification outbrain overlay"
    " pager pagination paywall popup print privacy promo promoted promotion recommended recommendations register related replies respond rss search share sharing sidebar signup skip social"
    " sponsor sponsored subscribe subscription taboola tags toolbar topbar tracking trending widget widgets".split()
)
CONTENT = frozenset("article content entry post story".split())
#: Words before a name that only say that something has it.
HAVING = {"with", "has", "no", "without", "not", "is"}
NAME_LIKE = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
QUOTED = re.compile(r"""=\s*(?:"[^"]*"|'[^']*')""")
UNSEEN = re.compile(r"""(?i)aria-hidden\s*=\s*["']?true|display\s*:\s*none""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: A comment, a declaration, or a tag with its name and attributes (quoted values may hold '>').
MARKUP = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)(?:>|$)""", re.S)


class Tag(NamedTuple):
    start: int
    stop: int
    closing: bool
    name: str
    attributes: str


def tags_of(page: str) -> list[Tag]:
    """Tags in order; comments, and elements whose content isn't text, are one tag without a name."""
    out, at, unclosed = [], 0, set()
    while found := MARKUP.search(page, at):
        at, name = found.end(), (found[2] or "").lower()
        if name in RAW and not found[1] and not (found[3] or "").endswith("/") and name not in unclosed:
            close = re.compile(rf"(?i)</{name}\b[^>]*>?").search(page, at)
            if close or name in ("script", "style"):
                at, name = close.end() if close else len(page), ""
            else:
                unclosed.add(name)
        out.append(Tag(found.start(), at, bool(found[1]), name, found[3] or ""))
    return out


def ends_of(tags: list[Tag]) -> dict[int, int]:
    """For each opening tag the number of the tag that closes it; those that nothing closes are absent."""
    ends, waiting = {}, {}
    for n, t in enumerate(tags):
        if not t.name or t.name in VOID or t.name in OPEN_ENDED:
            continue
        if not t.closing:
            waiting.setdefault(t.name, []).append(n)
        elif waiting.get(t.name):
            ends[waiting[t.name].pop()] = n
    return ends


def names_of(attributes: str) -> list[list[str]]:
    """The words of each class, id and role of an element, in small letters."""
    values = NAME_LIKE.findall(attributes) if "=" in attributes else []
    return [[w.lower() for w in WORDS.findall(name)] for v in values for name in v.strip("\"'").split()]


def is_noise(t: Tag, inside: bool) -> bool:
    """Is an element stripped with all it holds?  A header inside an article is the article's own."""
    if t.name in STRIPPED or (t.name == "header" and not inside):
        return True
    if not t.attributes or t.name in ("html", "body") or re.fullmatch("h[1-6]", t.name):
        return False
    if UNSEEN.search(t.attributes) or ("hidden" in t.attributes.lower() and re.search(r"(?i)\bhidden\b", QUOTED.sub("", t.attributes))):
        return True
    for words in names_of(t.attributes):
        found = NOISE.intersection(words) - ({"header"} if inside or CONTENT.intersection(words) else set())
        if found and words[0] not in HAVING:
            return True
    return False


def article_level(t: Tag) -> int:
    """2 for an element that marks the article, 1 for one that is called so, else 0."""
    if t.name in ARTICLE:
        return 2
    if t.name not in ("div", "section", "td") or not t.attributes:
        return 0
    names = names_of(t.attributes)
    return 2 if ["main"] in names and "role" in t.attributes.lower() else int(any(CONTENT.intersection(words) for words in names))


def lines_of(page: str) -> list[tuple[str, int, int]]:
    """(text, characters of it inside links, level of the article it is in) of every line.

    Outside articles each block tag ends a line, if only an empty one, and sections leave WINDOW empty lines; what is
    stripped leaves none, so that it doesn't end the text around it.
    """
    tags = tags_of(page)
    ends = ends_of(tags)
    lines, text, linked, link = [], [], 0, False
    levels: list[tuple[int, int]] = []  # of the articles around: (number of the closing tag, level)
    at, n = 0, 0

    def put(run: str) -> None:
        nonlocal linked
        if run:
            text.append(run)
            linked += len(run) if link else 0

    def end(gap: int) -> None:
        nonlocal text, linked
        level = levels[-1][1] if levels else 0
        joined = " ".join(html.unescape("".join(text)).split())
        if joined or (gap and not level):
            lines.append((joined, min(linked, len(joined)), level))
        lines.extend([("", 0, 0)] * (gap - 1))
        text, linked = [], 0

    while n < len(tags):
        t = tags[n]
        put(page[at : t.start])
        at, inside = t.stop, bool(levels)
        section = WINDOW if t.name in SECTIONS and not inside else 1
        opens = bool(t.name) and not t.closing and not t.attributes.endswith("/") and t.name not in VOID
        if opens and is_noise(t, inside):
            last = ends.get(n)
            if t.name in OPEN_ENDED:  # up to the next block
                last = next((k for k in range(n + 1, len(tags)) if tags[k].name and tags[k].name not in INLINE and tags[k].name != "br"), None)
            if last is not None:
                if t.name not in INLINE:
                    end(0)
                own = tags[last].closing and tags[last].name == t.name
                at, n = (tags[last].stop, last + 1) if own else (tags[last].start, last)
                while levels and levels[-1][0] < n:
                    levels.pop()
                continue
        if t.name == "a":
            link = not t.closing
        elif t.name == "br":
            put(" ")
        elif t.name and t.name not in INLINE:
            level = article_level(t) if opens else 0
            closes = t.closing and levels and levels[-1][0] == n
            end(WINDOW if (level == 2 or closes) else section)
            link = False
            if closes:
                levels.pop()
            if level:
                levels.append((ends.get(n, len(tags)), max([level, *(v for _, v in levels)])))
        n += 1
    put(page[at:])
    end(1)
    return lines


def regions(lengths: np.ndarray) -> list[tuple[int, int]]:
    """(first line, line after the last) between each surge and the dive after it."""
    if not lengths.any():
        return []
    padded = np.concatenate((np.zeros(WINDOW - 1, dtype=np.int64), lengths, np.zeros(WINDOW, dtype=np.int64)))
    sums = np.convolve(padded, np.ones(WINDOW, dtype=np.int64), "valid")  # sums[i]: the window that ends with line i
    some = np.concatenate(([False], sums > 0))
    edges = np.flatnonzero(some[1:] != some[:-1])
    found = list(zip(edges[::2].tolist(), (edges[1::2] - WINDOW + 1).tolist(), strict=True))
    peaks = [int(sums[lo:hi].max()) for lo, hi in found]
    surge = min(SURGE, max(peaks))
    return [r for r, peak in zip(found, peaks, strict=True) if peak >= surge]


def main_text(page: str | None) -> str:
    """The text of a page's article.  Links count as text only where an article is marked; lines of links inside a region stay."""
    lines = lines_of(page or "")
    marked = max((level for text, linked, level in lines if len(text) > linked), default=0)
    lengths = np.array([(len(text) if marked else len(text) - linked) if level >= marked else 0 for text, linked, level in lines], dtype=np.int64)
    return " ".join(text for lo, hi in regions(lengths) for text, _, level in lines[lo:hi] if text and level >= marked)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = StructType([rows.schema["page_id"], rows.schema["url"], StructField("text", StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                texts = pa.array([main_text(page) for page in part.column(2).to_pylist()], pa.string())
                yield pa.record_batch([part.column(0), part.column(1), texts], names=["page_id", "url", "text"])

    return rows.mapInArrow(run, kind).withColumn("n_chars", F.char_length("text").cast("long"))
