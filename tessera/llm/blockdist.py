"""HTML main text by line-block distribution.

1. Markup is stripped to lines: one a text block (block-level tags end a line).
   Text inside scripts, styles, forms, navigation, headers, footers, sidebars and
   elements whose class or id names an advert, a notice, comments and the like
   is left out, and so are lines without text. If the page declares its article
   (article or main element), only its lines count.
2. The distribution over these lines is the sum of their text outside links in
   each window of ``WINDOW`` lines. It dives where the sum is under ``LINK_SHARE`` of
   all characters in the window and most of its lines are links: a list of links.
   Lines there that are mostly links, the page's title (h1) apart, end a run and are
   no content.
3. In a declared article the text surges in a run of ``LEAST`` characters or more, and
   content goes from the first such run to the last one. On other pages the lengths of
   the lines alone find it: the sum over the window of ``WINDOW`` lines around each line,
   within its run and of lines that like it are or are not loose in the body, surges where it first reaches ``LEAST`` and dives for good after it
   last does; lines in one box (an element other than the body) with a line of
   ``LEAST`` characters are as high as that. Every line between, whatever its length, is
   content, and so are those from the title on if that is before; if nothing surges, all lines are.
   Outside a declared article, single lines that are mostly links are left out
   too. A declared article of nothing but links is kept as it is.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare_python, text_slices

WINDOW = 3
LEAST = 80
LINK_SHARE = 0.5
# fixed values: html's element kinds
RAW = frozenset("script style textarea title noscript template iframe noframes noembed xmp svg math object canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("nav header footer aside form button select option datalist dialog menu fieldset head "
                    "audio video picture map".split())
HINTS = frozenset("ad ads adv advert adverts advertisement advertisements advertising banner banners sponsor sponsored "
                  "promo promos promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay "
                  "newsletter subscribe subscription signup sidebar sidebars side aside nav navbar navigation menu menus "
                  "breadcrumb breadcrumbs footer header masthead comment comments commentlist disqus replies respond "
                  "share sharing social related recommended widget widgets pagination pager toolbar login search".split())
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
# a class such as no-sidebar, has-comments or menu-open says how a page looks, not what an element is
STATES = frozenset("no not has have with without is hide hides hidden show shows open opened closed collapsed expanded "
                   "visible enabled disabled on off".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
OTHER = r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)"
TOKEN = re.compile(OTHER + r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
#: Once a quote is left open, tags end at the next sign: else every tag would look for its quote to the page's end.
PLAIN_TOKEN = re.compile(OTHER + r"([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[a-z]+")
BLANK = re.compile(r"\s+")


def hints_of(value: str) -> set[str]:
    """Words in a class or id that name boilerplate; classes that hold a word for a state count for nothing."""
    out: set[str] = set()
    for token in value.split():
        words = NAME.findall(token)
        if not STATES.intersection(words):
            out |= HINTS.intersection(words)
    return out


def is_boilerplate(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id"):
            hints = hints_of(value)
            if hints & COMMENTS or hints and tag != "article":
                return True
        elif name == "role" and value in ROLES or name in ("hidden",) or name == "aria-hidden" and value == "true":
            return True
    return False


def lines_of(page: str) -> list[tuple[str, int, bool, bool, int]]:
    """``(text, linked characters, in an article, is an h1, box)`` per line; blank lines have an empty text.
    The box is the element around the line's own one (0: the page itself)."""
    out: list[tuple[str, int, bool, bool, int]] = []
    piece: list[str] = []
    linked = 0
    # open blocks: name, dropped and in an article before it, the inline elements open in it, number, box
    blocks: list[tuple[str, bool, bool, list[tuple[str, bool, bool]], Counter, int, int]] = [
        ("", False, False, [], Counter(), 0, 0)]
    opened = 0
    names: Counter = Counter()  # of open blocks
    dropped = article = title = False
    anchors = breaks = 0
    seen = False  # an article or main element

    def end_line():
        nonlocal linked
        text = BLANK.sub(" ", entities.unescape("".join(piece))).strip()
        out.append((text, min(linked, len(text)), article, title, blocks[-1][6]))
        piece.clear()
        linked = 0

    def text(raw: str):
        nonlocal linked
        if not raw:
            return
        if dropped:
            return
        piece.append(raw)
        if anchors:
            linked += len(entities.unescape(raw).strip())

    at, n, last = 0, len(page), page.rfind(">")
    token, past = TOKEN, {}
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        m = token.match(page, lt) if lt < last or page.startswith(("<!", "<?"), lt) else None
        if m is None and token is TOKEN and page[lt + 1:lt + 3].strip("/")[:1].isalpha() and lt < last:
            token = PLAIN_TOKEN
            m = token.match(page, lt)
        if m is None:
            text("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in RAW and not closing:
            if not m[3].rstrip().endswith("/"):
                end = past.get(tag, at)  # no end tag before it
                if end <= at:
                    stop = re.compile(rf"</{re.escape(tag)}\b", re.I).search(page, at)
                    end = past[tag] = stop.end() if stop else n
                close = page.find(">", end)
                at = close + 1 if close >= 0 else n
            if tag not in INLINE:
                end_line()
            continue
        if tag == "br":
            # one is white space, two end a block
            if breaks and not page[breaks:lt].strip():
                end_line()
            piece.append(" ")
            breaks = at
            continue
        if tag == "a":
            anchors = 0 if closing else 1
        if tag not in INLINE:
            end_line()
            title = tag == "h1" and not closing
        if tag in VOID or tag in RAW:
            continue
        if not closing:
            if m[3].rstrip().endswith("/"):
                continue
            if tag in INLINE:
                blocks[-1][3].append((tag, dropped, article))
                blocks[-1][4][tag] += 1
            else:
                opened += 1
                # an open paragraph holds no other block, and the body is the page itself
                box = blocks[-1][6] if blocks[-1][0] == "p" else blocks[-1][5]
                blocks.append((tag, dropped, article, [], Counter(), 0 if tag in ("html", "body") else opened, box))
                names[tag] += 1
            own = tag in ("article", "main")
            if is_boilerplate(tag, m[3]):
                dropped = True
            elif own and not seen:
                # the page's first article counts even inside an element with a misleading class
                dropped = any(names[t] for t in DROPPED)
            seen = seen or own and not dropped
            article = article or own and not dropped
        elif tag in INLINE:
            inline, open_names = blocks[-1][3:5]
            while open_names[tag]:  # an inline end does not close blocks around it
                name, dropped, article = inline.pop()
                open_names[name] -= 1
                if name == tag:
                    break
        elif names[tag] and (tag != "p" or blocks[-1][0] == "p"):  # nor does a paragraph's
            while True:
                name, dropped, article = blocks.pop()[:3]
                names[name] -= 1
                if name == tag:
                    break
    end_line()
    return out


def dives(chars: np.ndarray, plain: np.ndarray, links: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which lines lie in a window, mostly of links, where the sum of ``plain`` is under its share of that of ``chars``."""
    n = len(chars) - window + 1
    out = np.zeros(len(chars), bool)
    if n > 0:
        total, text, linked = (np.convolve(x, np.ones(window, np.int64), "valid") for x in (chars, plain, links))
        low = (text < (1 - LINK_SHARE) * total) & (2 * linked > window)
        for k in range(window):
            out[k:k + n] |= low
    return out


def around(chars: np.ndarray, run: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The sum of ``chars`` over the ``window`` lines around each line, of those with its ``run``."""
    out = chars.copy()
    for k in range(1, window // 2 + 1):
        near = run[k:] == run[:-k]
        out[k:] += np.where(near, chars[:-k], 0)
        out[:-k] += np.where(near, chars[k:], 0)
    return out


def content(chars: np.ndarray, linked: np.ndarray, title: np.ndarray, box: np.ndarray, declared: bool) -> np.ndarray:
    """Which lines, all with text, lie between surge and dive and are no links."""
    links = linked > LINK_SHARE * chars
    cut = links & dives(chars, chars - linked, links) & ~title
    keep = ~(cut if declared else links)
    if declared and not keep.any():
        return ~keep
    run = np.cumsum(cut)
    if declared:
        at = run
        surges = np.flatnonzero(np.bincount(run, np.where(keep, chars, 0)) >= LEAST)
    else:
        at = np.arange(len(chars))
        plain = np.where(keep, chars - linked, 0)
        high = around(plain, 2 * run + (box > 0)) >= LEAST
        high |= (box > 0) & np.isin(box, box[plain >= LEAST])
        surges = np.flatnonzero(high)
    if len(surges):
        keep &= (at >= min(surges[0], at[title & keep].min(initial=surges[0]))) & (at <= surges[-1])
    return keep


def main_text(page: str | None) -> str:
    """The blocks of the article, joined by blank lines; empty if there is none."""
    lines = [line for line in lines_of(page) if line[0]] if page else []
    declared = any(line[2] for line in lines)
    lines = [line for line in lines if line[2] or not declared]
    if not lines:
        return ""
    texts, linked, _, title, box = zip(*lines)
    keep = content(np.array([len(t) for t in texts], np.int64), np.array(linked, np.int64), np.array(title), np.array(box), declared)
    return "\n\n".join(t for t, k in zip(texts, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages``. Null and
    empty html, and pages without text, have an empty text; repeated rows stay."""
    prepare_python(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in text_slices(batches, "html"):
            texts = [main_text(h) for h in s.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [s.column("page_id"), s.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html")) \
        .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
