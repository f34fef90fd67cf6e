"""Main text of web pages by the distribution of text over blocks of lines."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Elements that never hold the main text, whose text is no text
# of the page, that stand alone, and that begin a line of their own.
BOILERPLATE = frozenset("nav footer aside form menu dialog button select option textarea label fieldset figcaption".split())
RAW = frozenset("script style noscript template iframe svg math object canvas audio video title".split())
# Of those, what is text of the page within an article or the main element.
TEXT_IN_MAIN = frozenset("dialog button label figcaption math object audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDED_BY_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
# Words in a class, id or role that mark notices, adverts,
# comments and the like.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus"
    " footer gdpr login menu modal nav navbar navigation newsletter notice notices pagination paywall popup promo promotion related"
    " recommended reply replies share sharing sidebar signup social sponsor sponsored subscribe toolbar widget complementary contentinfo".split()
)

# Of those, what makes an article of its own no main text.
ASIDES = frozenset("comment comments disqus reply replies related recommended promo promotion sponsor sponsored".split())

TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*+)>|<!--|<[!?/]")
MARKED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
MAYBE_HIDDEN = re.compile(r"hidden|display", re.I)
ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
NOT_DISPLAYED = re.compile(r"display\s*:\s*none", re.I)
SPACE = re.compile(r"\s+")


def _hidden(attributes: str) -> bool:
    if not MAYBE_HIDDEN.search(attributes):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            return True
        if name == "style" and NOT_DISPLAYED.search(value):
            return True
    return False


def _boilerplate(tag: str, attributes: str, in_main: bool) -> int:
    """0: may hold main text, 1: not unless an article begins in it, 2: not at all."""
    if (tag in BOILERPLATE and not (in_main and tag in TEXT_IN_MAIN)) or (tag == "header" and not in_main):
        return 1
    if not attributes or tag in ("html", "body", "main"):
        return 0
    words = {word for value in MARKED.findall(attributes) for word in re.split(r"[^a-z]+", "".join(value).lower())}
    if not ASIDES.isdisjoint(words):
        return 2
    if tag == "article":
        return 0
    return int(not MARKS.isdisjoint(words) or _hidden(attributes))


def page_lines(page: str) -> list[tuple[str, int, bool, int, int]]:
    """The page's lines without markup: (text, characters in links, boilerplate, region, place).

    A line is the text of one block. Its place is 2 in an article, 1 in the main
    element, else 0. Regions change where boilerplate and such elements begin or
    end. Unclosed elements end with what holds them,
    a paragraph or list item also with the next block; an article in unclosed
    boilerplate ends that.
    """
    lines: list[tuple[str, int, bool, int, int]] = []
    stack: list[tuple[str, int]] = []
    parts: list[str] = []
    linked, region, at, end = 0, 0, 0, len(page)

    def flush() -> None:
        nonlocal linked
        text = SPACE.sub(" ", "".join(parts)).strip()
        if text:
            around = {t for t, _ in stack}
            place = 2 if "article" in around else int("main" in around)
            lines.append((text, linked, any(bad for _, bad in stack), region, place))
        parts.clear()
        linked = 0

    def close(tag: str) -> None:
        nonlocal region
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                if any(bad or t in MAIN for t, bad in stack[i:]):
                    region += 1
                del stack[i:]
                return

    while at < end:
        found = TAG.search(page, at)
        stop = found.start() if found else end
        if stop > at:
            if not found and (cut := page.rfind("<", at)) >= 0 and re.match(r"<[/!]?[A-Za-z!-]", page[cut : cut + 3]):
                stop = cut  # a tag the page breaks off in
            text = html.unescape(page[at:stop])
            parts.append(text)
            if any(t == "a" for t, _ in stack):
                linked += len(text)
        if not found:
            break
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            close_at = page.find("-->" if found[0] == "<!--" else ">", at)
            at = end if close_at < 0 else close_at + (3 if found[0] == "<!--" else 1)
            continue
        closing, attributes = found[1] or found[4] or "", found[3] or found[6] or ""
        if tag in RAW and not (tag in TEXT_IN_MAIN and any(t in MAIN for t, _ in stack)):
            if not closing and not attributes.endswith("/"):
                over = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = over.end() if over else (end if tag in ("script", "style") else at)
            continue
        if tag == "br":
            parts.append("\n")
            continue
        if tag in VOID and tag != "hr":
            continue
        if tag not in BLOCKS:
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        if stack[i][1]:
                            flush()
                        del stack[i]
                        break
                    if stack[i][0] in BLOCKS:
                        break
            else:
                bad = _boilerplate(tag, attributes, any(t in MAIN for t, _ in stack))
                if bad:
                    flush()
                stack.append((tag, bad))
            continue
        flush()
        if closing:
            close(tag)
            continue
        holder = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCKS), -1)
        if holder >= 0 and not any(bad for _, bad in stack[holder + 1 :]):
            if stack[holder][0] in ENDED_BY_BLOCKS or stack[holder][0] == tag == "li":
                close(stack[holder][0])
        if tag in MAIN and any(bad == 1 for _, bad in stack):
            stack = [(t, bad if bad == 2 else 0) for t, bad in stack]
        if tag == "hr":
            continue
        bad = _boilerplate(tag, attributes, any(t in MAIN for t, _ in stack))
        if bad or tag in MAIN:
            region += 1
        stack.append((tag, bad))
    flush()
    return lines


def main_text(page: str, width: int = 3, surge: int = 60) -> str:
    """The text between surge and dive points of a page's line blocks, blocks joined by two newlines.

    Each line weighs as much as its text, outside links where the page marks no
    place; boilerplate weighs nothing, and so do lines outside the article, or
    else the main element, where the page marks one.
    Block i is the sum over `width` lines from i on, regions being `width`
    empty lines apart. A block of at least `surge` characters (of any where the
    place is marked, between regions with a surge, or if no block on the page
    reaches it) is a surge; the text from there to the first empty block, the dive, is kept, lines of links
    included.
    """
    lines = page_lines(page)
    marked = max((place for _, _, bad, _, place in lines if not bad), default=0)
    spread: list[int] = []  # the line on each place, -1 where there is none
    regions: list[int] = []
    last = None
    for i, (_, _, bad, region, place) in enumerate(lines):
        if region != last:
            spread.extend([-1] * width)
        spread.append(-1 if bad or place < marked else i)
        regions.extend([region] * (len(spread) - len(regions)))
        last = region
    weight = np.array([max(0, len(lines[i][0]) - (0 if marked else lines[i][1])) if i >= 0 else 0 for i in spread] + [0] * width, np.int64)
    total = np.concatenate(([0], np.cumsum(weight)))
    blocks = total[width:] - total[:-width]
    least = 1 if marked or blocks.size == 0 else max(1, min(surge, int(blocks.max())))
    surges = [regions[at] for at in np.flatnonzero(blocks[: len(spread)] >= least)]
    kept, inside = [], False
    for at, block in enumerate(blocks[: len(spread)]):
        if not inside and (block >= least or (block > 0 and surges and surges[0] < regions[at] < surges[-1])):
            inside = True
        elif inside and block == 0:
            inside = False
        if inside and spread[at] >= 0:
            kept.append(lines[spread[at]][0])
    return "\n\n".join(kept)


def extract_text(pages: DataFrame, *, html_col: str = "html", width: int = 3, surge: int = 60) -> DataFrame:
    """pages with text and n_chars (code points) in place of the html.

    A page without html (null, empty, markup only) has the empty text. Each row
    is read by itself, repeated rows too; other columns pass through, but for
    ones named text or n_chars, which are replaced. No shuffle.
    """

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda page: main_text(page or "", width, surge)).astype(object)

    rest = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    return pages.select(*[F.col(f"`{c}`") for c in rest], texts(F.col(html_col)).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
