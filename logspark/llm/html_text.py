"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names and words in class, id or role that mark what is not the article.
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head script style noscript template iframe object svg math canvas audio video select textarea button datalist title".split()
)
FRAME = frozenset("nav header footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
CLOSED_BY_NEXT = frozenset("p li dt dd td th tr option".split())
FRAME_WORDS = frozenset(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus disclaimer "
    "footer form header login masthead menu menubar modal nav navbar navigation newsletter notice notification pagination popup "
    "promo promoted promotion recommended related reply replies respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe tags teaser toolbar topbar widget".split()
)
FRAME_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
MAIN_WORDS = frozenset("article content entry post story".split())
# Words that say where or what form an element has, but not what it is about.
FORM_WORDS = frozenset(
    "area bar block body bottom box button buttons card column container content group header heading inline inner item items left "
    "line link links list main outer page panel post right row section site slot thread title top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Frequent function words of the languages that the pages are written in.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his i in is it its no not of on or our she so than that the their "
    "them then there they this to was we were what when which who will with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour qu que qui "
    "sa se ses son sur un une vous "
    "aber als am auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach nicht "
    "noch nur oder sich sie sind so und vom von war wie wir zu zum zur über "
    "al como con del el ella en es esta este fue ha la las lo los más me mi muy no para pero por que se si sin sobre su sus "
    "un una y ya".split()
)

LONG_WORDS = 25
SHORT_WORDS = 8
STOP_DENSITY = 0.15
LINK_DENSITY = 0.5

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|(?P<text>[^<]+|<(?![a-zA-Z/!?]))",
    re.S,
)
# a tag whose quotes never close ends at the next bracket
_LOOSE = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z]*)(?P<attrs>[^>]*)>?(?P<text>)(?P<cdata>)")
_RAW = re.compile(r"script|style|textarea|title|iframe|noscript|noframes|xmp")
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_NAMES = re.compile(r"[a-z]+")


def names_frame(value: str) -> bool:
    """Whether one name of a class or id says frame and nothing else: ``comment-list``, but not ``related-work``.

    Inside the article a word alone is no sign, as sections are named after what they are about.
    """
    for name in value.split():
        words = set(_NAMES.findall(name))
        if words and not words.isdisjoint(FRAME_WORDS) and words <= FRAME_WORDS | FORM_WORDS:
            return True
    return False


GOOD, BAD, OPEN = 1, -1, 0


def place_of(tag: str, attrs: str, inside: int) -> int:
    """BAD: frame of the page; GOOD: the article; else what it stands in."""
    if inside == BAD or tag in HIDDEN:
        return BAD
    if tag in FRAME and not (tag == "header" and inside == GOOD):
        return BAD
    here = GOOD if tag in MAIN else inside
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return BAD
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return BAD
        if name == "role" and value in FRAME_ROLES:
            return BAD
        words = set(_NAMES.findall(value)) if name in ("class", "id") and tag not in ("html", "body") and tag not in MAIN else ()
        if inside == GOOD:
            # a heading may be called what it likes; so may the article's own header
            if words and tag not in HEADINGS and "header" not in words and names_frame(value):
                return BAD
        elif words and not words.isdisjoint(FRAME_WORDS):
            return BAD
        if name == "role" and value in ("main", "article") or words and not words.isdisjoint(MAIN_WORDS):
            here = GOOD
    return here


def blocks_of(page: str) -> list[tuple[str, int, float, bool]]:
    """(text, place, share of characters in links, heading) of each block with text, in page order."""
    out: list[tuple[str, int, float, bool]] = []
    stack: list[tuple[str, int]] = []
    parts: list[str] = []
    linked, links, heading = 0, 0, False

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, stack[-1][1] if stack else OPEN, min(1.0, linked / len(text)), heading))
        parts.clear()
        linked = 0

    pos, end = 0, len(page)
    while pos < end:
        found = _TOKEN.match(page, pos) or _LOOSE.match(page, pos)
        pos = found.end()
        text = found["text"] or found["cdata"]
        if text:
            if not (stack and stack[-1][1] == BAD):
                text = html.unescape(text) if found["text"] else text
                parts.append(text)
                if links:
                    linked += len(" ".join(text.split()))
            continue
        if not found["tag"]:
            continue
        tag = found["tag"].lower()
        if tag in BLOCKS:
            close()
        if found["end"]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in HEADINGS:
                heading = False
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close()
                    del stack[i:]
                    break
                if stack[i][0] in MAIN and tag not in ("body", "html"):
                    break  # a stray end tag does not end the article
            continue
        if tag == "a":
            links = 1
        if tag in VOID:
            if tag == "input":
                parts.append(" ")
            continue
        if tag in BLOCKS:
            links = 0
            while stack and (stack[-1][0] == tag and tag in CLOSED_BY_NEXT or stack[-1][0] == "p"):
                stack.pop()
            heading = tag in HEADINGS
            if stack and stack[-1][0] == "head" and tag not in ("title", "head"):
                stack.pop()
        inside = stack[-1][1] if stack else OPEN
        place = place_of(tag, found["attrs"], inside)
        if _RAW.fullmatch(tag) and not found["attrs"].rstrip().endswith("/"):
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, pos)
            pos = stop.end() if stop else end
            continue
        if tag in BLOCKS or place == BAD and inside != BAD:
            if tag not in BLOCKS and parts:
                close()
            stack.append((tag, place))
    close()
    return out


def main_text(page: str) -> str:
    """Blocks that the rules keep, joined by one space.

    First pass: blocks of the page's frame and of mostly links are bad; blocks of the article, and long ones with
    enough stop words, are good; long ones with few are bad; short ones stay open. Second pass: an open block takes
    the label of the nearest decided block, a heading that of the next; between labels at equal distance it is bad.
    If nothing is good, long blocks outside the frame count as good whatever their words.
    """
    blocks = blocks_of(page)
    labels = []
    for text, place, density, _ in blocks:
        words = text.lower().split()
        if place == BAD or density > LINK_DENSITY and not (place == GOOD and len(words) >= LONG_WORDS):
            labels.append(BAD)
        elif place == GOOD:
            labels.append(GOOD)
        elif len(words) < SHORT_WORDS:
            labels.append(OPEN)
        else:
            stops = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
            enough = stops >= STOP_DENSITY
            labels.append((GOOD if enough else BAD) if len(words) >= LONG_WORDS else GOOD if stops >= 2 * STOP_DENSITY else OPEN)
    if GOOD not in labels:
        labels = [
            GOOD if at != BAD and dense <= LINK_DENSITY and len(text.split()) >= SHORT_WORDS else label
            for label, (text, at, dense, _) in zip(labels, blocks)
        ]
    n, far = len(labels), len(labels) + 1
    before, after = [(far, BAD)] * n, [(far, BAD)] * n
    for out, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        near = (far, BAD)
        for i in order:
            near = (0, labels[i]) if labels[i] else (near[0] + 1, near[1])
            out[i] = near
    kept = []
    for i, (text, _, _, heading) in enumerate(blocks):
        label = labels[i]
        if not label:
            (x, a), (y, b) = before[i], after[i]
            label = b if heading and y <= n else a if x < y else b if y < x else min(a, b)
        if label == GOOD:
            kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): one row per page, rows that repeat included.

    Null or empty html, and pages without an article, give the empty text. Other columns are not read.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(x) if x else "" for x in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    picked = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = dict(picked.dtypes)
    texts = picked.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
