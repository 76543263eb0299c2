"""Main text of web pages by tag-path ratios.

A page is cut into text blocks at block-level tags; each belongs to the
root-to-leaf path of tags (with class and id) above it.  Per path the text
length and punctuation outside links are aggregated over its blocks, smoothed
with the paths that share its container, and fused into one ratio per tag.
A container passes with its best path; lists, tables, quotes and figures belong
to the container around them.  Containers below the threshold and page furniture
(navigation, footers, forms, adverts, comments and the like) are left out; every
other block is returned whole and in page order.  Where the page marks its
article, every block of it that is no furniture is content.
"""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType

from .common import with_value

#: Elements whose content is never text of the page.
SILENT = frozenset("script style title template noscript iframe svg math object audio video canvas select textarea button".split())
#: Of these, the ones whose content is no markup: without an end tag they last to the end of the page (a title to the next tag).
RAW = frozenset("script style title iframe textarea".split())
#: Of these, the ones that do not nest: the next start tag ends an open one.
FLAT = frozenset("noscript select button".split())
#: Elements of page furniture; a form is so unless it wraps the page.
FURNITURE = frozenset("nav footer aside dialog menu".split())
#: Words in class, id or role that name page furniture.
CUES = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus
 footer form header hidden login masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo
 promoted promotion related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar
 widget widgets""".split())
#: Of these, the words that never name a wrapper of the page's own text.
FOREIGN = frozenset("""ad ads advert advertisement adverts comment comments cookie cookies consent disqus newsletter notice notices promoted
 related replies reply respond sponsor sponsored subscribe""".split())
#: Before one of these words in a class name they say that the element goes with the furniture or has none.
BESIDE = frozenset("has have no not with without".split())
#: A form, or an element named for layout furniture, with more than this share of the page's text wraps the page.
WRAPPER = 0.75
CONTENT = frozenset("article main".split())
#: Block elements that are part of the text around them, not containers of their own.
FLOW = frozenset("""blockquote caption center dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr li ol p pre summary
 table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
 form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
#: Start tags that end an open element of the same list before them.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table".split())
PUNCTUATION = re.compile("[.,;:!?。，；：！？、]")
THRESHOLD = 0.3
#: What the ratio of text outside the page's marked article counts.
BESIDE_ARTICLE = 0.1
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^<>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*>|[^<]+|<", re.S)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    path: tuple[str, ...]
    out: bool                                     # in page furniture, whatever the page is like
    cues: tuple[tuple[int, bool, bool], ...]      # elements above that look like furniture: where, foreign words, article or main below it
    text: list = field(default_factory=list)
    linked: int = 0


def cue_words(marks: list[str]) -> set[str]:
    """The words of class, id and role values that name furniture."""
    found = set()
    for token in " ".join(marks).lower().split():
        words = re.split(r"[^a-z0-9]+", token)
        if not BESIDE & set(words):
            found |= CUES & set(words)
    return found


def silent_end(page: str, tag: str, at: int, outer: set[str]) -> int:
    """Where a silent element ends whose content begins at ``at``.

    Without an end tag before its parent's (or, if such elements do not nest,
    before the next of its kind), only what comes before the next block is its.
    """
    if tag in RAW:
        close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
        if close:
            return close.end()
        return (page + "<").index("<", at) if tag == "title" else len(page)
    inner: list[str] = []
    flow = None
    while at < len(page):
        m = _TOKEN.match(page, at)
        token = m.group() if m else "<"
        name = _NAME.match(token)
        if name is None:
            at += len(token)
            continue
        own = name.group(1).lower()
        if flow is None and (own in BLOCK or own in ("body", "html")):
            flow = at
        if token[1] == "/":
            if own in inner:
                del inner[len(inner) - 1 - inner[::-1].index(own):]
            elif own == tag:
                return at + len(token)
            elif own in outer:
                break
        elif own == tag and tag in FLAT:
            break
        elif own not in VOID and not token.endswith("/>"):
            if own in RAW:
                at = silent_end(page, own, at + len(token), outer)
                continue
            inner.append(own)
        at += len(token)
    return min(at, len(page)) if flow is None else flow


def blocks(page: str) -> list[tuple[tuple[str, ...], bool, str, int, tuple]]:
    """``(path, furniture, text, characters in links, cues)`` of the text blocks."""
    found: list[Block] = []
    stack: list[tuple[str, str, bool, tuple]] = []       # tag, its name on the path, furniture at or above, cues at or above
    now: Block | None = None
    at, links = 0, 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        token = m.group() if m else "<"
        at += len(token)
        if token[0] != "<" or len(token) == 1 or token.startswith("<![CDATA["):
            if token.startswith("<![CDATA["):
                token = token[9:].removesuffix("]]>")
            if now is None:
                if not token.strip():
                    continue
                now = Block(tuple(s[1] for s in stack if s[0] in BLOCK), *(stack[-1][2:] if stack else (False, ())))
                found.append(now)
            now.text.append(token)
            now.linked += len(token.strip()) if links else 0
            continue
        if token[1] in "!?":
            continue
        tag = _NAME.match(token).group(1).lower()
        if token[1] == "/":
            if tag in BLOCK:
                now = None
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                links -= sum(1 for s in stack[depth:] if s[0] == "a")
                del stack[depth:]
            continue
        if tag in SILENT and not token.endswith("/>"):
            at = silent_end(page, tag, at, {s[0] for s in stack})
            continue
        if tag == "head":                         # its end tag may be missing; it has no text of its own
            continue
        if tag == "br" and now is not None:
            now.text.append(" ")
        if tag in BLOCK:
            now = None
            depth = None
            if any(s[0] == "p" for s in stack):   # a block ends an open paragraph
                depth = max(i for i, s in enumerate(stack) if s[0] == "p")
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in SCOPES:
                    break
                if stack[i][0] in ENDS.get(tag, ()):
                    depth = i if depth is None else min(depth, i)
            if depth is not None:
                links -= sum(1 for s in stack[depth:] if s[0] == "a")
                del stack[depth:]
        if tag in VOID or token.endswith("/>"):
            continue
        marks = [next((g for g in found_ if g), "") for found_ in _MARKS.findall(token)]
        words = set(re.split(r"[^a-z0-9]+", " ".join(marks).lower()))
        inside = any(s[0] in CONTENT for s in stack)
        out = bool(stack) and stack[-1][2] or tag in FURNITURE or tag == "header" and not inside
        cues = stack[-1][3] if stack else ()
        if tag in CONTENT:
            cues = tuple((where, foreign, True) for where, foreign, _ in cues)
        elif tag not in ("html", "body") and ((named := cue_words(marks)) or tag == "form"):
            cues += ((at, bool(named & FOREIGN), False),)
        stack.append((tag, f"{tag}.{'.'.join(sorted(words - {''}))}" if marks else tag, out, cues))
        links += tag == "a"
    made = []
    for b in found:
        text = _SPACE.sub(" ", html.unescape("".join(b.text))).strip()
        if text:
            made.append((b.path, b.out, text, min(b.linked, len(text)), b.cues))
    return made


def ratios(page_blocks: list) -> tuple[dict, dict]:
    """The raw and the smoothed ratio of each path, before any evidence.

    Per path the characters outside links and their punctuation are summed over
    its blocks; the geometric mean of the two (punctuation with one added) is the
    raw ratio, 0 for a path of links.  It is smoothed along the whole container
    that the path belongs to (:func:`home`): the mean of its own and of the
    container's ratio, which weights the container's paths by their text.
    """
    sums: dict[tuple, list[float]] = {}
    for path, _, text, linked, _ in page_blocks:
        s = sums.setdefault(path, [0, 0])
        s[0] += len(text) - linked
        s[1] += len(PUNCTUATION.findall(text)) * (1 - linked / len(text))
    raw = {p: math.sqrt(s[0] * (1 + s[1])) for p, s in sums.items()}
    homes: dict[tuple, list[float]] = {}
    for p, s in sums.items():
        h = homes.setdefault(home(p), [0.0, 0.0])
        h[0] += raw[p] * s[0]
        h[1] += s[0]
    return raw, {p: (raw[p] + homes[home(p)][0] / homes[home(p)][1]) / 2 if s[0] else 0.0 for p, s in sums.items()}


def _marked(some: list) -> list:
    return [b for b in some if any(step.split(".")[0] in CONTENT for step in b[0])]


def without_furniture(page_blocks: list) -> list:
    """The blocks outside page furniture.

    Elements named for layout furniture, and forms, that hold most of the
    page's text wrap it.  Where all marked articles lie below elements that
    look like furniture, or nothing lies outside them, the article (the text
    outside those with foreign words) is taken from there.
    """
    rest = [b for b in page_blocks if not b[1]]
    total = sum(len(b[2]) - b[3] for b in rest)
    held: dict[int, int] = {}
    for b in rest:
        for where, foreign, _ in b[4]:
            if not foreign:
                held[where] = held.get(where, 0) + len(b[2]) - b[3]
    wraps = {where for where, n in held.items() if n > WRAPPER * total}
    usable = [b for b in rest if all(c[0] in wraps for c in b[4])]
    if _marked(usable):
        return usable
    for fits in (lambda c: c[0] in wraps or c[2] and not c[1], lambda c: c[0] in wraps or c[2]):
        if found := _marked([b for b in rest if all(map(fits, b[4]))]):
            return found
    return usable or [b for b in rest if not any(c[1] for c in b[4])]


def home(path: tuple[str, ...]) -> tuple[str, ...]:
    """The container of a path: what is left without lists, tables, quotes and the like at its
    end; all that the page marks as its article is one container."""
    if any(step.split(".")[0] in CONTENT for step in path):
        return ("article",)
    n = len(path)
    while n and path[n - 1].split(".")[0] in FLOW:
        n -= 1
    return path[:n]


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The content blocks of a page, joined by empty lines.

    Every page is judged by its paths' ratios.  What its tags and class names say
    is evidence: text named as furniture is no candidate, and where the page
    marks an article (``article`` or ``main``), text outside it counts
    BESIDE_ARTICLE as much.  A container passes if its best path reaches the
    threshold, as a share of the best of the page; its blocks, and those of
    containers inside it, are content, but for containers inside it with nothing
    but links.  The body does not pass for the containers inside it, nor for its
    own blocks that are nothing but links.  A null page, and a page without
    text, give "".
    """
    usable = without_furniture(blocks(page or ""))
    marked = {b[0] for b in _marked(usable)}
    raw, smooth = ratios(usable)
    score = {p: v * (BESIDE_ARTICLE if marked and p not in marked else 1.0) for p, v in smooth.items()}
    best, most = max(score.values(), default=0.0), max(raw.values(), default=0.0)
    homes = {p: home(p) for p in score}
    passed = {homes[p] for p, v in score.items() if v >= threshold * best > 0}
    # a page of nothing but links in an article has no ratio; the mark alone speaks for it
    passed |= {homes[p] for p in marked} if not best else set()
    roots = {h for h in passed if all(step.split(".")[0] in ("body", "html") for step in h)}
    plain: dict[tuple, int] = {}
    for path, _, text, linked, _ in usable:
        plain[homes[path]] = plain.get(homes[path], 0) + len(text) - linked
    within = {h: any(h[:n] in passed and h[:n] not in roots for n in range(len(h))) for h in plain}

    def stays(path: tuple, text: str, linked: int) -> bool:
        h = homes[path]
        if h in passed:
            return h not in roots or raw[path] >= threshold * most or linked < len(text)
        return within[h] and plain[h] > 0

    return "\n\n".join(text for path, _, text, linked, _ in usable if stays(path, text, linked))


def with_main_text(pages: DataFrame, html_col: str = "html", out: str = "text", drop_html: bool = True) -> DataFrame:
    """``pages`` with the main text of ``html_col`` in ``out``.

    Each page is worked on whole and by itself, a batch at a time; nothing is
    shuffled.  Repeated rows give equal texts; other columns pass through, but
    one named ``out`` is replaced.  A page may be of any length; an empty table
    gives no rows.
    """
    def values(texts: list) -> pa.Array:
        return pa.array([main_text((t or b"").decode()) for t in texts], pa.string())

    return with_value(pages, html_col, values, out, StringType(), drop_html)
