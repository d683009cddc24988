"""One page's markup as blocks of text with the path of elements above them; for tasks."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

# Fixed values of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "q s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = "script|style|textarea|title|iframe"
#: An opening tag of the key closes an open element of the value, up to the nearest of LISTS.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
LISTS = frozenset("ul ol dl table article section div body main".split())
#: Elements and words of class, id and role that mark what is not the article.
MAIN_TAGS = frozenset(("article", "main"))
BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
#: Elements left out with all they hold; a tag without its end tag, or self-closed, alone.
PART_TAGS = frozenset("svg select button object canvas noscript template".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored "
    "nav navbar navigation menu breadcrumb breadcrumbs header footer masthead sidebar aside "
    "cookie cookies consent popup modal newsletter subscribe login signup "
    "comment comments reply replies respond disqus copyright contentinfo pagination pager toolbar".split()
)
#: Words that also name subjects: they mark only a name that says nothing else.
SUBJECT_WORDS = frozenset(
    "promo widget related share sharing social notice notices legal complementary search skip".split()
)
PLAIN_WORDS = frozenset(
    "area bar block box container content element group inner item items links list panel part "
    "row section text wrap wrapper".split()
)
#: A name with one of these tells the state of an element: no-sidebar, has-ads, ad-free.
STATE_WORDS = frozenset("no not non has with without free".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_PART = re.compile(rf"<(?:{'|'.join(sorted(PART_TAGS))})\b", re.I)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


class Block(NamedTuple):
    path: str
    boiler: bool
    text: str
    #: Whether only words of class, id or role mark it.
    worded: bool = False


class _Open(NamedTuple):
    tag: str
    path: str
    boiler: bool
    words: tuple[int, ...]  # elements up to this one that words mark
    main: bool  # whether it is or lies in an article or main element


def _names_boiler(name: str) -> bool:
    words = _WORDS.findall(name)
    if not STATE_WORDS.isdisjoint(words):
        return False
    if not BOILER_WORDS.isdisjoint(words):
        return True
    return not SUBJECT_WORDS.isdisjoint(words) and (SUBJECT_WORDS | PLAIN_WORDS).issuperset(words)


def _opened(tag: str, rest: str, above: _Open, key: int) -> _Open:
    names = " ".join(m[2].strip("\"'") for m in _NAMES.finditer(rest)) if rest else ""
    boiler, words = above.boiler or tag in BOILER_TAGS, above.words
    if names and not boiler and tag != "body":
        if any(map(_names_boiler, names.lower().split())):
            words = (*words, key)
    if rest and not boiler:
        boiler = _HIDDEN.search(rest) is not None
    step = tag + ("." + _DIGITS.sub("0", ".".join(sorted(names.split()))) if names else "")
    return _Open(tag, f"{above.path}/{step}", boiler, words, above.main or tag in MAIN_TAGS)


def _parts(page: str) -> dict[int, int]:
    """Start to end of the elements of ``PART_TAGS`` that end before what holds them does."""
    ends: dict[int, int] = {}
    if _PART.search(page) is None:
        return ends
    stack: list[tuple[str, int]] = []
    for m in _TOKEN.finditer(page):
        tag = (m["tag"] or "").lower()
        if tag not in PART_TAGS and tag not in LISTS:
            continue
        if not m["end"]:
            if not m["rest"].endswith("/"):
                stack.append((tag, m.start()))
            continue
        depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
        if depth is not None:
            if tag in PART_TAGS:
                ends[stack[depth][1]] = m.end()
            del stack[depth:]
    return ends


def _marked(found: list[tuple[_Open, str, str]], freed: set[int]) -> list[Block]:
    """Blocks from (innermost element, path, text).

    A word marks no element of ``freed``, nor one with most of the text that no tag marks.
    """
    below: Counter[int] = Counter()
    total = 0
    for inner, _, text in found:
        if not inner.boiler:
            total += len(text)
            for key in inner.words:
                below[key] += len(text)
    kept = freed.union(key for key, n in below.items() if 2 * n > total)
    out = []
    for inner, path, text in found:
        worded = not kept.issuperset(inner.words)
        out.append(Block(path, inner.boiler or worded, text, worded and not inner.boiler))
    return out


def blocks(page: str) -> tuple[list[Block], dict[str, int]]:
    """Text blocks in page order, and how often each element path opens.

    A block ends where an element begins or ends that is not inline.  Unclosed elements end
    with what holds them, a paragraph with the next element that is not inline.  Words never
    mark what is or holds an outermost article or main element.
    """
    stack = [_Open("", "", False, (), False)]
    found: list[tuple[_Open, str, str]] = []
    freed: set[int] = set()
    ends = _parts(page)
    opened: dict[str, int] = {}
    parts: list[str] = []
    at = 0

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            holder = next(x for x in reversed(stack) if x.tag not in INLINE)
            found.append((stack[-1], holder.path, text))

    def close_to(index: int) -> None:
        flush()
        del stack[index:]

    for m in _TOKEN.finditer(page):
        if m.start() < at:  # inside an element of PART_TAGS
            continue
        if m.start() > at:
            parts.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in PART_TAGS:
            at = ends.get(m.start(), at)
            continue
        inline = tag in INLINE
        if m["end"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth and inline:
                # An inline end tag never closes an element that holds blocks.
                if all(x.tag in INLINE for x in stack[depth:]):
                    if stack[depth][2:4] != stack[depth - 1][2:4]:
                        flush()
                    del stack[depth:]
            elif depth:
                close_to(depth)
            elif not inline:
                flush()
            continue
        if not inline:
            flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in INLINE:
                    continue
                if stack[i].tag == "p" or stack[i].tag in CLOSES.get(tag, ()):
                    del stack[i:]
                    continue
                if stack[i].tag in LISTS or tag not in CLOSES:
                    break
        if tag == "br":
            parts.append(" ")
        new = _opened(tag, m["rest"], stack[-1], m.start())
        if new.main and not stack[-1].main and not new.boiler:
            freed.update(new.words)
        opened[new.path] = opened.get(new.path, 0) + 1
        if tag not in VOID and not m["rest"].endswith("/"):
            if new[2:4] != stack[-1][2:4]:
                flush()
            stack.append(new)
    parts.append(page[at:])
    flush()
    return _marked(found, freed), opened
