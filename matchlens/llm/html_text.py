"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one for each stretch between block-level tags.
Boilerplate (menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts and the like, told by tag, role, class and id) gives no
lines. A form, class or id is only a hint: an element that holds most of the
text outside links, or the only article with as much text as the rest of the page, is no boilerplate,
and readers' comments are not counted as text for that. Words such as "ad" mark an element only if the
rest of their class says no more than where it stands ("ad-slot", not "ad-free-zone").

Every line weighs its text outside links. Tags that name the page's article are a prior for that: if
its articles hold a fair share of the page's text, their lines with any text outside links weigh ``SURGE`` more
and lines outside are left out, but for headings in ``main``; else ``main`` is tried likewise. Articles with a small
share are teasers, as those that are mostly links beside a larger one, and are left out.
The weights of ``WINDOW`` lines from each line on are summed: the text starts where the sum surges to
``SURGE`` and ends where it dives to nothing, so that lists of links drop out inside an article too.
Headings and paragraphs of links
next to the text belong to it, and so do all headings, paragraphs and lines with
weight in the elements that hold the text's lines, however short and far from it.
Boilerplate is
never part of the result; nothing else between surge and dive is left out. An article of
links alone is taken whole.

Defined cases: a null or empty page has the empty text, as a page of nothing
but boilerplate has; unclosed and stray tags are taken as browsers take them,
a page cut off inside a tag or comment ends there; repeated ids and rows each
give a row; a null id stays null; an empty table gives an empty one; other
columns are not read. All scans are linear in the page.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from matchlens.llm.rowwise import map_texts

#: Lines in a block, and the characters in one at which text starts.
WINDOW = 3
SURGE = 80
#: Articles with less than one part in so many of what is around them announce other pages; hinted text counts that much less again.
SHARE = 4

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Tags by what they do.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
BOILERPLATE = frozenset(
    "head nav footer aside script style noscript template iframe object canvas svg button select option textarea title dialog menu audio video map".split()
)
ARTICLE = frozenset(("article", "main"))
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

#: Words in a class or id that mark boilerplate, and those that mark readers' comments.
HINTS = frozenset(
    "adbox adslot adsense advert adverts advertisement advertising breadcrumb breadcrumbs cookie cookies footer gdpr login masthead modal nav navbar "
    "navigation newsletter pager pagination popup promoted recommended sidebar signup sponsor sponsored subscribe subscription toolbar topbar".split()
)
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
#: Words that mark boilerplate only among words that say where an element stands, those words, and those that say the opposite.
PARTIAL = frozenset("ad ads banner consent menu notice notices promo promotion related search share sharing social widget".split())
PLACES = frozenset(
    "area articles aside bar block body bottom box button buttons center container content end fixed floating footer form group head header holder icons inline inner item items label "
    "left links list main media middle mobile more news panel post posts right row section side site slot small stories sticky text title tools top unit wrap wrapper".split()
)
CONTRARY = frozenset("has with without no free enabled disabled".split())
_OPEN_ALWAYS = frozenset(("html", "body", "main"))


#: What marks a tag as boilerplate: nothing, a hint, a hint of readers' comments, or a certain sign.
NONE, HINT, COMMENT, CERTAIN = range(4)


def _hinted(token: str) -> bool:
    """Whether one class or id marks boilerplate."""
    words = {w.lower() for w in _WORD.findall(token) if len(w) > 1}
    if words & CONTRARY:
        return False
    return bool(words & HINTS) or bool(words & PARTIAL and words <= PARTIAL | PLACES) or ("header" in words and words <= {"header", "site", "page", "top", "head"})


def _marked(name: str, rest: str) -> int:
    """How a tag or its attributes mark it as boilerplate."""
    if name in BOILERPLATE or name == "header":
        return CERTAIN
    found = HINT if name == "form" else NONE
    if name in _OPEN_ALWAYS or not rest:
        return found
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key == "role" and value.lower() in ROLES:
            return CERTAIN
        if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "").lower()) or (key == "aria-hidden" and value.lower() == "true"):
            return CERTAIN
        if key in ("class", "id"):
            if any(w.lower() in COMMENTS for w in _WORD.findall(value)):
                found = COMMENT
            elif name not in ARTICLE and any(map(_hinted, value.split())):
                found = max(found, HINT)
    return found


@dataclass(eq=False)
class _Hinted:
    """An element that may be boilerplate, inside another such element or none."""

    outer: "_Hinted | None"
    comment: bool  # it or one around it holds readers' comments
    plain: int = 0  # characters outside links and comments
    article: int = 0  # those of them inside an article
    holds_article: bool = False
    dropped: bool = True


@dataclass(eq=False)
class _Named:
    """An article that no other article holds, or a ``main`` that nothing named holds."""

    name: str
    in_main: bool
    hint: "_Hinted | None"
    plain: int = 0  # characters outside links, hints and comments left out
    linked: int = 0  # those in links


@dataclass
class _Line:
    parts: list[tuple[str, int, "_Hinted | None"]]  # text, characters outside links, the innermost hint
    inside: "_Named | None"
    joins: str  # the tag of a heading or paragraph
    container: int


class _Page:
    """Lines of one page, and where in the page the reader stands."""

    def __init__(self) -> None:
        self.lines: list[_Line] = []
        # Names, whether they are boilerplate, the hint and the named element before, numbers.
        self.open: list[tuple[str, bool, _Hinted | None, _Named | None, int]] = []
        self.counts: dict[str, int] = {}
        self.blocks: list[int] = []  # where in ``open`` the block-level ones are
        self.hidden = self.links = self.made = 0
        self.named: _Named | None = None
        self.hint: _Hinted | None = None
        self.hints: list[_Hinted] = []  # outer ones first
        self.all_named: list[_Named] = []  # those that are not certainly hidden
        self.parts: list[tuple[str, int, _Hinted | None]] = []

    def text(self, raw: str) -> None:
        if not raw or (self.hidden and not self._headed()):
            return
        part = unescape(raw) if "&" in raw else raw
        self.parts.append((part, 0 if self.links else len(part.strip()), self.hint))

    def _headed(self) -> bool:
        """A heading in an article's own header belongs to the article."""
        return self.named is not None and self.hidden == 1 and self.counts.get("header", 0) == 1 and any(self.counts.get(h) for h in HEADING)

    def line(self) -> None:
        if any(not part.isspace() for part, _, _ in self.parts):
            name, number = (self.open[self.blocks[-1]][0], self.open[self.blocks[-1]][-1]) if self.blocks else ("", 0)
            joins = name if name == "p" or name in HEADING else ""
            if joins:
                number = self.open[self.blocks[-2]][-1] if len(self.blocks) > 1 else 0
            self.lines.append(_Line(self.parts, self.named, joins, number))
        self.parts = []

    def start(self, name: str, rest: str) -> None:
        if name not in INLINE:
            self.line()
            if self.blocks and self.open[self.blocks[-1]][0] == "p" or (name == "li" and self.blocks and self.open[self.blocks[-1]][0] == "li"):
                self._cut(self.blocks[-1])
        if name in VOID:
            return
        mark = _marked(name, rest)
        if name not in INLINE:
            self.blocks.append(len(self.open))
        self.made += 1
        self.open.append((name, mark == CERTAIN, self.hint, self.named, self.made))
        self.counts[name] = self.counts.get(name, 0) + 1
        self.hidden += mark == CERTAIN
        if mark in (HINT, COMMENT):
            self.hint = _Hinted(self.hint, mark == COMMENT or (self.hint is not None and self.hint.comment))
            self.hints.append(self.hint)
        self.links += name == "a"
        if name in ARTICLE and not self.hidden and (self.named is None or (name, self.named.name) == ("article", "main")):
            self.named = _Named(name, self.named is not None, self.hint)
            self.all_named.append(self.named)

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.line()
        if self.counts.get(name):
            at = len(self.open) - 1
            while self.open[at][0] != name:
                at -= 1
            if name in INLINE and self.blocks and at < self.blocks[-1]:
                return  # a formatting tag does not close the blocks inside it
            self._cut(at)

    def _cut(self, at: int) -> None:
        _, _, self.hint, self.named, _ = self.open[at]
        for name, marked, _, _, _ in self.open[at:]:
            self.counts[name] -= 1
            self.hidden -= marked
            self.links -= name == "a"
        del self.open[at:]
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()


def _level(page: _Page) -> tuple[str, ...]:
    """The tags that name the page's article: by the share of its text, hinted parts of which count little."""
    known: dict[str, int] = {"article": 0, "main": 0, "rest": 0, "hinted": 0}
    for line in page.lines:
        own, within = line.inside, line.inside.hint if line.inside else None
        for part, plain, hint in line.parts:
            if hint is not None and hint.comment:
                continue
            if hint is not within:
                known["hinted"] += plain if own is None else 0
                continue
            known[own.name if own else "rest"] += plain
            if own:
                own.plain += plain
                own.linked += len(part.strip()) - plain
    has = {named.name for named in page.all_named if named.hint is None or not named.hint.comment}
    around = SHARE**2 * known["rest"] + known["hinted"]
    if "article" in has and (not (known["main"] or known["rest"]) or (known["article"] >= known["main"] and SHARE**3 * known["article"] >= around)):
        return ("article",)
    if "main" in has and (not known["rest"] or SHARE**3 * (known["main"] + known["article"]) >= around):
        return ("article", "main")
    return ()


def _teasers(page: _Page, tags: tuple[str, ...]) -> set[_Named]:
    """Articles that only announce others: a small share of the text, or mostly links beside a larger one."""
    articles = [named for named in page.all_named if named.name == "article"]
    if tags == ("article",):
        most = max(named.plain for named in articles)
        return {named for named in articles if named.plain < most and named.linked > named.plain}
    most = sum(named.plain for named in page.all_named if named.name == "main") if tags else 0
    return {named for named in articles if not tags or not named.in_main or SHARE * named.plain < most}


def _decide(page: _Page) -> tuple[tuple[str, ...], set[_Named]]:
    """Say which hinted elements are boilerplate, which tags name the page's article, and which articles are teasers."""
    tags = _level(page)
    teasers = _teasers(page, tags)
    own = [named for named in page.all_named if named.name in tags and named not in teasers]
    free = any(named.hint is None for named in own)
    total = 0
    for line in page.lines:
        inside = line.inside is not None and line.inside.name in tags
        for _, plain, hint in line.parts if inside or not free else ():
            if hint is None or not hint.comment:
                total += plain
                if hint is not None:
                    hint.plain += plain
                    hint.article += plain if inside else 0
    for named in own:
        if named.hint is not None:
            named.hint.holds_article = not free
    for hint in reversed(page.hints):
        if hint.outer is not None:
            hint.outer.plain += hint.plain
            hint.outer.article += hint.article
            hint.outer.holds_article |= hint.holds_article
    for hint in page.hints:
        main = 2 * hint.plain > total or (hint.holds_article and hint.article and hint.article >= total - hint.plain)
        hint.dropped = hint.comment or not main or (hint.outer is not None and hint.outer.dropped)
    return (tags if any(named.hint is None or not named.hint.dropped for named in own) else ()), teasers


def lines_of(html: str) -> list[tuple[str, int, bool, int]]:
    """Lines of a page that may be text: the text, its weight, whether it joins text beside it, its container."""
    page, at, lower = _Page(), 0, None
    while found := _TAG.search(html, at):
        page.text(html[at : found.start()])
        at = found.end()
        if not found["name"]:
            continue
        name = found["name"].lower()
        if found["close"]:
            page.end(name)
            continue
        page.start(name, found["rest"])
        if name in RAW:
            lower = html.lower() if lower is None else lower
            at = lower.find(f"</{name}", at)
            if at < 0:
                at = len(html)
                break
    page.text(html[at:])
    page.line()
    tags, teasers = _decide(page)
    lines = []
    for line in page.lines:
        own, title = line.inside, False
        if own in teasers:
            continue
        if tags and (own is None or own.name not in tags):
            title = own is not None and line.joins in HEADING  # in ``main``, around the article
            if not title:
                continue
        parts = [(part, plain) for part, plain, hint in line.parts if hint is None or not hint.dropped]
        if joined := " ".join("".join(part for part, _ in parts).split()):
            weight = 0 if title else sum(plain for _, plain in parts)
            lines.append((joined, weight + SURGE * bool(tags and weight), bool(line.joins), line.container))
    if tags and not any(weight for _, weight, _, _ in lines):
        lines = [(text, SURGE, joins, container) for text, _, joins, container in lines]
    return lines


def between_surge_and_dive(weights: list[int], surge: int) -> list[tuple[int, int]]:
    """Stretches of lines, end exclusive, from where a block reaches ``surge`` to where it is empty.

    The lines with weight that lead up to the surge, such as a short heading, belong to it.
    """
    total, sums = 0, [0] * len(weights)
    for i in range(len(weights) - 1, -1, -1):
        total += weights[i] - (weights[i + WINDOW] if i + WINDOW < len(weights) else 0)
        sums[i] = total
    stretches, start, last, run = [], None, 0, 0
    for i, (weight, block) in enumerate(zip(weights, sums)):
        if not weight:
            run = i + 1
        if start is None and weight and block >= surge:
            start = run
        if start is not None:
            if block == 0:
                stretches.append((start, last + 1))
                start = None
            elif weight:
                last = i
    return stretches if start is None else [*stretches, (start, last + 1)]


def main_text(html: str | None) -> str:
    """The lines between surge and dive, joined by one space."""
    lines = lines_of(html or "")
    weights = [weight for _, weight, _, _ in lines]
    most = max((sum(weights[i : i + WINDOW]) for i in range(len(weights))), default=0)
    chosen = [False] * len(lines)
    for a, b in between_surge_and_dive(weights, max(1, min(SURGE, most))):
        while a and lines[a - 1][2] and not chosen[a - 1]:
            a -= 1
        while b < len(lines) and lines[b][2] and not chosen[b]:
            b += 1
        chosen[a:b] = [True] * (b - a)
    homes = {container for (_, weight, _, container), own in zip(lines, chosen) if own and weight}
    return " ".join(text for (text, weight, joins, container), own in zip(lines, chosen) if own or (container in homes and (weight or joins)))


FIELDS = StructType([StructField("text", StringType()), StructField("n_chars", LongType())])


def _maker() -> Callable:
    def row(html: str | None) -> tuple[str, int]:
        text = main_text(html)
        return text, len(text)

    return row


def extract(df: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key``, ``text`` and ``n_chars`` for every row."""
    return map_texts(df, key, html, FIELDS, partial(_maker))
