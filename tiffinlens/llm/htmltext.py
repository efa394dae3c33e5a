"""Main text of web pages: containers scored per page, their paths voted on per host, then extracted again.

A container's path is generalised: tags with their classes, digits taken out.
Each page votes for the path of its best container, widened to the article
around it; Spark adds the votes up per
host, and all pages of the host are extracted from where the host's article is.
What stands outside all containers belongs to the page itself, whose path is
empty; pages of a host where that path wins are each extracted on their own.
A class or id is a weight, not a verdict, where it could say something else,
and a discussion is also told by its shape: see ``settle``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

# Elements that are never main text, nor anything inside them.
DROPPED_TAGS = frozenset(
    "head script style noscript template nav header footer aside form button select option textarea input label "
    "iframe object svg canvas dialog menu audio video".split()
)
# Words at either end of a class or id, or in a role, that say the same.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice notices notification pagination popup promo promoted promotion related replies respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split()
)
# Of these words those that mean something else beside a word that is none of the next: share-price, social-history.
OPEN_WORDS = frozenset(
    "ad ads advert adverts advertising banner header menu notice notices notification promotion related search "
    "share sharing skip social sponsored widget".split()
)
# Words that name a part of a page's frame, and leave the word beside them its meaning.
FRAME_WORDS = frozenset(
    "area bar block body bottom box btn button buttons center column container content count desktop group holder "
    "icon icons inline inner item items js left link links list main mobile module outer page pane panel post posts "
    "primary right row secondary section site slot small sticky text title top unit widgets wrap wrapper".split()
)
# readers' voices; no amount of their text makes an article.
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
# Words that make a header that of an article.
ARTICLE_WORDS = frozenset("article entry post story".split())
# Elements that hold a page or its article whatever their classes say.
KEPT_TAGS = frozenset("html body main article".split())
RAW_TAGS = frozenset("script style textarea title noscript template iframe".split())
CONTAINERS = frozenset("body main article section div td center".split())
BLOCKS = CONTAINERS | frozenset(
    "html p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr blockquote pre figure figcaption "
    "address hr details summary caption".split()
)
# Share of the counted text that a container must hold to stand for all of it.
MOST = 0.8
# Share that an article has at least, against the discussion behind it or what stands around it.
SOME = 0.2
# Messages that make a discussion, and characters that the line naming a writer may have.
MESSAGES = 3
NAME_CHARS = 60
HEADINGS = {f"h{level}": level for level in range(1, 7)}
# Blocks of one paragraph, which a word that could say something else does not take out.
LINES = frozenset(["p", *HEADINGS])
# Elements tracked while open, besides blocks; all others are inline and only their text counts.
TRACKED = BLOCKS | DROPPED_TAGS | frozenset("th a".split())
VOID = frozenset("hr br input img meta link area base col embed source track wbr".split())
SPACES = frozenset("br td th".split())
# What an opening tag ends: itself, among the open elements down to one of the others.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = frozenset("ul ol dl table article section div main body blockquote".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Element:
    tag: str
    path: str
    dropped: bool
    container: int
    mark: int = -1
    own_header: bool = False


@dataclass
class Page:
    """Blocks in page order as (container, text, characters of links), and each container's path and parent.

    Container 0 is the page itself. ``levels`` has the heading level of each block,
    0 for none, ``marked`` the innermost mark it stands under, -1 for none. ``marks``
    has the mark around each mark and how surely its name takes it out.
    """

    blocks: list[tuple[int, str, int]] = field(default_factory=list)
    levels: list[int] = field(default_factory=list)
    marked: list[int] = field(default_factory=list)
    marks: list[tuple[int, int]] = field(default_factory=list)
    paths: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [-1])

    @property
    def headlines(self) -> list[int]:
        return [i for i, level in enumerate(self.levels) if level == 1]


# How surely names take an element out: not at all, unless most text is in it, unless it is all of an article, always.
CLEAR, LIKELY, SURE, ALWAYS = range(4)


def _words(name: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", name) if w]


def marked_out(names: list[str]) -> int:
    found = CLEAR
    for words in map(_words, names):
        if not words or words[0] in ("has", "with", "no", "without", "is"):
            continue
        ends = {words[0], words[-1]} & DROPPED_WORDS
        if ends & COMMENT_WORDS:
            return ALWAYS
        if ends:
            known = not ends <= OPEN_WORDS or all(w in DROPPED_WORDS or w in FRAME_WORDS for w in words)
            found = max(found, SURE if known else LIKELY)
    return found


def heads_article(names: list[str]) -> bool:
    """Whether a name says header of an article."""
    return any("header" in words and ARTICLE_WORDS & set(words) for words in map(_words, names))


def parse(html: str) -> Page:
    """One pass over the tags; unclosed and stray tags end where the next block says so."""
    page = Page()
    stack: list[Element] = []
    parts: list[str] = []
    linked = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                page.levels.append(next((HEADINGS[e.tag] for e in stack[-3:] if e.tag in HEADINGS), 0))
                page.marked.append(stack[-1].mark if stack else -1)
                page.blocks.append((stack[-1].container if stack else 0, text, linked))
            parts.clear()
        linked = 0

    def close(to: int) -> None:
        if any(e.tag in BLOCKS for e in stack[to:]):
            flush()
        del stack[to:]

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not (stack and stack[-1].dropped):
            text = unescape(raw) if "&" in raw else raw
            parts.append(text)
            if any(e.tag == "a" for e in stack[-3:]):
                linked += len(text.strip())

    while True:
        found = TAG.search(html, at)
        if not found:
            say(html[at:])
            break
        say(html[at : found.start()])
        at = found.end()
        slash, name, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not name:
            continue
        tag = name.lower()
        if tag in SPACES:
            if not (stack and stack[-1].dropped):
                parts.append(" ")
        if tag not in TRACKED and tag not in RAW_TAGS:
            continue
        if slash:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        if tag in VOID:
            if tag in BLOCKS:
                flush()
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in CLOSES[tag]:
                    close(i)
                    break
                if stack[i].tag in STOPS:
                    break
        elif tag in BLOCKS and stack and any(e.tag == "p" for e in stack[-2:]):
            close(next(i for i in range(len(stack)) if stack[i].tag == "p" and i >= len(stack) - 2))
        if tag in BLOCKS or tag in DROPPED_TAGS:
            flush()
        above = stack[-1] if stack else None
        own_header = bool(above and above.own_header)
        dropped = bool(above and above.dropped) or (tag in DROPPED_TAGS and tag != "form")
        if own_header and tag in HEADINGS:
            dropped = False
        container = above.container if above else 0
        path = above.path if above else ""
        mark = above.mark if above else -1
        sure = SURE if tag == "form" else CLEAR
        heading = tag == "header" and not (above and above.dropped) and any(e.tag == "article" for e in stack)
        classes: list[str] = []
        if attributes and tag != "a":
            for kind, *values in ATTRIBUTE.findall(attributes):
                value = "".join(values).lower()
                names = value.split()
                if kind.lower() == "class":
                    classes = names
                if tag in KEPT_TAGS:
                    continue
                if kind.lower() == "role":
                    dropped = dropped or value.strip() in DROPPED_ROLES
                elif not dropped and heads_article(names):
                    heading = True
                else:
                    sure = max(sure, marked_out(names))
        if tag in LINES and sure == LIKELY:
            sure = CLEAR
        if heading:  # of what heads an article its headings are part of it
            own_header, dropped = True, True
        elif tag in DROPPED_TAGS:
            own_header = False
        if sure == ALWAYS:
            own_header, dropped = False, True
        elif sure and not dropped:
            page.marks.append((mark, sure))
            mark = len(page.marks) - 1
        if tag in CONTAINERS:
            plain = sorted({re.sub(r"\d+", "", c) for c in classes} - {""})
            path = f"{path}>{'.'.join([tag, *plain])}"
            page.paths.append(path)
            page.parents.append(container)
            container = len(page.paths) - 1
        stack.append(Element(tag, path, dropped, container, mark, own_header))
    flush()
    settle(page)
    return page


def settle(page: Page) -> None:
    """Take out the blocks that their names or the shape of their surroundings tell to be no article.

    A mark stays if it holds as much as all unmarked text, or SOME of it and the page's
    headline; if its name is sure, only if it holds a headline and MOST of it all.
    Blocks in discussions go.
    """
    if page.marks:
        held = [0] * len(page.marks)
        headed = [False] * len(page.marks)
        rest, rest_headed = 0, False
        for (_, text, linked), mark, level in zip(page.blocks, page.marked, page.levels):
            if mark < 0:
                rest += worth_of(text, linked)
                rest_headed = rest_headed or level == 1
            else:
                held[mark] += worth_of(text, linked)
                headed[mark] = headed[mark] or level == 1
        for mark in range(len(held) - 1, -1, -1):  # inner marks stand after outer ones
            outer = page.marks[mark][0]
            if outer >= 0:
                held[outer] += held[mark]
                headed[outer] = headed[outer] or headed[mark]
        out = []
        for mark, (outer, sure) in enumerate(page.marks):
            if outer >= 0:  # inside what stays, a mark is held against all that is around it
                stays = not out[outer] and 2 * held[mark] >= held[outer] and (sure == LIKELY or headed[mark])
            elif sure == LIKELY:
                alone = headed[mark] and not rest_headed
                stays = held[mark] >= max(rest, 1) or (alone and held[mark] >= SOME * rest)
            else:
                stays = headed[mark] and held[mark] * (1 - MOST) >= rest * MOST
            out.append(not stays)
        _keep(page, [mark < 0 or not out[mark] for mark in page.marked])
    gone = discussions(page)
    if gone:
        inside: list[bool] = []
        for c, parent in enumerate(page.parents):
            inside.append(c in gone or (parent >= 0 and inside[parent]))
        _keep(page, [not inside[c] for c, _, _ in page.blocks])


def _keep(page: Page, kept: list[bool]) -> None:
    page.blocks = [b for b, k in zip(page.blocks, kept) if k]
    page.levels = [v for v, k in zip(page.levels, kept) if k]
    page.marked = [m for m, k in zip(page.marked, kept) if k]


def discussions(page: Page) -> set[int]:
    """Containers of messages: MESSAGES children or more of one path, without headings, that hold MOST of the text.

    They follow an article: an article element with the headline, or as long as
    they are, or else prose under a headline, and then most messages begin with a
    line that could name their writer. Of either at least SOME of their text.
    """
    children: dict[int, dict[str, list[int]]] = {}
    for c, parent in enumerate(page.parents):
        if parent > 0 and _tag(page.paths[parent]) not in KEPT_TAGS:
            children.setdefault(parent, {}).setdefault(page.paths[c], []).append(c)
    groups = {c: max(alike.values(), key=len) for c, alike in children.items()}
    groups = {c: group for c, group in groups.items() if len(group) >= MESSAGES}
    if not groups:
        return set()
    n = len(page.paths)
    sizes, blocks = [0] * n, [0] * n
    headings: list[set[int]] = [set() for _ in range(n)]
    first: list[int | None] = [None] * n
    for i, ((c, text, _), level) in enumerate(zip(page.blocks, page.levels)):
        sizes[c] += len(text)
        blocks[c] += 1
        headings[c] |= {level} - {0}
        first[c] = i if first[c] is None else first[c]
    for c in range(n - 1, 0, -1):
        above = page.parents[c]
        sizes[above] += sizes[c]
        blocks[above] += blocks[c]
        headings[above] |= headings[c]
        if first[c] is not None and (first[above] is None or first[c] < first[above]):
            first[above] = first[c]
    last = list(range(n))  # the last container inside each
    for c in range(n - 1, 0, -1):
        last[page.parents[c]] = max(last[page.parents[c]], last[c])
    articles = [c for c in range(n) if _tag(page.paths[c]) == "article" and sizes[c]]
    before = [0]
    for (_, text, linked), level in zip(page.blocks, page.levels):
        before.append(before[-1] + (0 if level else worth_of(text, linked)))
    headline = next((i for i, level in enumerate(page.levels) if level == 1), len(page.blocks))
    found: set[int] = set()
    for c, group in groups.items():
        size = sizes[c]
        messages = [m for m in group if sizes[m]]
        if len(messages) < MESSAGES or sum(sizes[m] for m in messages) < MOST * size:
            continue
        if 1 in headings[c] or any(headings[m] for m in messages):
            continue
        if any(last[a] < c and sizes[a] >= SOME * size and (1 in headings[a] or sizes[a] >= size) for a in articles):
            found.add(c)
            continue
        start = first[c] or 0
        prose = before[start] - before[min(headline, start)]
        named = sum(
            blocks[m] > 1
            and len(page.blocks[first[m]][1]) <= NAME_CHARS
            and page.blocks[first[m]][1][-1] not in ".!?:;,"
            for m in messages
        )
        if headline < start and prose >= SOME * size and named >= MOST * len(messages):
            found.add(c)
    return found


def worth_of(text: str, linked: int) -> int:
    """Characters of a block, those of links counted against it."""
    return max(0, len(text) - 2 * linked)


def best_path(page: Page) -> str | None:
    """The path of the densest container, widened to the article around it.

    Its own blocks count with their characters outside links, those of its
    direct children for half; longer paths lose ties, then later ones.
    """
    scores: dict[int, float] = {}
    for container, text, linked in page.blocks:
        worth = worth_of(text, linked)
        scores[container] = scores.get(container, 0) + worth
        if page.parents[container] >= 0:
            above = page.parents[container]
            scores[above] = scores.get(above, 0) + worth / 2
    if not scores or max(scores.values()) <= 0:
        return None
    return page.paths[widened(page, min(scores, key=lambda c: (-scores[c], len(page.paths[c]), c)))]


def _tag(path: str) -> str:
    return path.rsplit(">", 1)[-1].split(".", 1)[0]


def _by_path(page: Page, amounts: list[tuple[int, int]]) -> dict[str, int]:
    """Amounts of (container, amount), added up over all that the containers of a path hold."""
    sums = [0] * len(page.paths)
    for c, amount in amounts:
        sums[c] += amount
    out: dict[str, int] = {}
    for c in range(len(sums) - 1, -1, -1):  # children stand after their parents
        if page.parents[c] >= 0:
            sums[page.parents[c]] += sums[c]
        out[page.paths[c]] = out.get(page.paths[c], 0) + sums[c]
    return out


def widened(page: Page, best: int) -> int:
    """The container of the whole article that ``best`` is a part of.

    That is the outermost article around it, or without one the lowest container
    around it that holds MOST of the text in its main element, else of the page.
    If articles of other paths hold much too, it is the lowest that holds MOST of
    all articles. Text counts as in the score, and for all containers of a path
    together, as they are extracted. An h1 left out is taken in by the lowest
    container that has it, if what that adds is neither mostly links nor over
    1 - MOST of its text.
    """
    above = [best]
    while page.parents[above[-1]] >= 0:
        above.append(page.parents[above[-1]])
    tags = [_tag(page.paths[c]) for c in above]
    at = max((i for i, tag in enumerate(tags) if tag == "article"), default=0)
    in_articles = tags[at] == "article"
    last = next((i for i, tag in enumerate(tags) if tag == "main" and i >= at), len(above) - 1)
    counted: list[bool] = []
    in_base: list[bool] = []
    in_article: list[bool] = []
    for c, parent in enumerate(page.parents):
        in_base.append(tags[last] != "main" or c == above[last] or (parent >= 0 and in_base[parent]))
        in_article.append(_tag(page.paths[c]) == "article" or (parent >= 0 and in_article[parent]))
        counted.append(in_base[c] and (in_article[c] or not in_articles))
    worths = [(c, worth_of(text, linked)) for c, text, linked in page.blocks if counted[c]]
    total = sum(worth for _, worth in worths)
    held = _by_path(page, worths)
    while at < last and held[page.paths[above[at]]] < MOST * total:
        at += 1
    chosen = page.paths[above[at]]
    heads = _by_path(page, [(page.blocks[i][0], 1) for i in page.headlines])
    wider = next((c for c in above[at : last + 1] if heads[page.paths[c]]), above[at])
    if page.paths[wider] != chosen:
        path = page.paths[wider]
        sizes = _by_path(page, [(c, len(text)) for c, text, _ in page.blocks])
        links = _by_path(page, [(c, linked) for c, _, linked in page.blocks])
        added = sizes[path] - sizes[chosen]
        if 2 * (links[path] - links[chosen]) <= added and added <= (1 - MOST) * sizes[path]:
            return wider
    return above[at]


def text_under(page: Page, path: str) -> str | None:
    """Blocks inside containers of ``path``, or None if the page has none."""
    inside: list[bool] = []
    for p, parent in zip(page.paths, page.parents):
        inside.append(p == path or (parent >= 0 and inside[parent]))
    if not any(inside):
        return None
    return "\n\n".join(text for container, text, _ in page.blocks if inside[container])


def main_text(html: str | None, path: str | None) -> str:
    """The text at ``path``; of a page without it or if it is empty, at its own best path; without one, all."""
    if not html:
        return ""
    page = parse(html)
    text = text_under(page, path) if path else None
    if not text:
        own = best_path(page)
        text = text_under(page, "" if own is None else own)
    return text or ""


def host_of(url: Column) -> Column:
    """The host in lower case; empty for a NULL url or one without a host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per page; equal rows are added up by Spark before they are shuffled."""
    for batch in batches:
        paths = [best_path(parse(h.as_py())) if h.is_valid else None for h in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], names=["host", "path"])


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the path with most votes of the host's pages; of equal ones the first by name, the empty one last."""
    votes = (
        pages.select(host_of(F.col("url")).alias("host"), "html")
        .mapInArrow(_votes, "host string, path string")
        .where("path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.count("*").alias("votes"))
    )
    rank = F.struct((-F.col("votes")).alias("rank"), (F.col("path") == "").alias("whole"), "path")
    return votes.groupBy("host").agg(F.min(rank).alias("best")).select("host", "best.path")


def text_at(html: Column, path: Column) -> Column:
    @F.pandas_udf("string")
    def texts(pages: pd.Series, paths: pd.Series) -> pd.Series:
        found = [
            main_text(h if isinstance(h, str) else None, p if isinstance(p, str) else None)
            for h, p in zip(pages, paths)
        ]
        return pd.Series(found, dtype=object)

    return texts(html, path)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``.

    NULL and empty html give an empty text. Pages without a host vote together.
    Repeated rows vote each and give repeated rows. One row per host meets the
    pages: broadcast only below the session's threshold, else joined by shuffle,
    where adaptive execution splits a hot host.
    """
    paths = staged(host_paths(pages), "host-paths")
    placed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(paths, "host", "left")
    return placed.select("page_id", "url", text_at(F.col("html"), F.col("path")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
