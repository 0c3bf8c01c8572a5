"""Main text of web pages by block rules in two passes (operator 2).

A page is cut into blocks at block-level tags; inline tags cut nothing. The first pass decides blocks by
their length, the share of their characters inside links and the density of stop words. Blocks in
elements that by name, role, class or id are menus, page headers and footers, sidebars, notices,
adverts, forms or reader comments are boilerplate, and if the page marks an article (or main part) with
a fair share of the text, what lies outside it is boilerplate and what lies inside needs no stop words.
There a class or id other than those of adverts, cookies and comments counts only if it says nothing else
(``share-box``, not ``share-price``), and a teaser is text. On a page none of whose blocks has the stop words of a listed language, length and links decide.
The second pass gives blocks that are too short or too mixed to decide the label of the nearest block
decided by length, links and stop words, one in the same container if there is any, or else in the
innermost container around that holds one; between two at the same distance that differ, sentences count
as text.

Character references are decoded, white space inside a block becomes one space, blocks are trimmed and
joined in page order by one space. Nothing is cut to a length.

A null, empty or blank page has the text ''. Markup that is never closed is read as browsers read it:
a comment or script runs to the end, a paragraph ends where the next block begins, svg and math where a
tag follows that can't be theirs. Other elements that aren't shown end with the element around them at
the latest. A ``<`` that opens no tag is text. Rows with null ids or equal rows are pages like others. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose content is read as raw text up to their end tag, and never shown.
_RAW = "script|style|noscript|iframe|title|textarea"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b(?=[\s/>])(?P<open>[^>]*)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?/][^>]*>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
LEAF_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt hgroup figcaption".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is markup that isn't shown, or only in place of them.
HIDDEN_TAGS = frozenset("svg math template object canvas video audio select".split())
# Inside these, svg and math hold other markup again.
_MIXED_TAGS = frozenset("foreignobject desc annotation-xml mi mo mn ms mtext".split())
# Tags that end an open svg or math.
_BREAKOUT_TAGS = BLOCK_TAGS | frozenset("b big br code em embed i img meta nobr ruby s small span strong strike sub sup tt u var".split())
BAD_TAGS = frozenset("nav aside form footer button dialog menu label fieldset legend".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
# Parts of class names and ids.
BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notification "
    "pager pagination popup promo promoted promotion related replies reply respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
# What a class name or id may say besides, inside an article.
NEUTRAL_NAMES = frozenset(
    "area articles bar block body bottom box btn button buttons card cards container content form icons inner item items links list "
    "media module posts section slot stories top unit wrap wrapper".split()
)
GOOD_NAMES = frozenset("article articlebody content entry main post story text".split())
ALWAYS_BAD_NAMES = frozenset("comment comments commentlist disqus ad ads advert advertisement cookie cookies".split())

# Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has have he her his i in is it not of on or she that the their they this to was we were "
    "which with you "
    "aber als am auch auf aus bei das dem den der des die ein eine einem einen einer er es für hat ich im ist mit nach nicht "
    "oder sich sie sind um und von war wie wird zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et il ils la le les leur mais ne nous ou par pas plus pour que qui sa se "
    "ses son sur un une vous "
    "al como con del el ella los las lo más no para pero por se si sin su sus también y".split()
)

SHORT, LONG = 70, 200  # characters
MANY_STOPS, SOME_STOPS = 0.3, 0.15
LINKED = 0.5
_WORD = re.compile(r"\w+")


@dataclass(eq=False)
class Container:
    up: Container | None
    first: int  # blocks of the page before it
    end: int = sys.maxsize  # and up to its end


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    bad: bool
    inside: bool  # an article or main part
    heading: bool
    parent: Container


def _names(attrs: dict[str, str]) -> list[set[str]]:
    """The parts of each class name and id."""
    shown = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    return [set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", x).lower())) for x in shown]


def _only_bad(names: list[set[str]]) -> bool:
    """Whether a name is that of an advert, a cookie notice or comments, or says boilerplate and nothing else."""
    bad = BAD_NAMES - {"teaser"}
    return any(x & ALWAYS_BAD_NAMES or x & bad and x <= bad | NEUTRAL_NAMES for x in names)


def _judge(tag: str, source: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element is boilerplate by what it is called, and whether it is an article or main part."""
    attrs = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(source)} if source.strip(" /") else {}
    main = tag in ("article", "main") or attrs.get("role") in ("main", "article") or attrs.get("itemprop") == "articleBody"
    if tag in ("html", "body"):
        return False, main
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", ""))
    if hidden or tag in BAD_TAGS or attrs.get("role") in BAD_ROLES:
        return True, False
    if tag == "header" and not inside:
        return True, False
    every = _names(attrs)
    names = set().union(*every)
    if inside:
        return _only_bad(every), main and not _only_bad(every)
    if names & {"header"} and not names & GOOD_NAMES:
        return True, False
    bad = bool(names & ALWAYS_BAD_NAMES) or bool(names & BAD_NAMES and not names & GOOD_NAMES and not main)
    return bad, main and not bad


def blocks(page: str) -> list[Block]:
    found: list[Block] = []
    stack: list[tuple[str, bool, bool, Container]] = []  # tag, boilerplate, main part (each with what is above), container
    parts: list[str] = []
    linked, links, heading, page_container = 0, 0, False, Container(None, 0)
    hidden = at = 0  # open elements that aren't shown; place in the page

    def close() -> None:
        nonlocal linked, heading
        text = " ".join("".join(parts).split())
        if text:
            bad, inside, parent = stack[-1][1:] if stack else (False, False, page_container)
            found.append(Block(text, min(linked, len(text)), bad, inside, heading, parent))
        parts.clear()
        linked, heading = 0, False

    def leave(tag: str) -> None:
        nonlocal links, hidden
        while stack:
            gone, _, _, container = stack.pop()
            if container is not (stack[-1][3] if stack else page_container):
                container.end = len(found)
            links -= gone == "a"
            hidden -= gone in HIDDEN_TAGS
            if gone == tag:
                return

    while at < len(page):
        token = _TOKEN.match(page, at)
        at = token.end()
        if (text := token["text"]) is not None:
            if hidden:
                continue
            text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(" ".join(text.split()))
            continue
        if token["tag"] is None:
            if token["raw"] and hidden and token["open"].endswith("/") and _foreign(stack):
                at = token.end("open") + 1  # in svg and math '/>' closes every element
            elif token["raw"] and parts:
                parts.append(" ")
            continue
        tag = token["tag"].lower()
        if tag == "head":
            continue  # what its own elements don't hide belongs to the body, whether it is closed or not
        while hidden and tag in _BREAKOUT_TAGS and not token["end"] and (foreign := _foreign(stack)):
            leave(foreign)
        if tag in VOID_TAGS:
            if hidden:
                continue
            if tag == "hr":
                close()
            elif tag == "br":
                parts.append(" ")
            continue
        block = tag in BLOCK_TAGS
        if hidden and (not token["end"] or tag in _own_tags(stack)):
            # Inside an element that isn't shown nothing is cut or closed but what was opened there.
            if token["end"]:
                leave(tag)
            elif not token["attrs"].endswith("/"):
                stack.append((tag, *stack[-1][1:]))
                links += tag == "a"
                hidden += tag in HIDDEN_TAGS
            continue
        if block and (not hidden or any(x[0] == tag for x in stack)):
            close()
        if token["end"]:
            if any(x[0] == tag for x in stack):
                if not block and stack[-1][0] != tag and any(x[0] in BLOCK_TAGS for x in stack[_last(stack, tag) + 1 :]):
                    continue  # an inline end tag doesn't close blocks
                leave(tag)
            continue
        if block:
            # A new block ends an open paragraph, a new item or cell the one before.
            if any(x[0] == "p" for x in stack[_last_container(stack) + 1 :]):
                leave("p")
            if tag in ("li", "dd", "dt", "td", "th", "tr", "option") and stack and stack[-1][0] == tag:
                leave(tag)
        above_bad, above_main = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        if tag in HIDDEN_TAGS:
            if not token["attrs"].endswith("/"):
                stack.append((tag, above_bad, above_main, stack[-1][3] if stack else page_container))
                hidden += 1
            if parts:
                parts.append(" ")
            continue
        bad, main = _judge(tag, token["attrs"], above_main)
        if token["attrs"].endswith("/") and not block:
            continue
        if bad and not block:
            close()
        parent = stack[-1][3] if stack else page_container
        if block and tag not in LEAF_TAGS:
            parent = Container(parent, len(found))
        stack.append((tag, above_bad or bad, above_main or main, parent))
        links += tag == "a"
        heading = heading or (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())
    close()
    return found


def _foreign(stack: list[tuple[str, bool, bool, Container]]) -> str | None:
    """svg or math if the markup at this place is theirs."""
    tag = next((x[0] for x in reversed(stack) if x[0] in ("svg", "math") or x[0] in _MIXED_TAGS), None)
    return tag if tag in ("svg", "math") else None


def _own_tags(stack: list[tuple[str, bool, bool, Container]]) -> list[str]:
    """Open elements from the innermost one that isn't shown."""
    return [x[0] for x in stack[max(i for i, x in enumerate(stack) if x[0] in HIDDEN_TAGS) :]]


def _last(stack: list[tuple[str, bool, bool, Container]], tag: str) -> int:
    return max(i for i, x in enumerate(stack) if x[0] == tag)


def _last_container(stack: list[tuple[str, bool, bool, Container]]) -> int:
    """Place of the innermost block that isn't a paragraph."""
    return max((i for i, x in enumerate(stack) if x[0] in BLOCK_TAGS and x[0] != "p"), default=-1)


def _stop_density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def _first_pass(found: list[Block]) -> list[bool | None]:
    """True: text; False: boilerplate; None: not decided."""
    shown = sum(len(b.text) for b in found if not b.bad)
    marked = sum(len(b.text) for b in found if b.inside and not b.bad) * 4 >= shown > 0
    density = [0.0 if marked or b.bad or b.heading or len(b.text) < SHORT else _stop_density(b.text) for b in found]
    listed = any(x >= SOME_STOPS for x in density)
    out: list[bool | None] = []
    for b, stops in zip(found, density, strict=True):
        n = len(b.text)
        if b.bad or (marked and not b.inside) or b.linked > LINKED * n and (n >= SHORT or b.linked == n) and not b.heading:
            out.append(False)
        elif marked and n >= SHORT:
            out.append(True)
        elif n < SHORT or b.heading:
            out.append(None)
        elif not listed:
            out.append(True)
        else:
            out.append(True if stops >= MANY_STOPS or (n >= LONG and stops >= SOME_STOPS) else None if stops >= SOME_STOPS else False)
    if marked and not any(out):
        # An article of short blocks only: they decide each other.
        out = [True if b.inside and not b.bad and x is None else x for b, x in zip(found, out, strict=True)]
    if marked:
        # Nearest neighbours of a block inside the article are those inside it.
        out = [None if x is False and not b.inside else x for b, x in zip(found, out, strict=True)]
        return _second_pass([i for i, b in enumerate(found) if b.inside], out, found)
    return _second_pass(list(range(len(found))), out, found)


def _second_pass(some: list[int], out: list[bool | None], found: list[Block]) -> list[bool]:
    """Undecided blocks inherit from the nearest one decided by its own measures; blocks of ``found`` not numbered in ``some`` are boilerplate."""
    decided: dict[Container, list[int]] = defaultdict(list)  # places in some, by container
    every: list[int] = []
    labels = [out[k] for k in some]
    for i, k in enumerate(some):
        if labels[i] is not None and not found[k].bad:
            decided[found[k].parent].append(i)
            every.append(i)

    def around(i: int, container: Container) -> list[int]:
        """The decided blocks next to ``i`` in the innermost container that holds any."""
        if container in decided:
            return decided[container]
        at = bisect(every, i)
        near = every[max(at - 1, 0) : at + 1]
        while container.up is not None:
            if held := [x for x in near if container.first <= some[x] < container.end]:
                return held
            container = container.up
        return near

    done: dict[int, bool] = {}
    for i, k in enumerate(some):
        b = found[k]
        if labels[i] is not None:
            done[id(b)] = labels[i]
            continue
        near = around(i, b.parent)
        at = bisect(near, i)
        left, right = near[at - 1] if at else None, near[at] if at < len(near) else None
        if b.heading and right is not None:
            done[id(b)] = labels[right]
        elif left is not None and right is not None and labels[left] != labels[right]:
            sentence = b.text[-1] in ".!?…:" or _stop_density(b.text) >= MANY_STOPS
            done[id(b)] = sentence if i - left == right - i else labels[left if i - left < right - i else right]
        else:
            side = left if left is not None else right
            done[id(b)] = labels[side] if side is not None else _stop_density(b.text) >= SOME_STOPS
    return [done.get(id(b), False) for b in found]


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return " ".join(b.text for b, good in zip(found, _first_pass(found), strict=True) if good)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [main_text(page) for page in batch.column(2).to_pylist()]
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; n_chars counts code points."""
    base = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return base.mapInArrow(_extracted, "page_id bigint, url string, text string, n_chars bigint")
