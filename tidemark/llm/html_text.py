"""Main text of html pages: flat text blocks judged by a small decision tree.

A page is cut into text blocks at block-level tags. Each block is described by
its own and its neighbours' word counts and link densities, by how much prose
shares its container, by the run of link-only blocks it stands in, and by what
the elements around it claim to be; a decision tree, trained here on a small
labelled table of pages, keeps or drops it.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from random import Random
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import with_fields

FIELDS = "text string, n_chars long"

#: Fixed values of html: elements by role.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
RAW_TAGS = frozenset("script style title textarea iframe".split())  # no markup inside; they end at their end tag or with the page
DRAWN_TAGS = frozenset(("svg", "math"))  # may be closed by "/>", and end where html goes on
NESTED_TAGS = frozenset(("template", "object")) | DRAWN_TAGS  # hidden elements with markup inside
SIDE_TAGS = frozenset("nav aside footer menu dialog search button select fieldset".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("form header section div ul ol dl table blockquote figure details address".split()) | SIDE_TAGS | MAIN_TAGS
ITEMS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}  # items and their holders
PROSE_TAGS = frozenset("p blockquote pre".split())
HTML_TAGS = BLOCK_TAGS | frozenset(  # tags that end a drawing, unless one of its elements that hold html is open
    "b big br code em embed i img meta nobr ruby s small span strong strike sub sup tt u var".split()
)
HTML_HOLDERS = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
#: Words of class, id and role attributes that tell what a container is for.
SIDE_WORDS = frozenset(
    "ad ads adbox advert advertisement alert banner breadcrumb breadcrumbs byline comment commentlist comments complementary "
    "consent contentinfo cookie cookies copyright dialog disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice pagination popup privacy promo promoted recommended related replies reply respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar topbar warning widget".split()
)
NOTE_WORDS = frozenset("alert notice warning".split())  # in an article, these are part of it
MAIN_WORDS = frozenset("article content main post story entry body text".split())
LAYOUT_WORDS = MAIN_WORDS | frozenset(  # say nothing about what a part is for
    "area articles bar block bottom box button buttons col column container global group header headers inner item items left level "
    "link links list module outer page panel part posts primary right row secondary section site slot stories top unit wrap wrapper".split()
)
STATE_WORDS = frozenset("no non not without with has have hide hides".split())  # what they precede is another part, if any

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<[!?/][^>]*+>|<[!?/a-zA-Z][^>]*+\Z""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s*=\s*(?:"(?:hidden|)"|'(?:hidden|)'|hidden(?!\S)))?(?=\s|/|$)|style\s*=\s*(?:"[^"]*?\bdisplay\s*:\s*none\b|'[^']*?\bdisplay\s*:\s*none\b))""", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW_TAGS}
_NOSCRIPT = re.compile(r"<(/?)noscript\b[^>]*>", re.I)
_NESTED = re.compile(rf"<(?:{'|'.join(sorted(NESTED_TAGS))})\b", re.I)


class Block(NamedTuple):
    text: str
    start: int  # where its first character stands in the page
    words: int
    linked: int  # words inside links
    heading: bool
    place: int  # -1 in a side part, 1 in an article, 0 neither
    hint: bool  # some class name around it has a word of side parts among others
    form: bool  # inside a form
    prose: bool  # a paragraph, quotation or the like
    box: int  # number of the container it stands in


#: What an element says about its content, beside -1 side, 1 article and 0 nothing.
PAGE_HEADER, NOTE, HINT, FORM, HIDDEN = -2, -3, -4, -5, -6


def _role(name: str, attributes: str) -> int:
    """What an opened element says about its content."""
    if attributes and _HIDDEN.search(attributes):
        return HIDDEN
    if name in SIDE_TAGS:
        return -1
    if name in MAIN_TAGS:
        return 1
    names = [n for value in _ATTRIBUTE.findall(attributes) for n in value.lower().strip("\"'").split()] if attributes else []
    if any(n in SIDE_WORDS and n not in NOTE_WORDS for n in names):
        return -1
    main = any(n in MAIN_WORDS for n in names)
    said = {_name_role(n) for n in names}
    if not main and -1 in said:
        return -1
    if name == "form":
        return FORM
    if name == "header":
        return PAGE_HEADER  # of the page, unless it stands in an article
    if NOTE in said:
        return NOTE  # a side part, unless it stands in an article
    if main:
        return 1
    if HINT in said:
        return HINT
    return 1 if any(w in MAIN_WORDS for n in names for w in _WORD.findall(n)) else 0


def _name_role(name: str) -> int:
    """What a class name says: ad-top names a side part, social-science may, no-sidebar and has-share say nothing."""
    words = []
    for word in _WORD.findall(name):
        if word in STATE_WORDS:
            break
        words.append(word)
    side = [w for w in words if w in SIDE_WORDS]
    if not side:
        return 0
    if any(w not in SIDE_WORDS and w not in LAYOUT_WORDS for w in words):
        return HINT
    return NOTE if all(w in NOTE_WORDS for w in side) else -1


def _behind_raw(page: str, name: str, at: int) -> int:
    """Where the page goes on behind an element without markup whose start tag ends at ``at``."""
    if name == "noscript":  # has no other inside; one that is not closed hides nothing
        found = _NOSCRIPT.search(page, at)
        return found.end() if found and found[1] else at
    ended = _RAW_END[name].search(page, at)
    return ended.end() if ended else len(page)


def _nested_ends(page: str) -> dict[int, int]:
    """Where hidden elements with markup inside end, by the end of their start tags.

    An end tag belongs to the innermost open element of its name. A drawing also
    ends at a tag of html and with the container around it. Elements that end
    nowhere are not listed.
    """
    ends: dict[int, int] = {}
    if not _NESTED.search(page):
        return ends
    stack: list[tuple[str, int]] = []
    opened: Counter[str] = Counter()

    def leave() -> tuple[str, int]:
        top = stack.pop()
        opened[top[0]] -= 1
        return top

    at = 0
    while tag := _TAG.search(page, at):
        at = tag.end()
        name, closing = (tag[2] or tag[5] or "").lower(), bool(tag[1] or tag[4])
        empty = (tag[3] or tag[6] or "").endswith("/")
        if (name in HTML_TAGS and not closing) or (closing and name in ("p", "br")):
            while stack and stack[-1][0] in DRAWN_TAGS:
                ends[leave()[1]] = tag.start()
        if name in RAW_TAGS or name == "noscript":
            if not closing and not (empty and opened["svg"] + opened["math"]):
                at = _behind_raw(page, name, at)
        elif name in NESTED_TAGS or name in CONTAINERS or name in HTML_HOLDERS:
            if closing and opened[name]:
                while (top := leave())[0] != name:
                    if top[0] in DRAWN_TAGS:
                        ends[top[1]] = tag.start()
                if name in NESTED_TAGS:
                    ends[top[1]] = at
            elif not closing and not (empty and name in DRAWN_TAGS | HTML_HOLDERS):
                stack.append((name, at))
                opened[name] += 1
    return ends


def _leave_item(open_parts: list[tuple[str, int, int]], names: str, holders: tuple[str, ...]) -> None:
    """Closes the outermost open item of these names inside the innermost holder."""
    found = -1
    for depth in range(len(open_parts) - 1, -1, -1):
        part = open_parts[depth][0]
        if part in holders:
            break
        if part in names.split():
            found = depth
    if found >= 0:
        del open_parts[found:]


def text_blocks(page: str) -> list[Block]:
    """The page's text blocks in order, with character references decoded."""
    blocks: list[Block] = []
    open_parts: list[tuple[str, int, int]] = []  # containers, their roles and numbers, outermost first
    pieces: list[str] = []
    linked = in_link = heading = prose = own = boxes = 0
    first = -1
    ends = _nested_ends(page)

    def close() -> None:
        nonlocal linked, first
        words = "".join(pieces).split()
        roles = [role for _, role, _ in open_parts]
        roles.append(own)
        if words and HIDDEN not in roles:
            place = hint = form = 0
            for depth in range(len(roles) - 1, -1, -1):
                role = roles[depth]
                hint |= role == HINT
                form |= role == FORM
                if role in (PAGE_HEADER, NOTE):
                    place = 1 if 1 in roles[:depth] else -1
                elif role in (-1, 1):
                    place = role
                if place:
                    break
            box = next((number for part, _, number in reversed(open_parts) if part not in ITEMS), 0)
            blocks.append(
                Block(" ".join(words), first, len(words), min(linked, len(words)), bool(heading), place, bool(hint), bool(form), bool(prose), box)
            )
        pieces.clear()
        linked, first = 0, -1

    def add(text: str, at: int) -> None:
        nonlocal linked, first
        if text:
            text = unescape(text)
            if first < 0 and not text.isspace():
                first = at
            pieces.append(text)
            if in_link:
                linked += len(text.split())

    at = 0
    while tag := _TAG.search(page, at):
        add(page[at : tag.start()], at)
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing = bool(tag[1] or tag[4])
        if name in RAW_TAGS or name == "noscript":
            if not closing:
                at = _behind_raw(page, name, at)
            continue
        if name in NESTED_TAGS:
            if not closing:
                at = ends.get(at, at)
            continue
        if name == "a":
            in_link = 0 if closing else 1
        elif name == "br":
            pieces.append(" ")
        if name not in BLOCK_TAGS:
            continue
        close()
        in_link = own = 0
        heading = int(name in HEADINGS and not closing)
        prose = int(name in PROSE_TAGS and not closing)
        if name in CONTAINERS or name in ITEMS:
            holders = ITEMS.get(name, ())
            if not closing:
                if holders:  # ends an open item of the same holder
                    _leave_item(open_parts, "li" if name == "li" else "dt dd" if holders[0] == "dl" else "tr td th" if name == "tr" else "td th", holders)
                boxes += 1
                open_parts.append((name, _role(name, tag[3] or tag[6] or ""), boxes))
            elif holders:
                _leave_item(open_parts, name, holders)
            elif any(part == name for part, _, _ in open_parts):
                while open_parts.pop()[0] != name:
                    pass
        elif not closing:
            own = _role(name, tag[3] or tag[6] or "")
    add(page[at:], at)
    close()
    return blocks


#: Columns of a block's description.
FEATURES = (
    "words", "link density", "words before", "link density before", "words behind", "link density behind",
    "heading", "prose", "place", "hint", "prose in container", "run of links", "share of form",
)
SMALL_FORM = 0.1  # share of form that smaller ones are given, as 0 stands for none
LINK_ONLY = 0.9  # link density of a block that is a link
DOUBLINGS = 6  # of words that the tree tells apart; all longer blocks look alike to it


def _size(words: int) -> int:
    return min((words + 1).bit_length() - 1, DOUBLINGS)


def block_features(blocks: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block of a page.

    "prose in container" counts words outside links in the container it stands
    in, "run of links" the blocks around it that are links without a break,
    "share of form" the part of the page's words outside side parts that its
    forms hold (0 for a block in none). Words are told as doublings.
    """
    own = np.array([(_size(b.words), b.linked / b.words) for b in blocks], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    padded = np.vstack([edge, own, edge])
    prose: Counter[int] = Counter()
    for b in blocks:
        prose[b.box] += b.words - b.linked
    runs = np.zeros(len(blocks))
    start = 0
    for at in range(len(blocks) + 1):
        if at == len(blocks) or own[at, 1] < LINK_ONLY:
            runs[start:at] = at - start
            start = at + 1
    free = sum(b.words for b in blocks if b.place >= 0)
    share = max(sum(b.words for b in blocks if b.place >= 0 and b.form) / max(free, 1), SMALL_FORM)
    said = [(b.heading, b.prose, b.place, b.hint, _size(prose[b.box]), run, share * b.form) for b, run in zip(blocks, runs)]
    return np.hstack([own, padded[:-2], padded[2:], np.array(said, float).reshape(-1, 7)])


class DecisionTree:
    """Binary tree of thresholds, grown by Gini impurity; at ties the first feature wins."""

    def __init__(self, depth: int = 12) -> None:
        self.depth = depth

    def fit(self, x: np.ndarray, y: np.ndarray) -> DecisionTree:
        # Nodes: feature (-1 in a leaf), threshold, left, right, answer.
        self.nodes: list[list[float]] = []
        self._grow(x, y, self.depth)
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        number = len(self.nodes)
        self.nodes.append([-1, 0.0, 0, 0, float(2 * y.sum() >= len(y))])
        if depth and 0 < y.sum() < len(y):
            best = min(
                ((self._impurity(y[side := x[:, f] <= t], y[~side]), f, t) for f in range(x.shape[1]) for t in self._cuts(x[:, f])),
                default=None,
            )
            if best:
                _, feature, cut = best
                side = x[:, feature] <= cut
                self.nodes[number][:2] = [feature, float(cut)]
                self.nodes[number][2] = self._grow(x[side], y[side], depth - 1)
                self.nodes[number][3] = self._grow(x[~side], y[~side], depth - 1)
        return number

    @staticmethod
    def _cuts(values: np.ndarray) -> np.ndarray:
        found = np.unique(values)
        return (found[1:] + found[:-1]) / 2

    @staticmethod
    def _impurity(*sides: np.ndarray) -> float:
        return round(sum(s.sum() * (1 - s.mean()) for s in sides), 9)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            feature, cut, left, right, answer = self.nodes[node]
            if feature < 0:
                out[rows] = answer > 0
            elif len(rows):
                side = x[rows, int(feature)] <= cut
                todo += [(int(left), rows[side]), (int(right), rows[~side])]
        return out


def _prose(words: int) -> str:
    return "So " * (words - 1) + "on."


def _p(words: int, attributes: str = "") -> str:
    return f"<p{attributes}>{_prose(words)}</p>"


def _prose_div(words: int) -> str:
    return f"<div>{_prose(words)}</div>"


def _links(number: int, words: int = 1, inner: str = "li") -> str:
    return "".join(f'<{inner}><a href="/{i}">{"More " * words}</a></{inner}>' for i in range(number))


def labelled_pages(lengths: tuple[int, ...] = (16, 24, 40, 70, 120)) -> list[list[tuple[str, int]]]:
    """The labelled table: pages as lists of (fragment, whether its text is main text).

    Each make of page comes once for each length (words of a usual paragraph).
    Side parts may hold long prose, articles may hold menus, and many pages name
    no parts at all, so that no single feature tells all blocks.
    """
    pages = []
    random = Random(len(lengths))
    for n in lengths:
        menu, shop = f"<ul>{_links(4 + n % 5)}</ul>", "<div><a href='/s'>" + "Offer " * n + "</a></div>"
        short, few = _p(3), f"<p>See <a href='/x'>the other report</a> {'and more ' * 4}</p>"
        says, cells = "<p>Yes.</p><p>Who was that?</p>", "<table><tr><td>one<td>two three<tr><td>four</table>"
        linked = f"<p>{_prose(n // 2)} <a href='/l'>{'as told ' * (n // 8 + 1)}</a> {_prose(5)}</p>"
        teasers = "".join(f"<div><a href='/{i}'>{'News ' * (3 + i)}</a> {'of today ' * (2 + (n + i) % 3)}</div>" for i in range(3))
        rough = "".join(random.choice((_p, _prose_div))(random.choice((1, 2, 3, 5, 8, 13, n, 2 * n))) for _ in range(12))
        plain = "".join(_p(random.choice((1, 2, 3, 5, 8, 13, n, 2 * n))) for _ in range(12))
        pages += [
            # Texts of parts of all lengths.
            [(f"<nav>{menu}</nav><div class='ad'>{_prose(n // 2)}</div>", 0), (f"<article><h1>{_prose(n // 8 + 1)}</h1>{rough}</article>", 1), (f"<footer>{_prose(n // 3)}</footer>", 0)],
            [(f"<header>{menu}</header>", 0), (f"<main>{plain}<h2>Then</h2>{rough}</main>", 1), (f"<aside>{rough}</aside><footer>{plain}</footer>", 0)],
            [(f"<div>{menu}</div>", 0), (f"<div>{plain}{_p(n)}{plain}</div>", 1), (teasers, 0)],
            *(
                [(f"<nav>{menu}</nav>", 0), (f"<article><h1>{_prose(k)}</h1>{_p(random.randint(1, 2 * k))}</article>", 1), (f"<footer>{_prose(n // 2)}</footer>", 0)]
                for k in range(1, 12)
            ),
            [(f"<nav>{menu}</nav>", 0), (f"<article><h1>Eggs</h1>{_p(n)}<h2>Sources</h2><ul>{_links(3, 3)}</ul>{_p(n)}<p>Also:</p>{_links(1, 2, 'p')}</article>", 1)],
            # Nothing stands behind the text.
            [(f"<nav>{menu}</nav>", 0), (f"<article>{_p(n)}{few}{short}{short}</article>", 1)],
            *([(f"<main>{_p(k)}{_p(n)}{_p(k)}</main>", 1)] for k in range(1, 9)),
            *([(f"<div>{menu}</div>", 0), (f"<div>{_p(n)}{_p(2 * n)}{_p(k)}</div>", 1)] for k in range(1, 9)),
            # Named parts.
            [(f"<nav>{menu}</nav><div class='ad'>Buy our new shoes now.</div>", 0), ("<article><h1>A day in the hills</h1>", 1), (_p(n) + short + few + says, 1),
             ("<ul><li>bread<li>salt and oil</ul></article>", 1), ("<footer>&copy; example.net, all rights reserved by its owner</footer>", 0)],
            [("<header><h1>The Daily Paper</h1><p>News for all of us, every day of the week</p></header>", 0), (f"<div class='cookie-notice'>{_p(n)}</div>", 0),
             (f"<main><h2>What we saw</h2>{_p(n)}<blockquote>Short words.</blockquote>{cells}", 1), (f"<aside><h3>Related</h3>{_p(n)}</aside>", 0),
             ("<p>Last words of it.</p>", 1), (f"<section id='comments'><h3>Comments</h3><p>Thank you.</p>{_p(2 * n)}</section></main>", 0),
             ("<form><label>Your name</label><button>Send</button></form>", 0)],
            [(f"<article><header><h1>Title in its own header</h1></header>{_p(n)}", 1), (f"<p class='advert'>{_prose(n)}</p>", 0), (short, 1),
             ("<ul><li class='share'>Tell your friends of it</li></ul>", 0), (_p(n // 2), 1), (f"<div class='newsletter-box'>{_p(n)}</div>", 0),
             ("<footer>Written by someone on a fine day</footer></article>", 0), (f"<div role='complementary'>{_p(n)}</div>", 0)],
            [(f"<div class='notice'>{_p(3 * n)}{_p(n)}</div>", 0), (f"<main>{_p(2 * n)}<div class='warning'>{_p(n // 2)}{short}</div></main>", 1),
             (f"<ol class='commentlist'><li>{_prose(n)}<li>{_prose(2 * n)}<li>Thanks.</ol>", 0), (f"<form>{_p(n)}</form>", 0), (f"<div class='promo'>{_prose(3 * n)}</div>", 0)],
            [(_p(n) + short + _p(2 * n), 1), (f"<div class='widget'>{_p(n)}</div><footer>{_p(n)}</footer>", 0)],
            # Articles that hold menus, links and class names with a word of side parts.
            [(f"<main>{menu}", 0), (f"<h1>The work</h1>{_p(n)}{short}", 1), (f"<div>{_links(6, 2, 'p')}</div></main>", 0)],
            [(f"<article>{_p(n)}<p><a href='/5'>The whole report as a file</a></p>{_p(n)}<ul>{_links(2, 2)}</ul>", 1), (_p(4) + "<p><a href='/9'>More</a> of it</p></article>", 1)],
            [(f"<article><div class='social-science'><h2>Fields</h2>{_p(n)}{short}</div><section class='related-work'>{_p(n)}{few}</section></article>", 1),
             (f"<div class='related-posts'><ul>{_links(3, 4)}</ul></div>", 0)],
            [(f"<div class='share-price'>{_p(n)}{short}</div>", 1), (f"<div class='popup-made-here'><ul>{_links(4, 3)}</ul></div>", 0), (_p(n), 1)],
            [(f"<article>{_p(n)}", 1), (f"<div class='promoted-reading'>{_links(2, 3, 'p')}</div>", 0), (f"{_p(n)}<p><a href='/d'>The figures</a></p></article>", 1)],
            # Pages that name no parts.
            [(f"<div>{menu}</div>", 0), (f"<div><h1>Plain page</h1>{_p(n)}{short}{says}{_p(2 * n)}{short}</div>", 1), (shop, 0), ("<div>Terms</div><div>Imprint</div>", 0)],
            [(f"<div><a href='/a'>Start</a> <a href='/b'>Shop</a> <a href='/c'>Contact</a></div>{shop}", 0), (f"<div>{_prose(n)}</div><div>{_prose(2 * n)}</div>", 1),
             (shop + shop, 0), (f"<div>{_prose(n)}</div>", 1), ("<div>Posted in <a href='/t'>topics</a>, <a href='/u'>people</a></div>", 0)],
            [("<div>Sign in</div><div>Join</div>", 0), (f"{_p(n)}{says}<h2>Then</h2>{_p(n)}<ul><li>some milk and flour<li>a pinch of salt<li>two eggs</ul>{_p(n)}", 1),
             ("<p><a href='/3'>Next page of this long list</a></p>", 0), ("<div><a href='/4'>Top</a></div>", 0)],
            [(f"<table><tr><td>{_links(5, 1, 'p')}<td>", 0), (f"<h1>Old page</h1>{_p(n)}{short}{few}", 1), (f"<td><h3>Elsewhere</h3><ul>{_links(5, 3)}</ul></table>", 0)],
            [(f"<div><h3>Read on</h3>{_links(3, 5, 'div')}</div>", 0), (f"<div><h2>The road</h2>{_p(n)}{says}{_p(n)}</div>", 1), ("<ul><li>Imprint<li>Press<li>Jobs</ul>", 0)],
            [("<div>Free delivery on all orders of this week only</div>", 0), (f"<div><h1>The lake</h1>{_p(n)}{linked}{short}{_p(n)}", 1),
             ("<p>Tagged <a href='/t'>water</a>, <a href='/u'>hills and woods</a></p><p><a href='/n'>Read the next story here</a></p></div>", 0),
             (f"<ul>{'<li>Privacy rules<li>Press room' * (1 + n % 4)}</ul>", 0)],
            [(teasers, 0), (f"<div>{_p(n)}{says}{linked}{_p(2 * n)}{few}</div>", 1), (teasers, 0), ("<div><p>All rights reserved by the owner of this page.</p></div>", 0)],
            [("<div>Monday, the first of May</div><div>Rain later on</div>", 0), (f"<div><h2>Bread</h2>{_p(n)}<ol><li>mix it<li>wait for it<li>bake it</ol>{short}</div>", 1),
             ("<div>Call us on weekdays from nine to five</div><div>Imprint</div>", 0)],
            [("<div><a href='/h'>Home</a></div>", 0), (f"<div>{_p(n)}{linked}</div>", 1), (teasers, 0)],
            # Forms: one around the page, one beside it, one that is all there is.
            [(f"<form><div>{menu}</div>", 0), (f"<div><h1>In a form</h1>{_p(n)}{says}{_p(2 * n)}</div>", 1), ("<div>Search</div><div>Go</div></form>", 0)],
            [(f"<form>{_p(n)}{short}{_p(n)}{_p(n)}</form>", 1), ("<footer>The end</footer>", 0)],
            [(f"<div>{_p(n)}{_p(2 * n)}{_p(n)}</div>", 1), ("<form><p>Leave your address here and we write.</p><div>Name</div><p>Mail</p></form>", 0)],
            [(f"<article>{plain}{rough}", 1), ("<form><label>Your name</label><div>Mail</div><p>Then send it</p></form>", 0), (f"{rough}</article>", 1)],
            [("<form><div>Name</div><div>Password</div><label>Stay</label></form>", 0)],
            [("<p>Very little.</p>", 1)],
        ]
    return pages


LABELLED = labelled_pages()


def trained_tree(labelled: list[list[tuple[str, int]]] = LABELLED) -> DecisionTree:
    x, y = [], []
    for page in labelled:
        starts = np.cumsum([0, *(len(part) for part, _ in page)])
        blocks = text_blocks("".join(part for part, _ in page))
        x.append(block_features(blocks))
        y += [page[int(np.searchsorted(starts, b.start, side="right")) - 1][1] for b in blocks]
    return DecisionTree().fit(np.vstack(x), np.array(y, float))


def main_text(page: str | None, tree: DecisionTree) -> str:
    blocks = text_blocks(page) if page else []
    if not blocks:
        return ""
    kept = tree.predict(block_features(blocks))
    return "\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract_text(df: DataFrame, html: str = "html") -> DataFrame:
    """``df`` with ``text`` (main text) and ``n_chars`` (its code points).

    A null or empty page and one without main text give an empty text; an empty
    table gives no rows, repeated rows are kept. Pages are read one by one, whole
    and alike, at any length; broken markup is read as far as it goes:
    unclosed elements end with the page, but an unclosed noscript, object or
    template hides nothing, and an unclosed drawing (svg, math) ends where html
    goes on. Input columns named text or n_chars are replaced.
    """
    schema = T._parse_datatype_string(FIELDS)
    tree = trained_tree()

    @F.pandas_udf(schema)
    def extract(pages: pd.Series) -> pd.DataFrame:
        texts = [main_text(page, tree) for page in pages]
        return pd.DataFrame({"text": pd.Series(texts, dtype=object), "n_chars": [len(t) for t in texts]})

    return with_fields(df, extract(F.col(f"`{html}`")), schema.names)
