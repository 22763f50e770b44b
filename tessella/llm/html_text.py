"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded down the tree.

A tolerant parser builds the tree of block elements (inline elements only mark text); scripts, styles, heads, form controls and other elements without
readable content are left out. Each block element gets features: subtree text, link and tag density, tokens of its and its ancestors' tag, class, id and role,
phrases of adverts and notices, how many of its siblings and children say the like (an article on cookies says it throughout, a notice once), whether it stands under a
heading of readers' comments, depth, and statistics of its siblings. Tokens of the page as a whole (on html, body, and containers around the article) say how
the page is laid out and not what the element is, so neither these elements nor those below them get them as features; words of a class name after `has`, `no`,
`with` and the like go as well. The trees give the probability that an element's subtree is article text. Decoding picks the likeliest labelling in which an
element is kept whole, dropped whole or mixed; below a whole element no descendant can say otherwise.

The model is fitted on TRAINING_PAGES pages made by a generator of common layouts (no labelled pages exist), the same at every input size.

Defined cases: null, empty and text-free pages give an empty text with 0 characters; white space is any Unicode white space; a line break tag is white space; character
references are decoded once; unclosed tags end with their parent; comments and markup left open run to the page's end; repeated rows and rows without page_id are rows of
their own; an empty table gives an empty result. Only page_id, url and html are read. Time grows with a page's length, times its depth at worst.
"""

from __future__ import annotations

import html as html_module
import random
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.boosting import BoostedTrees

TRAINING_PAGES = 1200
MIXED = 1.5  # log probability that a mixed element costs; the page itself, and a layout table around the article, cost none

NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)")
SPECIAL = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+")
TOKEN = re.compile(r"[a-z]+")
NAMING = frozenset(("class", "id", "role", "itemprop", "aria-label"))
#: Elements by how the parser treats them.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
UNREAD = frozenset("head script style template svg select textarea title button input embed canvas audio video iframe datalist dialog map annotation annotation-xml".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd maction semantics".split()
)
CLOSES = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option", "tbody": "thead tbody tr td th", "tfoot": "tbody tr td th"}
SCOPES = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "tbody": "table", "tfoot": "table", "option": "select"}
#: Tokens of tags, classes, ids and roles that speak for or against article text.
GOOD = frozenset("article main content post entry story body text maincontent articlebody".split())
BAD = frozenset(
    "nav menu header footer sidebar aside ad ads advert advertisement banner sponsor sponsored promo cookie consent notice popup modal overlay comment comments disqus reply replies "
    "respond share social related recommended widget form search login signup subscribe newsletter breadcrumb breadcrumbs pagination pager toolbar masthead navigation complementary contentinfo "
    "copyright legal disclaimer tags author bio meta skip alert gdpr".split()
)
GROUPS = (
    frozenset("nav menu navigation breadcrumb breadcrumbs pagination pager toolbar".split()),
    frozenset("header masthead footer contentinfo copyright legal disclaimer".split()),
    frozenset("aside sidebar related recommended widget complementary".split()),
    frozenset("ad ads advert advertisement banner sponsor sponsored promo".split()),
    frozenset("cookie consent notice popup modal overlay alert gdpr".split()),
    frozenset("comment comments disqus reply replies respond".split()),
    frozenset("form search login signup subscribe newsletter share social".split()),
)


#: Words of a class name after which the others tell what a page has or lacks.
STATES = frozenset("has have no not non with without is".split())
#: Phrases (in lower case) of notices of rights, of consent, of adverts and of appeals, in the languages of the pages.
PHRASES = (
    ("©", "copyright", "all rights reserved", "alle rechte vorbehalten", "tous droits réservés", "todos los derechos reservados"),
    ("cookie", "privacy policy", "terms of use", "terms of service", "datenschutz", "confidentialité", "privacidad"),
    ("advertisement", "sponsored", "buy now", "buy one", "buy yours", "order now", "order yours", "shop now", "free shipping", "limited offer", "special offer", "discount", "% off", "anzeige", "werbung", "publicité", "publicidad"),
    ("subscribe", "sign up", "newsletter", "share this", "follow us", "click here", "read more", "abonnez", "suscríbete", "abonnieren"),
    ("enable javascript", "requires javascript", "javascript is disabled", "activer javascript", "javascript aktivieren", "activar javascript", "active javascript"),
)
#: Words (in lower case) of the headings that readers' comments stand under.
THREADS = ("comment", "replies", "responses", "reactions", "kommentar", "antworten", "réponses", "comentario", "respuestas")
THREAD_WORDS = 6  # words of such a heading at most
#: Words that name the article's own element beyond doubt.
NAMED = frozenset("articlebody maincontent".split())
WHOLE = 0.6  # share of the page's text from which a container with a top heading is around the article
LARGE = 0.3  # the same for a container of the article's named element


def tags(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of every tag, comment and declaration (these without a name), each found in one pass.

    A tag ends at the first > outside quotes; if quotes are left open, at the first > at all. What a failing search has seen is not searched again.
    """
    size, at = len(source), 0
    last = source.rfind(">")
    seen_from, seen_to = 0, -1  # no sign of SPECIAL in between
    dead: set[int] = set()  # opening quotes from which no tag ends

    def special(p: int) -> int:
        nonlocal seen_from, seen_to
        if not seen_from <= p <= seen_to:
            found = SPECIAL.search(source, p)
            seen_from, seen_to = p, found.start() if found else size
        return seen_to

    def end_of(p: int) -> int:
        opened = []
        start = p
        while (p := special(p)) < size:
            if source[p] == ">":
                return p + 1
            opened.append(p)
            q = -1 if p in dead else source.find(source[p], p + 1)
            if q < 0:
                break
            p = q + 1
        dead.update(opened)
        return source.find(">", start) + 1

    while 0 <= (at := source.find("<", at)) <= last:
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            end = size if end < 0 else end + 3
            yield at, end, "", "", ""
        elif source.startswith("<![CDATA[", at):
            end = source.find("]]>", at)
            end = size if end < 0 else end + 3
            yield at, end, "", "", ""
        elif source[at + 1] in "!?":
            end = source.find(">", at) + 1
            yield at, end, "", "", ""
        elif m := NAME.match(source, at):
            end = end_of(m.end())
            yield at, end, m[1], m[2].lower(), source[m.end() : end - 1]
            if not m[1] and m[2].lower() in RAW:
                close = re.compile(rf"</{re.escape(m[2])}(?=[\s/>])", re.I).search(source, end)
                end = close.start() if close else size
        else:
            end = at + 1
        at = end
    if at >= 0 and source.startswith("<!--", at):  # a comment left open, no > after it
        yield at, size, "", "", ""


def role_tokens(values: list[str]) -> set[str]:
    """Words of class names and other names; those that say what a page has or lacks are left out."""
    out: set[str] = set()
    for name in " ".join(values).split():
        words = TOKEN.findall(name)
        cut = next((k for k, w in enumerate(words) if w in STATES), len(words))
        out.update(words[:cut])
    return out


PAGE = frozenset(("#page", "html", "body"))
TABLE = frozenset(("table", "tbody", "tr"))


class Page:
    """Block elements in page order (a parent before its children) and runs of text (element, text, of it in links)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.depth, self.tokens = ["#page"], [-1], [0], [frozenset()]
        self.runs: list[list] = []
        self.free = np.zeros(1, bool)  # elements that may be mixed at no cost, told by features()
        stack, links, at, fresh = [0], 0, 0, True
        skip: list[str] = []  # open elements of an unread subtree
        opened: Counter[str] = Counter()  # open elements by name, those of an unread subtree apart
        skipped: Counter[str] = Counter()

        def text(piece: str) -> None:
            nonlocal fresh
            if skip or not piece:
                return
            piece = html_module.unescape(piece)
            if fresh or self.runs[-1][0] != stack[-1]:
                self.runs.append([stack[-1], [], 0])
                fresh = False
            self.runs[-1][1].append(piece)
            if links:
                self.runs[-1][2] += len(piece)

        def pop_to(position: int) -> None:
            nonlocal fresh
            opened.subtract(self.tag[k] for k in stack[position:])
            del stack[position:]
            fresh = True

        def leave(name: str) -> None:
            while skipped[name]:
                gone = skip.pop()
                skipped[gone] -= 1
                if gone == name:
                    return

        for start, end, closing, name, rest in tags(source):
            text(source[at:start])
            at = end
            if not name:
                continue
            if closing:
                if skip:
                    leave(name)
                    continue
                if name == "a":
                    links = max(0, links - 1)
                elif opened[name] > 0:
                    pop_to(next(k for k in range(len(stack) - 1, 0, -1) if self.tag[stack[k]] == name))
                    links = 0
                continue
            if skip or name in UNREAD:
                if name == "body":  # a head left open
                    skip.clear(), skipped.clear()
                elif name not in VOID and not rest.rstrip().endswith("/"):
                    skip.append(name)
                    skipped[name] += 1
                    continue
                else:
                    continue
            if name == "br":
                text(" ")
            if name in INLINE:
                links += name == "a"
                continue
            if name in VOID:
                fresh = True
                continue
            if name in ("html", "body") and len(stack) < 3:
                fresh = True
            closes, limit = CLOSES.get(name, "").split(), SCOPES.get(name, "").split()
            if not closes and self.tag[stack[-1]] == "p":
                pop_to(len(stack) - 1)
            k = len(stack) - 1
            while k > 0 and any(opened[c] > 0 for c in closes) and self.tag[stack[k]] not in limit:
                if self.tag[stack[k]] in closes:
                    pop_to(k)
                k -= 1
            values, hidden = [], False
            for key, value in ATTRIBUTE.findall(rest):
                key, value = key.lower(), value.strip("\"'").lower()
                if key in NAMING:
                    values.append(value)
                hidden |= key == "hidden" or key == "style" and "display:none" in value.replace(" ", "")
            found = {name} | role_tokens(values)
            if hidden:
                skip.append(name)
                skipped[name] += 1
                continue
            self.tag.append(name), self.parent.append(stack[-1]), self.depth.append(len(stack)), self.tokens.append(frozenset(found))
            stack.append(len(self.tag) - 1)
            opened[name] += 1
            links, fresh = 0, True
        text(source[at:])
        self.texts = [" ".join("".join(r[1]).split()) for r in self.runs]

    def features(self) -> np.ndarray:
        """One row for each block element."""
        n = len(self.tag)
        parent = np.array(self.parent)
        own, own_links, runs, stops, words = (np.zeros(n) for _ in range(5))
        said = np.zeros((n, len(PHRASES)))
        for (node, _, linked), t in zip(self.runs, self.texts):
            own[node] += len(t)
            own_links[node] += min(linked, len(t))
            runs[node] += bool(t)
            stops[node] += t.count(". ") + t.count("! ") + t.count("? ") + t.endswith((".", "!", "?"))
            words[node] += t.count(" ") + bool(t)
            low = t.lower()
            said[node] += [sum(map(low.count, p)) for p in PHRASES]
        size, linked, blocks, marks, word, elements = own.copy(), own_links.copy(), runs.copy(), stops.copy(), words.copy(), np.ones(n)
        paragraphs = np.array([t == "p" for t in self.tag], float)
        for k in range(n - 1, 0, -1):
            p = parent[k]
            for column in (size, linked, blocks, marks, word, elements, paragraphs, said):
                column[p] += column[k]
        children = np.bincount(parent[1:], minlength=n).astype(float) if n > 1 else np.zeros(n)
        good, bad = np.zeros(n), np.zeros(n)
        group = np.zeros((n, len(GROUPS)))
        up_good, up_bad = np.zeros(n), np.zeros(n)
        around = self.around_article(size)
        self.free = np.array([t in PAGE or a and t in TABLE for t, a in zip(self.tag, around)])
        for k, tokens in enumerate(self.tokens):
            good[k], bad[k] = len(tokens & GOOD), len(tokens & BAD)
            if around[k]:
                bad[k] = 0
                good[k] *= self.tag[k] not in PAGE
            if bad[k]:
                group[k] = [bool(tokens & g) for g in GROUPS]
            p = parent[k]
            if p >= 0:
                up_good[k], up_bad[k] = up_good[p] + good[p], up_bad[p] + bad[p]
                group[k] = np.maximum(group[k], group[p])
        total, safe = max(1.0, size[0]), np.maximum(size, 1)
        up = np.maximum(parent, 0)
        order = np.zeros(n)
        seen = np.zeros(n)
        for k in range(1, n):
            order[k] = seen[parent[k]]
            seen[parent[k]] += 1
        heading = np.array([len(t) == 2 and t[0] == "h" and t[1].isdigit() for t in self.tag], float)
        listed = np.array([t in ("li", "ul", "ol", "dl", "dd", "dt") for t in self.tag], float)
        x = [
            np.log1p(size), size / total, linked / safe, size / np.maximum(1, elements), np.log1p(own), own_links / np.maximum(1, own), marks / np.maximum(1, word) * 10,
            np.log1p(word), np.log1p(blocks), np.log1p(paragraphs), np.array(self.depth, float), children, np.log1p(children[up]), order / np.maximum(1, children[up]),
            size / np.maximum(1, size[up]), size[up] / np.maximum(1, children[up]), good, bad, up_good, up_bad, heading, listed, (np.array(self.tag) == "p").astype(float), stops,
        ]
        # What the element stands among: its parent's share of the page, links, paragraphs, sentences, and a top heading beside it.
        headed = np.bincount(up[1:], np.array([t == "h1" for t in self.tag[1:]], float), minlength=n) if n > 1 else np.zeros(n)
        beside = [(size / total)[up], (linked / safe)[up], np.log1p(paragraphs[up]), (marks / np.maximum(1, word))[up] * 10, headed[up]]
        share = said / np.maximum(1, word)[:, None] * 10
        # A subject runs through the page: how many children, and how many siblings beside the element itself, say the same.
        says = (said > 0).astype(float)
        below = np.column_stack([np.bincount(up[1:], says[1:, g], minlength=n) for g in range(len(PHRASES))]) if n > 1 else np.zeros(said.shape)
        others = np.where(parent[:, None] >= 0, below[up] - says, 0)
        return np.column_stack([*x, *beside, group, share, np.minimum(said, 3), np.log1p(below), np.log1p(others), np.log1p(others[up]), self.under_thread()])

    def around_article(self, size: np.ndarray) -> np.ndarray:
        """Whether an element is html or body, holds LARGE of the page's text and the article's named element with at least half of its own, or a top heading and WHOLE of the page's text."""
        n = len(self.tag)
        clean = np.array([t in ("article", "main") or bool(k & NAMED) for t, k in zip(self.tag, self.tokens)]) & np.array([not k & BAD for k in self.tokens])
        heading = np.array([t == "h1" for t in self.tag])
        largest = np.zeros(n)  # text of the largest element below that is an article by its name
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            largest[p] = max(largest[p], size[k] if clean[k] else 0, largest[k])
            heading[p] |= heading[k]
        page = np.array([t in PAGE for t in self.tag])
        share = size / max(1, size[0])
        return page | ((share >= LARGE) & (2 * largest >= np.maximum(1, size))) | (heading & (share >= WHOLE))

    def under_thread(self) -> np.ndarray:
        """Whether an element is, follows among its siblings, or lies below such a heading of readers' comments, or holds one as its first child."""
        n = len(self.tag)
        headings = np.zeros(n, bool)
        for (node, _, _), t in zip(self.runs, self.texts):
            if len(self.tag[node]) == 2 and self.tag[node][0] == "h" and self.tag[node][1].isdigit() and self.tag[node] != "h1" and t.count(" ") < THREAD_WORDS:
                headings[node] |= any(w in t.lower() for w in THREADS)
        out, below = np.zeros(n), np.zeros(n, bool)  # below: a heading of comments was among the children so far
        first = np.zeros(n, bool)
        for k in range(1, n):
            p = self.parent[k]
            if not first[p]:
                first[p] = True
                if headings[k] and p and self.tag[p] not in PAGE:
                    out[p] = 1
            below[p] |= headings[k]
            out[k] = out[p] or below[p]
        return out

    def decode(self, log_odds: np.ndarray) -> list[str]:
        """Texts of the likeliest labelling: every element kept whole, dropped whole or mixed."""
        n = len(self.tag)
        keep, drop = -np.logaddexp(0, -log_odds), -np.logaddexp(0, log_odds)
        own_keep, own_drop = keep.copy(), drop.copy()
        mixed = np.full(n, -MIXED)
        mixed[np.flatnonzero(self.free)] = 0
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            keep[p] += keep[k]
            drop[p] += drop[k]
            mixed[p] += max(keep[k], drop[k], mixed[k])
        has = np.bincount(np.array(self.parent[1:], dtype=int), minlength=n) > 0 if n > 1 else np.zeros(n, bool)
        choice: list[int] = []  # 1 keep, 0 drop, 2 mixed
        for k in range(n):
            above = choice[self.parent[k]] if k else 2
            if k and above != 2:
                choice.append(above)
            elif has[k] and (k == 0 or mixed[k] > max(keep[k], drop[k])):
                choice.append(2)
            else:
                choice.append(int(keep[k] >= drop[k]))
        taken = [c == 1 or c == 2 and own_keep[k] > own_drop[k] for k, c in enumerate(choice)]
        return [t for (node, _, _), t in zip(self.runs, self.texts) if t and taken[node]]


def _words(rng: random.Random, low: int, high: int) -> str:
    letters = "abcdefghilmnoprstuv"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(low, high))]
    for k in range(len(made)):
        if rng.random() < 0.12:
            made[k] += rng.choice([",", ",", "."])
    text = " ".join(made)
    return (text.upper() + "!!" if rng.random() < 0.04 else text.capitalize()) + rng.choice([".", ".", ".", "!", "?", "", ":"])


def training_page(rng: random.Random) -> list[tuple[str, int]]:
    """Pieces (markup, label) of a made page: label 1 article, 0 surroundings, -1 containers of both."""
    link = lambda: f'<a href="/{rng.randint(1, 99)}">{_words(rng, 1, 3)}</a>'
    links = lambda tag="li": "".join(f"<{tag}>{link()}</{tag}>" for _ in range(rng.randint(2, 9)))
    out: list[tuple[str, int]] = [(f"<html><body{rng.choice(['', '', f' class={rng.choice(LAYOUTS)!r}'])}>", -1)]
    appeal = lambda group: f"{_words(rng, 1, 6)} {rng.choice(PHRASES[group])} {_words(rng, 1, 8)}"
    unmarked = lambda group: f"<{(t := rng.choice(['p', 'div', 'div']))}>{appeal(group)}</{t}>"

    # What the whole article speaks of, of one kind or several.
    subject = [said for kind in rng.sample(PHRASES, rng.choice([1, 2, 3])) for said in kind] if rng.random() < 0.4 else []

    def thread() -> str:
        """Readers' comments in elements without names."""
        tag, each = rng.choice(["div", "section", "ul", "ol"]), rng.choice(["div", "div", "p"])
        each = "li" if tag in ("ul", "ol") else each
        inner = lambda: _words(rng, 3, 60) if each == "p" else f"{rng.choice(['', f'<b>{_words(rng, 1, 2)}</b>', f'<p>{_words(rng, 1, 3)}</p>'])}<p>{_words(rng, 3, 60)}</p>"
        head = f"{rng.choice(['', '3 ', '12 ', 'Reader ', 'Leave a '])}{rng.choice(THREADS)}{rng.choice(['', 's', ' (4)'])}"
        head = f"<h{(h := rng.choice('2334'))}>{head.capitalize()}</h{h}>"
        made = "".join(f"<{each}>{inner()}</{each}>" for _ in range(rng.randint(1, 6)))
        return f"{head}<{tag}>{made}</{tag}>" if tag in ("ul", "ol") or rng.random() < 0.3 else f"<{tag}>{head}{made}</{tag}>"

    def outside(where: str) -> None:
        options = {
            "top": [
                lambda: f"<nav{rng.choice(['', ' class=menu', ' role=navigation'])}><ul>{links()}</ul></nav>",
                lambda: f"<header{rng.choice(['', ' class=masthead', ' id=top'])}><h1>{_words(rng, 1, 4)}</h1><p>{_words(rng, 2, 9)}</p></header>",
                lambda: f"<div class='{rng.choice(['ad', 'ads', 'advert', 'banner', 'sponsor', 'promo'])}'>{_words(rng, 2, 40)}</div>",
                lambda: f"<div id='{rng.choice(['cookie-notice', 'gdpr', 'consent', 'alert-banner', 'notice'])}'><p>{_words(rng, 6, 40)}</p><p>{link()}</p></div>",
                lambda: f"<div class='{rng.choice(['breadcrumbs', 'menu', 'toolbar', 'nav-bar'])}'>{link()} {link()} {link()}</div>",
                lambda: f"<form class=search><p>{_words(rng, 1, 5)}</p></form>",
                lambda: unmarked(rng.choice((1, 2, 3))),
                lambda: f"<noscript>{rng.choice(['<p>', ''])}{appeal(4)}</noscript>",
            ],
            "middle": [
                lambda: f"<div class='{rng.choice(['ad', 'ads', 'advertisement', 'sponsored', 'promo'])}'><p>{_words(rng, 2, 40)}</p></div>",
                lambda: f"<aside{rng.choice(['', ' class=related', ' class=pullout'])}><h3>{_words(rng, 1, 3)}</h3><ul>{links()}</ul></aside>",
                lambda: f"<div class='{rng.choice(['share', 'social', 'newsletter', 'subscribe'])}'><p>{_words(rng, 1, 12)}</p></div>",
                lambda: unmarked(2),
                lambda: unmarked(3),
            ],
            "end": [
                lambda: f"<footer{rng.choice(['', ' class=footer'])}>{rng.choice(['&copy; ', ''])}{_words(rng, 2, 30)}</footer>",
                lambda: f"<div class='{rng.choice(['footer', 'copyright', 'legal'])}'><p>{_words(rng, 3, 30)}</p></div>",
                lambda: f"<aside class='{rng.choice(['sidebar', 'widget', 'related'])}'><h3>{_words(rng, 1, 3)}</h3><p>{_words(rng, 3, 50)}</p><ul>{links()}</ul></aside>",
                lambda: f"<div id='{rng.choice(['sidebar', 'related', 'recommended'])}'><ul>{links()}</ul></div>",
                lambda: f"<{(t := rng.choice(['section', 'div']))} class='{rng.choice(['comments', 'comment-list', 'replies'])}'><h3>{_words(rng, 1, 3)}</h3>"
                + "".join(f"<div class=comment><p>{_words(rng, 4, 60)}</p></div>" for _ in range(rng.randint(1, 4))) + f"</{t}>",
                thread,
                thread,
                lambda: f"<noscript>{rng.choice(['<p>', ''])}{appeal(4)}</noscript>",
                lambda: f"<form class={rng.choice(['login', 'signup', 'respond'])}><p>{_words(rng, 1, 8)}</p></form>",
                lambda: f"<div class=pagination>{link()} {link()}</div>",
                lambda: unmarked(0),
                lambda: unmarked(rng.choice((1, 2, 3))),
            ],
        }[where]
        out.append((rng.choice(options)(), 0))

    def paragraph() -> None:
        text = _words(rng, 1, 120) if rng.random() < 0.9 else _words(rng, 1, 4)
        if rng.random() < 0.15:
            text += f" {link()} {_words(rng, 2, 20)}"
        if rng.random() < 0.05:  # an article may speak of such things
            text = f"{_words(rng, 15, 60)} {rng.choice(rng.choice(PHRASES))} {_words(rng, 15, 60)}"
        if subject and rng.random() < 0.8:
            said = rng.choice(subject)
            text = f"{_words(rng, 1, 50)} {said} {_words(rng, 1, 50)}" if rng.random() < 0.5 else f"{said.capitalize()} {_words(rng, 2, 50)}"
        if rng.random() < 0.15:
            text = f"<b>{text}<br>" if rng.random() < 0.5 else f"<b>{text}</b>"
        kind = rng.random()
        if kind < 0.78:
            out.append((f"<p>{text}</p>", 1))
        elif kind < 0.8:
            out.append((f"<noscript><p>{text}</p></noscript>", 1))
        elif kind < 0.86:
            out.append((f"<h2>{_words(rng, 1, 6)}</h2>", 1))
        elif kind < 0.91:
            out.append(("<ul>" + "".join(f"<li>{_words(rng, 2, 20)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>", 1))
        elif kind < 0.95:
            out.append((f"<blockquote><p>{text}</p></blockquote>", 1))
        else:
            out.append((f"<table><tr><td>{_words(rng, 1, 5)}</td><td>{_words(rng, 1, 5)}</td></tr></table>", 1))

    for _ in range(rng.randint(0, 3)):
        outside("top")
    wrap = rng.choice(["<article>", "<article>", "<article class=post>", "<main>", "<div id=content>", "<div class='entry-content'>", "<div class='article-body'>", "<section>", "<div>"])
    around = rng.choice(["", "", "<main>", "<div id=page>", "<div class=wrapper>", f"<div class={rng.choice(LAYOUTS)!r}>"])
    end = lambda t: f"</{re.match('<([a-z]+)', t)[1]}>" if t else ""
    table = rng.random() < 0.15  # the page is one table, a menu in the cell beside the article's
    if table:
        around, wrap = "<table>", "<td>"
    out.append((around, -1))
    if table:
        out.append(("<tr>", -1))
        cell = lambda: f"<td>{rng.choice(['<br>', ' ', '']).join(link() for _ in range(rng.randint(2, 9)))}</td>" if rng.random() < 0.6 else f"<td><ul>{links()}</ul></td>"
        if left := rng.random() < 0.7:
            out.append((cell(), 0))
    pure = rng.random() < 0.7
    out.append((wrap, 2 if pure else -1))
    if rng.random() < 0.8:
        out.append((f"<h1>{_words(rng, 1, 9)} {rng.choice(subject) if subject and rng.random() < 0.6 else ''}</h1>", 1))
    for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 14])):
        paragraph()
        if not pure and rng.random() < 0.2:
            outside("middle")
    out.append((end(wrap), -1))
    if table and (not left or rng.random() < 0.3):
        out.append((cell(), 0))
    if not table and rng.random() < 0.4:
        outside("end")
    if table and rng.random() < 0.5:
        tail = rng.choice([lambda: f"&copy; {_words(rng, 1, 6)}", lambda: appeal(rng.randrange(4)), lambda: f"{link()} {link()}"])
        out.append((f"<tr><td{rng.choice(['', ' colspan=2'])}>{tail()}</td></tr>", 0))
    out.append((end(around), -1))
    for _ in range(rng.randint(0, 4)):
        outside("end")
    return out


#: Class names of containers around the article that speak of its surroundings.
LAYOUTS = ("has-sidebar", "content-with-sidebar", "no-ads", "menu-open", "page-header", "social", "header-fixed", "without-comments", "widget-area-left")


@cache
def fitted_model() -> BoostedTrees:
    """The trees fitted on the made pages; labels come from the pieces, elements of both kinds are left out."""
    rng, xs, ys = random.Random(20240307), [], []
    for _ in range(TRAINING_PAGES):
        pieces = training_page(rng)
        labels: list[int] = []
        source = ""
        for markup, label in pieces:
            # The number of elements that a piece opens, counted by parsing the page up to it.
            source += markup
            labels.extend([label] * (len(Page(source).tag) - 1 - len(labels)))
        page = Page(source)
        x = page.features()[1:]
        y = np.array(labels)
        xs.append(x[y >= 0]), ys.append((y[y >= 0] > 0).astype(float))
    return BoostedTrees(rounds=90, depth=5, rate=0.2).fit(np.vstack(xs), np.concatenate(ys))


def main_text(source: str | None, model: BoostedTrees) -> str:
    """The article of one page: its blocks joined by an empty line."""
    return main_texts([source], model)[0]


def main_texts(sources: list[str | None], model: BoostedTrees) -> list[str]:
    """The articles of several pages; their elements are scored together."""
    pages = [Page(s) if s else None for s in sources]
    x = [p.features() for p in pages if p]
    odds = model.decision(np.vstack(x)) if x else np.empty(0)
    out, at = [], 0
    for p in pages:
        out.append("\n\n".join(p.decode(odds[at : at + len(p.tag)])) if p else "")
        at += len(p.tag) if p else 0
    return out


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(fitted_model())

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            found: list[str] = []
            sources = sources.tolist()
            for at in range(0, len(sources), 64):  # bounded feature tables
                found.extend(main_texts(sources[at : at + 64], shared.value))
            yield pd.Series(found, dtype=object)

    rows = pages.select("page_id", "url", text_of(F.col("html").cast("string")).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
