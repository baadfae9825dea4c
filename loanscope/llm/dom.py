"""Pages to trees of blocks: a lenient reading of HTML into block elements and runs of text, with binary features.

A node is a block-level element or a block, that is the text between two block boundaries, inline markup
aside.  Parents come before their children.  ``read_page`` goes over the markup once.
"""

from __future__ import annotations

import html
import re
from array import array
from dataclasses import dataclass, field
from functools import lru_cache

# Names of HTML elements by their kind.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
RAW = frozenset("script style textarea title xmp".split())  # their content is no markup, and goes to the end if unclosed
MUTE = frozenset("audio button canvas datalist iframe noscript object select svg template video".split())  # left out if closed
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# An element closes an open one of these names unless one of the others is open inside of it.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)),
           "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr"))}
WALLS = frozenset("td th table".split())  # an end tag does not reach beyond these, unless it is a table's own
TABLE = frozenset("table tbody td tfoot th thead tr".split())

# Words of class, id and role attributes by what they tell; the longer ones count as beginnings too.
NAMES = {
    "content": "article body content copy entry hentry main post postbody richtext story text",
    "menu": "breadcrumb breadcrumbs crumb crumbs dropdown links menu menubar nav navbar navigation pager pagination tabs toc",
    "header": "banner branding head header hero logo masthead site tagline top topbar",
    "footer": "bottom colophon contentinfo copyright credits disclaimer foot footer imprint legal",
    "side": "aside complementary more popular rail recommended related secondary sidebar teaser trending widget widgets",
    "advert": "ad ads adsbygoogle adslot advert advertisement advertising affiliate commercial partner promo promoted promotion sponsor sponsored",
    "comment": "comment commentlist comments commenttext discussion disqus feedback replies reply respond responses reviews thread",
    "notice": "alert alertdialog announcement banner consent cookie cookies dialog gdpr lightbox message modal notice notification overlay paywall popup privacy toast warning",
    "form": "contact form login newsletter register search searchbox signin signup subscribe subscription",
    "share": "facebook follow share sharing social tweet twitter whatsapp",
    "meta": "author byline date info meta metadata tag tags time timestamp",
    "hidden": "hidden invisible offscreen",
}
WORD_GROUP = {w: g for g, words in NAMES.items() for w in words.split()}
LONG_WORDS = tuple(sorted((w for w in WORD_GROUP if len(w) >= 6), key=len, reverse=True))
# Words of blocks that are seldom an article's.
SAID = re.compile(r"cookie|\bconsent\b|subscri|newsletter|sign (?:in|up)|log ?in\b|©|copyright|all rights reserved|advertis|sponsored|privacy policy|terms of|"
                  r"\bshare (?:this|on)|read more|\brepl(?:y|ies)\b|\bcomments?\b|click here|javascript|related (?:articles|posts|stories)", re.I)

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

KINDS = ("block", "heading", "paragraph", "item", "container", "aside")  # of nodes, for the potentials between parent and child
ASIDES = frozenset("aside dialog footer form header menu nav".split())
ITEMS = frozenset("dd dt figcaption li td th tr tbody caption".split())

TAGS = sorted(BLOCK)
# Tags that count for all below, by the name of what is under them.
TELLING = {t: f"<{t}>" for t in ("article", "aside", "blockquote", "footer", "form", "header", "li", "main", "nav", "table")}
SIZES = (0, 1, 25, 60, 120, 300, 1000)
SHARES = (0.0, 0.02, 0.1, 0.3, 0.6, 0.9)
FEATURES = {name: i for i, name in enumerate(
    ["element", "block"] + [f"tag {t}" for t in TAGS] + [f"name {g}" for g in NAMES] + [f"size {i}" for i in range(len(SIZES))]
    + [f"links {i}" for i in range(5)] + [f"share {i}" for i in range(len(SHARES))] + [f"paragraphs {i}" for i in range(4)]
    + [f"in {t}" for t in ("p", "h", "li", "td", "div", "other")] + [f"text {i}" for i in range(len(SIZES))] + [f"text links {i}" for i in range(5)]
    + [f"under {u}" for u in (*TELLING.values(), *NAMES)] + ["ends a sentence", "commas", "tells", "no lower case", "first block", "last block"]
    + [f"before {i}" for i in range(len(SIZES))] + [f"behind {i}" for i in range(len(SIZES))])}


def numbered(prefix: str, values) -> list[int]:
    return [FEATURES[f"{prefix} {v}"] for v in values]


F_TAG, F_NAME = {t: FEATURES[f"tag {t}"] for t in TAGS}, {g: FEATURES[f"name {g}"] for g in NAMES}
F_SIZE, F_TEXT, F_BEFORE, F_BEHIND = (numbered(p, range(len(SIZES))) for p in ("size", "text", "before", "behind"))
F_LINKS, F_TEXT_LINKS, F_SHARE, F_PARAGRAPHS = numbered("links", range(5)), numbered("text links", range(5)), numbered("share", range(len(SHARES))), numbered("paragraphs", range(4))
F_UNDER = {u: FEATURES[f"under {u}"] for u in (*TELLING.values(), *NAMES)}
F_IN = {t: FEATURES[f"in {t}"] for t in ("p", "h", "li", "td", "div", "other")}


@dataclass
class Page:
    """Nodes in the order of the page: ``parent`` (-1 at the root), ``depth``, ``kind``, features (``first`` into ``active``), texts of blocks by node."""
    parent: array = field(default_factory=lambda: array("i"))
    depth: array = field(default_factory=lambda: array("i"))
    kind: array = field(default_factory=lambda: array("b"))
    first: array = field(default_factory=lambda: array("l", [0]))
    active: array = field(default_factory=lambda: array("H"))
    blocks: list[tuple[int, str]] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)


def groups_of(names: str) -> set[str]:
    """What a class, id or role attribute tells."""
    found = set()
    for raw in NAME_WORD.findall(names):
        w = raw.lower()
        group = WORD_GROUP.get(w)
        if group is None and len(w) > 6:
            group = next((WORD_GROUP[x] for x in LONG_WORDS if w.startswith(x)), None)
        if group:
            found.add(group)
    return found


@lru_cache(maxsize=4096)
def attribute_groups(attributes: str) -> frozenset[str]:
    found = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and HIDES.search(value)):
            found.add("hidden")
        elif name in ("class", "id", "role"):
            found |= groups_of(value)
    return frozenset(found)


class Reader:
    """One pass over a page's markup."""

    def __init__(self, source: str):
        self.source = source
        self.parent, self.tag, self.names = [], [], []
        self.texts: dict[int, str] = {}
        self.link_chars: dict[int, int] = {}
        self.stack: list[int] = []  # open block elements
        self.open: dict[str, int] = {}
        self.said: list[str] = []  # of the block at hand
        self.linked: list[str] = []
        self.links = 0
        self.unclosed: set[str] = set()

    def node(self, tag: str, names: frozenset = frozenset()) -> int:
        self.parent.append(self.stack[-1] if self.stack else -1 if not self.parent else 0)
        self.tag.append(tag)
        self.names.append(names)
        return len(self.parent) - 1

    def end_block(self) -> None:
        if not self.said:
            return
        text = " ".join("".join(self.said).split())
        if text:
            n = self.node("")
            self.texts[n] = text
            self.link_chars[n] = min(len(text), len(" ".join("".join(self.linked).split())))
        self.said, self.linked = [], []

    def close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.open[self.tag[self.stack.pop()]] -= 1

    def start(self, tag: str, attributes: str) -> None:
        self.end_block()
        self.links = 0
        if self.stack and (self.tag[self.stack[-1]] == "p" or (tag in HEADING and self.tag[self.stack[-1]] in HEADING)):
            self.close_to(len(self.stack) - 1)
        if tag in IMPLIED:
            ends, walls = IMPLIED[tag]
            if any(self.open.get(t) for t in ends):
                for depth in range(len(self.stack) - 1, -1, -1):
                    t = self.tag[self.stack[depth]]
                    if t in ends:
                        self.close_to(depth)
                        break
                    if t in walls:
                        break
        if tag in ("html", "body") and self.open.get(tag):
            return
        n = self.node(tag, attribute_groups(attributes) if attributes else frozenset())
        if tag != "hr":
            self.stack.append(n)
            self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        self.end_block()
        self.links = 0
        if not self.open.get(tag) or tag in ("html", "body"):
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            t = self.tag[self.stack[depth]]
            if t == tag:
                self.close_to(depth)
                return
            if t in WALLS and tag not in TABLE:
                return

    def say(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.said.append(text)
        if self.links:
            self.linked.append(text)

    def skip(self, tag: str, at: int, to_end: bool) -> int:
        """Place behind the end tag of ``tag``; unclosed: the end of the page, or ``at``."""
        if tag in self.unclosed:
            return at
        found = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(self.source, at)
        if found:
            return found.end()
        if to_end:
            return len(self.source)
        self.unclosed.add(tag)
        return at

    def read(self) -> None:
        source, at, size = self.source, 0, len(self.source)
        self.stack.append(self.node("html"))
        self.open["html"] = 1
        while at < size:
            mark = source.find("<", at)
            if mark < 0:
                self.say(source[at:])
                break
            if mark > at:
                self.say(source[at:mark])
            follows = source[mark + 1:mark + 2]
            if follows == "!" or follows == "?":
                if source.startswith("<!--", mark):
                    stop = source.find("-->", mark + 2)
                    at = size if stop < 0 else stop + 3
                elif source.startswith("<![CDATA[", mark):
                    stop = source.find("]]>", mark)
                    at = size if stop < 0 else stop + 3
                else:
                    stop = source.find(">", mark)
                    at = size if stop < 0 else stop + 1
                continue
            found = TAG.match(source, mark)
            if found:
                slash, tag, attributes = found.groups()
                at = found.end()
            elif follows.isalpha() or (follows == "/" and source[mark + 2:mark + 3].isalpha()):
                # A quote that never ends: the tag ends at the next mark, or the page is cut in it.
                stop = source.find(">", mark)
                if stop < 0:
                    break
                inner = re.match(r"<(/?)([a-zA-Z][^\s/>]*)", source[mark:stop])
                slash, tag, attributes, at = inner[1], inner[2], "", stop + 1
            else:
                self.say("<")
                at = mark + 1
                continue
            tag = tag.lower()
            if tag in BLOCK:
                if slash:
                    self.end(tag)
                else:
                    self.start(tag, attributes)
            elif slash:
                if tag == "a":
                    self.links = max(0, self.links - 1)
            elif tag == "a":
                self.links = 1
            elif tag == "br":
                self.say(" ")
            elif tag in RAW:
                at = self.skip(tag, at, True)
            elif tag in MUTE and not attributes.endswith("/"):
                at = self.skip(tag, at, False)
                self.say(" ")
        self.end_block()


def bucket(value: float, bounds: tuple) -> int:
    n = 0
    for b in bounds:
        if value < b:
            break
        n += 1
    return n - 1


def density(links: int, size: int) -> int:
    if not links:
        return 0
    return 1 + bucket(links / size, (0, 0.25, 0.5, 0.9))


def read_page(source: str) -> Page:
    r = Reader(source)
    r.read()
    n = len(r.parent)
    size, links, paragraphs = [0] * n, [0] * n, [0] * n
    for i, text in r.texts.items():
        size[i], links[i] = len(text), r.link_chars[i]
    for i in range(n - 1, 0, -1):
        p = r.parent[i]
        size[p] += size[i]
        links[p] += links[i]
        paragraphs[p] += paragraphs[i] + (r.tag[i] == "p")
    whole = size[0] or 1
    order = sorted(r.texts)
    place = {b: i for i, b in enumerate(order)}
    page = Page()
    f = FEATURES
    under: list[frozenset] = [frozenset()] * n
    for i in range(n):
        tag = r.tag[i]
        if i:
            p = r.parent[i]
            own = r.names[p] | {TELLING[r.tag[p]]} if r.tag[p] in TELLING else r.names[p]
            under[i] = under[p] | own if own else under[p]
            if tag == "header" and "<article>" in under[i]:  # an article's own heading
                tag = r.tag[i] = "hgroup"
        if tag:
            active = [f["element"], F_TAG[tag], F_SIZE[bucket(size[i], SIZES)], F_LINKS[density(links[i], size[i])],
                      F_SHARE[bucket(size[i] / whole, SHARES)], F_PARAGRAPHS[bucket(paragraphs[i], (0, 1, 3, 10))]]
            active += [F_NAME[g] for g in r.names[i]]
            kind = 1 if tag in HEADING else 2 if tag == "p" else 3 if tag in ITEMS else 5 if tag in ASIDES else 4
        else:
            text, kind, k = r.texts[i], 0, place[i]
            above = r.tag[r.parent[i]]
            near = above if above in ("p", "li", "td", "div") else "h" if above in HEADING else "other"
            active = [f["block"], F_IN[near], F_TEXT[bucket(len(text), SIZES)], F_TEXT_LINKS[density(links[i], len(text))],
                      F_BEFORE[bucket(len(r.texts[order[k - 1]]), SIZES) if k else 0],
                      F_BEHIND[bucket(len(r.texts[order[k + 1]]), SIZES) if k + 1 < len(order) else 0]]
            if text[-1] in ".!?…。:;\"”»":
                active.append(f["ends a sentence"])
            if "," in text:
                active.append(f["commas"])
            if SAID.search(text):
                active.append(f["tells"])
            if text.upper() == text:
                active.append(f["no lower case"])
            if not k:
                active.append(f["first block"])
            if k + 1 == len(order):
                active.append(f["last block"])
            page.blocks.append((i, text))
        active += [F_UNDER[u] for u in under[i]]
        page.parent.append(r.parent[i])
        page.depth.append(page.depth[r.parent[i]] + 1 if i else 0)
        page.kind.append(kind)
        page.active.extend(active)
        page.first.append(len(page.active))
        page.tags.append(tag)
    return page
