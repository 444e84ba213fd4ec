"""A small tree of an HTML page's block elements, and features of its nodes."""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np

_NAME = r"[a-zA-Z][^\s/>]*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?/](?![a-zA-Z])[^>]*+(?:>|\Z)"
    rf"|</(?P<end>{_NAME})[^>]*+(?:>|\Z)"
    rf"|<(?P<start>{_NAME})(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    rf"|<(?P<start2>{_NAME})(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRS = re.compile(r"([a-zA-Z_:][-\w:.]*+)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Text up to the end tag, or the page's end without one.
RAW = frozenset("script style noscript iframe textarea title".split())
#: Read on like any element and left out with all inside. Without an end tag, only the text outside inner blocks goes.
EXCLUDED = frozenset("template svg object select canvas audio video button datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var nobr img wbr input math mi mn mo mtext mrow msup msub mfrac msqrt".split()
)
#: What a start tag closes when it is open above it, up to the next element named after it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = frozenset("table td th body html button caption".split())

TAGS = "html body div section article main p h1 h2 h3 h4 ul ol li dl dt dd table tr td th blockquote pre figure figcaption nav header footer aside form fieldset address details center".split()
TAG_PLACE = {t: i for i, t in enumerate(TAGS)}
REGIONS = "nav header footer aside form article main li table figure".split()
REGION_PLACE = {t: i for i, t in enumerate(REGIONS)}


def _raw_end(source: str, name: str, at: int) -> int:
    """Where the page goes on after a raw element's end tag in either case."""
    while (at := source.find("</", at)) >= 0:
        stop = at + 2 + len(name)
        if source[at + 2 : stop].lower() == name and source[stop : stop + 1] in "\t\n\f\r />":
            gt = source.find(">", stop)
            return gt + 1 if gt >= 0 else len(source)
        at += 2
    return len(source)


class _Open(list):
    """The open elements as (name, node), and how many there are of each name."""

    def __init__(self, items: list[tuple[str, int]]) -> None:
        super().__init__(items)
        self.many = Counter(name for name, _ in items)

    def append(self, item: tuple[str, int]) -> None:
        self.many[item[0]] += 1
        super().append(item)

    def __setitem__(self, i: int, item: tuple[str, int]) -> None:
        self.many[self[i][0]] -= 1
        self.many[item[0]] += 1
        super().__setitem__(i, item)

    def __delitem__(self, i: int | slice) -> None:
        for name, _ in self[i] if isinstance(i, slice) else [self[i]]:
            self.many[name] -= 1
        super().__delitem__(i)


class Page:
    """Block elements in page order and runs of text.

    Node 0 is the page itself. A run is the text between two block boundaries and belongs to the block it
    stands in; white space is one space and character references are decoded.
    """

    __slots__ = ("parent", "tag", "tokens", "runs", "links")

    def __init__(self, source: str) -> None:
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["html"]
        self.tokens: list[tuple[str, ...]] = [()]
        self.runs: list[tuple[int, str]] = []
        self.links: list[int] = []
        self._read(source)

    def _read(self, source: str) -> None:
        parent, tag, tokens = self.parent, self.tag, self.tokens
        stack = _Open([("html", 0)])  # open elements; inline ones have their block's node
        parts: list[str] = []
        linked = link_depth = 0
        at, size = 0, len(source)
        # open excluded elements: place in the stack and what had been read before them
        marks: list[tuple[int, list[str], int, int, int, int]] = []

        def flush() -> None:
            nonlocal linked, parts
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    self.runs.append((stack[-1][1], text))
                    self.links.append(min(linked, len(text)))
                parts = []  # a new list, as marks hold the old one
            linked = 0

        def pop(n: int) -> None:
            nonlocal link_depth
            link_depth -= sum(1 for name, _ in stack[n:] if name == "a")
            del stack[n:]
            while marks and marks[-1][0] >= n:
                marks.pop()

        def silent() -> bool:
            """Whether text here stands in an excluded element and in no block inside it."""
            return bool(marks) and next((name in EXCLUDED for name, _ in reversed(stack) if name in EXCLUDED or name in TAG_PLACE), False)

        while at < size:
            lt = source.find("<", at)
            if lt < 0:
                lt = size
            if lt > at:
                text = source[at:lt]
                if not silent():
                    parts.append(text)
                    if link_depth > 0:
                        linked += len(text)
                at = lt
                continue
            found = _TOKEN.match(source, at)
            if found is None:  # a lone "<"
                if not silent():
                    parts.append("<")
                at += 1
                continue
            at = found.end()
            end = found["end"]
            if end:
                name = end.lower()
                if not stack.many[name] and name != "br":
                    # nothing to end; without a look at the stack, as a page may have any number of these
                    if name in TAG_PLACE and name not in INLINE and name not in EXCLUDED and not (name == "p" and any(stack.many[s] > (s == "html") for s in SCOPE)):
                        flush()
                elif name in INLINE:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == name:
                            if name == "a":
                                link_depth -= 1
                            del stack[i]  # marks lie below: only inline elements are above i
                            break
                        if stack[i][0] not in INLINE:
                            break
                elif name == "br":
                    parts.append(" ")
                elif name in EXCLUDED:
                    while any(stack[m[0]][0] == name for m in marks):
                        place, before, n_parts, linked_, n_nodes, n_runs = marks[-1]
                        own = stack[place][0] == name
                        pop(place)
                        if own:  # as if nothing had been read since
                            parts, linked = before, linked_
                            del parts[n_parts:], parent[n_nodes:], tag[n_nodes:], tokens[n_nodes:], self.runs[n_runs:], self.links[n_runs:]
                            break
                else:
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i][0] == name:
                            flush()
                            pop(i)
                            break
                        if name == "p" and stack[i][0] in SCOPE:
                            break
                    else:
                        if name in TAG_PLACE:
                            flush()
                continue
            name = found["start"] or found["start2"]
            if not name:
                continue
            name = name.lower()
            if name == "br":
                parts.append(" ")
                continue
            if name in INLINE:
                if name not in VOID:
                    if name == "a":
                        link_depth += 1
                    stack.append((name, stack[-1][1]))
                continue
            attrs = found["attrs"] if found["start"] else found["attrs2"]
            if name in RAW:
                if not attrs.endswith("/"):
                    at = _raw_end(source, name, at)
                continue
            if name in EXCLUDED:
                if name == "button" or name == "select":
                    parts.append(" ")
                    for m in [m for m in marks if stack[m[0]][0] == name]:  # neither holds another: the open one lacks its end
                        stack[m[0]] = ("", stack[m[0]][1])
                        marks.remove(m)
                if not attrs.endswith("/"):
                    marks.append((len(stack), parts, len(parts), linked, len(tag), len(self.runs)))
                    stack.append((name, stack[-1][1]))
                continue
            if marks and name not in TAG_PLACE and silent():
                if name not in VOID and not attrs.endswith("/"):
                    stack.append((name, stack[-1][1]))
                continue
            flush()
            if name in VOID:
                continue
            if name == "html" or name == "body" and stack.many["body"]:
                continue
            if name in CLOSES:
                closed, until = CLOSES[name]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in closed:
                        pop(i)
                        if name != "tr" or stack[-1][0] not in closed:
                            break
                    elif stack[i][0] in until:
                        break
            else:
                for i in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                    if stack[i][0] == "p":
                        pop(i)
                        break
                    if stack[i][0] not in INLINE:
                        break
            parent.append(stack[-1][1])
            tag.append(name)
            tokens.append(_tokens(attrs) if attrs and not attrs.isspace() else ())
            stack.append((name, len(tag) - 1))
        flush()


def _tokens(attrs: str) -> tuple[str, ...]:
    """Lower-case words of the attributes that name or hide an element."""
    out = []
    for name, a, b, c in _ATTRS.findall(attrs):
        name = name.lower()
        if name in ("class", "id", "role", "itemprop", "aria-label", "data-role", "name", "itemtype"):
            out += [w.lower() for w in _WORDS.findall(a or b or c)]
        elif name == "hidden" or name == "aria-hidden" and (a or b or c) == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a or b or c):
            out.append("hidden")
    return tuple(dict.fromkeys(out))


NUMERIC = [
    "depth", "children", "place", "siblings", "chars", "own_chars", "share", "begins", "link_share", "own_link_share", "blocks_per_char", "words_per_run",
    "stops_per_word", "same_siblings", "sibling_chars", "sibling_link_share", "parent_share", "parent_link_share", "longest_run", "runs",
]
FIXED = len(NUMERIC) + len(TAGS) + len(REGIONS)


def features(page: Page, vocabulary: dict[str, int]) -> np.ndarray:
    """A row per node: numbers, own tag, regions it stands in, and tokens (2: its own, 1: an ancestor's)."""
    n = len(page.tag)
    parent = page.parent
    x = np.zeros((n, FIXED + len(vocabulary)), dtype=np.float32)
    own, own_links, runs, words_, stops, longest = ([0.0] * n for _ in range(6))
    begins = [0.0] * n
    seen = 0.0
    met = [False] * n
    for (node, text), linked in zip(page.runs, page.links):
        size = len(text)
        own[node] += size
        own_links[node] += linked
        runs[node] += 1
        words_[node] += text.count(" ") + 1
        stops[node] += text.count(".") + text.count(",")
        longest[node] = max(longest[node], size)
        up = node
        while up >= 0 and not met[up]:
            met[up], begins[up] = True, seen
            up = parent[up]
        seen += size
    chars, links, blocks, children, place = own[:], own_links[:], [1.0] * n, [0] * n, [0] * n
    for i in range(1, n):
        place[i] = children[parent[i]]
        children[parent[i]] += 1
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        blocks[p] += blocks[i]
        runs[p] += runs[i]
        words_[p] += words_[i]
        stops[p] += stops[i]
        if longest[i] > longest[p]:
            longest[p] = longest[i]
    depth, inherits = [0] * n, [False] * n
    at_tag, at_region = len(NUMERIC), len(NUMERIC) + len(TAGS)
    for i in range(n):
        row = x[i]
        p = parent[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            if inherits[p]:
                np.minimum(x[p, at_region:], 1, out=row[at_region:])
                inherits[i] = True
        t = TAG_PLACE.get(page.tag[i])
        if t is not None:
            row[at_tag + t] = 1
            r = REGION_PLACE.get(page.tag[i])
            if r is not None:
                row[at_region + r], inherits[i] = 2, True
        for token in page.tokens[i]:
            k = vocabulary.get(token)
            if k is not None:
                row[FIXED + k], inherits[i] = 2, True
    chars_, links_, parents = np.array(chars), np.array(links), np.maximum(np.array(parent), 0)
    own_, total = np.array(own), max(1.0, chars[0])
    siblings = np.array(children, dtype=float)[parents]
    codes = np.array([TAG_PLACE.get(t, -1) for t in page.tag])
    pair = parents * (len(TAGS) + 1) + codes
    _, inverse, many = np.unique(pair, return_inverse=True, return_counts=True)
    same = many[inverse]
    per = np.bincount(inverse, weights=chars_) / many
    per_links = np.bincount(inverse, weights=links_) / np.maximum(np.bincount(inverse, weights=chars_), 1)
    x[:, : len(NUMERIC)] = np.stack([
        depth, children, place, siblings, np.log1p(chars_), np.log1p(own_), chars_ / total, np.array(begins) / total, links_ / np.maximum(chars_, 1),
        np.array(own_links) / np.maximum(own_, 1), np.array(blocks) / np.maximum(chars_, 1), np.array(words_) / np.maximum(np.array(runs), 1), np.array(stops) / np.maximum(np.array(words_), 1),
        same, np.log1p(per[inverse]), per_links[inverse], chars_[parents] / total, links_[parents] / np.maximum(chars_[parents], 1), np.log1p(longest), runs,
    ], axis=1)
    return x
