"""A light document tree of a page: block elements, their text and what describes them."""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np

_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<other>[!?][^>]*(?:>|\Z))"
                  r"|(?P<end>/)?(?P<name>[a-zA-Z][a-zA-Z0-9:_-]*+)"
                  r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
                  r"|(?P<bend>/)?(?P<bname>[a-zA-Z][a-zA-Z0-9:_-]*+)(?P<battrs>[^>]*+)(?:>|\Z))", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is text to no reader; what is inside is skipped as a whole.
#: An element without an end tag after it hides nothing, but for code, which goes on to the end.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
CODE = {"script", "style"}
#: What a head holds; any other start tag or text ends it, as its end tag may be left out.
IN_HEAD = RAW | {"base", "basefont", "bgsound", "link", "meta", "noscript", "template", "head", "html"}
NEVER = {"template", "noscript", "svg", "canvas", "object", "audio", "video", "map",
         "select", "button", "datalist"} | RAW
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn",
          "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp"}
#: A start tag closes these open elements, up to the nearest element that holds such lists.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

#: Words of class, id, role and similar attributes that tell what an element is for.
GROUPS = {
    "main": "article content main post entry story body text page blog prose markdown",
    "menu": "nav navigation menu navbar breadcrumb breadcrumbs crumbs tabs toc topbar pager pagination submenu",
    "head": "header masthead head logo brand hero site title banner",
    "foot": "footer foot copyright legal colophon imprint contentinfo",
    "side": "sidebar aside side rail widget widgets complementary column secondary",
    "ad": "ad ads adv advert adverts advertisement sponsor sponsored promo promotion adslot dfp adsense teaser",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay warning message toast dialog privacy",
    "form": "form newsletter subscribe signup login register search contact input",
    "talk": "comment comments reply replies disqus discussion response responses respond thread feedback reader",
    "more": "related recommended recommend more popular trending share sharing social tags tag author byline meta",
}
_GROUP_OF = {word: k for k, words in enumerate(GROUPS.values()) for word in words.split()}
TAG_KINDS = [{"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "dialog"},
             {"article"}, {"main"}, {"section"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"},
             {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"table", "tbody", "thead", "tr", "td", "th"},
             {"div"}, {"blockquote", "pre", "figure", "figcaption"}, {"body", "html"}]
FEATURES = ([f"tag_{k}" for k in range(len(TAG_KINDS))] + [f"own_{g}" for g in GROUPS]
            + [f"above_{g}" for g in GROUPS] + [f"above_tag_{k}" for k in range(8)]
            + ["apart", "below_apart", "depth", "own_chars", "tree_chars", "tree_nodes", "density", "links", "share", "siblings",
               "place", "alike", "paragraphs", "points", "wordiness", "before_share"])


class Dom:
    """Block elements in page order. Node 0 is the page itself; a parent comes before its children."""

    def __init__(self) -> None:
        self.tag = ["html"]
        self.parent = [-1]
        self.words: list[tuple[int, ...]] = [()]
        #: (node, text, is link) in page order; node -1 marks the border of a block
        self.text: list[tuple[int, str, bool]] = []


class _EndTags:
    """Where the end tags of a page are, looked up once a name."""

    def __init__(self, page: str) -> None:
        self._page = page
        self._last: dict[str, int] = {}

    def follow(self, name: str, at: int) -> bool:
        """Whether an end tag of that name begins at ``at`` or later."""
        if name not in self._last:
            self._last[name] = -1
            for m in re.finditer(f"</{name}(?![a-zA-Z0-9:_-])", self._page, re.I):
                self._last[name] = m.start()
        return self._last[name] >= at

    def after(self, name: str, at: int) -> int | None:
        """Where the next end tag of that name ends."""
        if not self.follow(name, at):
            return None
        return re.compile(f"</{name}(?![a-zA-Z0-9:_-])[^>]*>?", re.I).search(self._page, at).end()


def parse(page: str) -> Dom:
    """The tree of a page, however it is closed: stray end tags are ignored, open elements end with it."""
    dom = Dom()
    stack = [(0, "html")]  # block elements only
    open_names: Counter[str] = Counter()
    ends = _EndTags(page)
    links = 0
    head = False
    skip = None  # (name, how many of that name are open) of an element whose content is skipped
    at = 0

    def write(raw: str) -> None:
        nonlocal head
        if raw and skip is None:
            if head:
                if not raw.strip():
                    return
                head = False
            dom.text.append((stack[-1][0], html.unescape(raw) if "&" in raw else raw, links > 0))

    def close(k: int) -> None:
        open_names.subtract(name for _, name in stack[k:])
        del stack[k:]

    while True:
        opened = page.find("<", at)
        if opened < 0:
            write(page[at:])
            return dom
        m = _TAG.match(page, opened)
        if m is None:
            write(page[at:opened + 1])
            at = opened + 1
            continue
        write(page[at:opened])
        at = m.end()
        name = m["name"] or m["bname"]
        if name is None:
            continue
        name = name.lower()
        closing = bool(m["end"] or m["bend"])
        if name in RAW and not closing:
            # to the matching end tag, whatever lies between
            if skip is None:
                dom.text.append((-1, "", False))
            end = ends.after(name, at)
            if end is None and name in CODE:
                return dom
            at = at if end is None else end
            continue
        if skip is not None:
            if name == skip[0]:
                left = skip[1] + (-1 if closing else 1)
                skip = (name, left) if left and ends.follow(name, at) else None
            continue
        if name == "head":
            head = not closing and len(dom.tag) == 1
            continue
        if head and not closing and name not in IN_HEAD:
            head = False
        if name in VOID:
            if name in ("br", "hr"):
                dom.text.append((-1, "", False))
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if closing:
            if name in INLINE or name in NEVER:
                continue
            for k in range(len(stack) - 1, 0, -1) if open_names[name] else ():
                if stack[k][1] == name:
                    close(k)
                    dom.text.append((-1, "", False))
                    links = 0
                    break
            continue
        attrs = m["attrs"] or m["battrs"] or ""
        if name in NEVER:
            if not attrs.rstrip().endswith("/") and ends.follow(name, at):
                skip = (name, 1)
            dom.text.append((-1, "", False))
            continue
        if name in INLINE:
            continue
        dom.text.append((-1, "", False))
        if name in ("html",):
            continue
        closes, within = CLOSES.get(name, (frozenset({"p"}), frozenset()))
        for k in range(len(stack) - 1, 0, -1) if any(open_names[c] for c in closes) else ():
            if stack[k][1] in within:
                break
            if stack[k][1] in closes:
                close(k)
                break
            if name not in CLOSES and stack[k][1] != "p":
                break
        found = set()
        if "=" in attrs:
            for key, *values in _ATTR.findall(attrs):
                if key.lower() in ("class", "id", "role", "itemprop", "aria-label"):
                    for word in _TOKEN.findall(values[0] or values[1] or values[2]):
                        group = _GROUP_OF.get(word.lower())
                        if group is not None:
                            found.add(group)
        dom.parent.append(stack[-1][0])
        dom.tag.append(name)
        dom.words.append(tuple(found))
        stack.append((len(dom.tag) - 1, name))
        open_names[name] += 1


def features(dom: Dom) -> np.ndarray:
    """One row for each node, in the order of FEATURES."""
    n, groups, kinds = len(dom.tag), len(GROUPS), len(TAG_KINDS)
    parent = dom.parent
    own, linked, points, tokens = [0] * n, [0] * n, [0] * n, [0] * n
    before, seen = [0] * n, 0
    last = 0
    for node, text, link in dom.text:
        if node < 0:
            continue
        while last <= node:
            before[last] = seen
            last += 1
        size = len(text) - text.count(" ") - text.count("\n")
        own[node] += size
        seen += size
        if link:
            linked[node] += size
        points[node] += text.count(".") + text.count(",")
        tokens[node] += text.count(" ") + 1
    while last < n:
        before[last] = seen
        last += 1
    chars, tree_links, nodes, paragraphs = own[:], linked[:], [1] * n, [t == "p" for t in dom.tag]
    paragraphs = [int(p) for p in paragraphs]
    children = [0] * n
    alike: dict[tuple[int, str], int] = {}
    place = [0] * n
    for k in range(1, n):
        place[k] = children[parent[k]]
        children[parent[k]] += 1
        key = (parent[k], dom.tag[k])
        alike[key] = alike.get(key, 0) + 1
    for k in range(n - 1, 0, -1):
        p = parent[k]
        chars[p] += chars[k]
        tree_links[p] += tree_links[k]
        nodes[p] += nodes[k]
        paragraphs[p] += paragraphs[k]
    out = np.zeros((n, len(FEATURES)))
    kind_of = {t: k for k, tags in enumerate(TAG_KINDS) for t in tags}
    depth = [0] * n
    total = max(1, chars[0])
    above_at, above_tag, rest = kinds + groups, kinds + 2 * groups, kinds + 2 * groups + 8
    for k in range(n):
        row, p = out[k], parent[k]
        if p >= 0:
            depth[k] = depth[p] + 1
            up = out[p]
            row[above_at:above_tag] = np.maximum(up[above_at:above_tag], up[kinds:kinds + groups])
            row[above_tag:rest] = np.maximum(up[above_tag:rest], up[:8])
        kind = kind_of.get(dom.tag[k])
        if kind is not None:
            row[kind] = 1
        for g in dom.words[k]:
            row[kinds + g] = 1
        apart = row[:5].any() or row[kinds + 1:above_at].any()
        below = p >= 0 and (out[p, rest] or out[p, rest + 1])
        row[rest:] = (apart, below, depth[k], np.log1p(own[k]), np.log1p(chars[k]), np.log1p(nodes[k]),
                      chars[k] / nodes[k], tree_links[k] / max(1, chars[k]), chars[k] / total,
                      children[p] if p >= 0 else 1, place[k] / max(1, children[p] if p >= 0 else 1),
                      alike.get((p, dom.tag[k]), 1), np.log1p(paragraphs[k]),
                      100 * points[k] / max(1, own[k]), tokens[k], before[k] / total)
    return out


def decode(dom: Dom, margins: np.ndarray) -> np.ndarray:
    """Which nodes to keep: the choice of largest total margin in which a kept node's ancestors are kept."""
    worth = margins.tolist()
    for k in range(len(worth) - 1, 0, -1):
        if worth[k] > 0:
            worth[dom.parent[k]] += worth[k]
    keep = np.zeros(len(worth), bool)
    keep[0] = True
    for k in range(1, len(worth)):
        keep[k] = keep[dom.parent[k]] and worth[k] > 0
    return keep


def kept_text(dom: Dom, keep: np.ndarray) -> str:
    """Text of the kept nodes in page order; blocks and white space become single spaces."""
    return " ".join("".join(" " if node < 0 else text for node, text, _ in dom.text
                            if node < 0 or keep[node]).split())
