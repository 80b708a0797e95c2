"""Small HTML helper used inside the DOM job: tokens -> light tree -> selector hits.

It honours the selector subset the site rules use: tags, ``.class``, ``#id``,
compounds, descendant and child steps, comma lists, ``[a]``, ``[a="v"]``,
``[a*="v"]`` (also ``^=``, ``$=``, ``~=``) and ``:nth-of-type(n)``.
"""

from __future__ import annotations

import re
from html import escape, unescape
from itertools import islice

# Elements that never belong to an article body.
STRIP_TAGS = frozenset({"script", "style", "nav", "header", "footer", "aside", "iframe", "noscript"})

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title".split())
_SILENT = frozenset("script style template".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("body dd dt html li tbody td tfoot th thead tr".split()) | {"dd", "dt", "li"}
_P_FENCE = frozenset("button caption html object table td th".split())
# start tag -> (open elements it ends, elements the search does not cross)
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "a": ({"a"}, {"table", "td", "th", "div", "li", "section", "article", "body"}),
}

_ATTR = r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+))?+)?+"""
_ATTRS = re.compile(_ATTR)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|" + re.sub(r"\((?!\?)", "(?:", _ATTR) + r")*+)>",
    re.S,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _RAW}


class Node:
    __slots__ = ("tag", "raw", "parent", "kids", "order", "_attrs")

    def __init__(self, tag: str, raw: str, parent: "Node | None", order: int):
        self.tag, self.raw, self.parent, self.order = tag, raw, parent, order
        self.kids: list = []
        self._attrs: dict | None = None

    @property
    def attrs(self) -> dict:
        if self._attrs is None:
            self._attrs = {}
            for name, dq, sq, bare in _ATTRS.findall(self.raw):
                value = dq or sq or bare
                self._attrs.setdefault(name.lower(), unescape(value) if "&" in value else value)
        return self._attrs

    def walk(self):
        """This element and all below it, in document order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(k for k in reversed(node.kids) if k.__class__ is Node)

    def texts(self):
        """Every text below, in document order, without script and style text."""
        stack: list = [self]
        while stack:
            top = stack.pop()
            if top.__class__ is str:
                yield top
            elif top is self or top.tag not in _SILENT:
                stack.extend(reversed(top.kids))


class Document:
    def __init__(self, html: str):
        self.root = Node("", "", None, -1)
        self.by_tag: dict[str, list[Node]] = {}
        self.nodes: list[Node] = []
        self._read(html)

    def _read(self, html: str) -> None:
        # Nothing after the last '>' can be a tag, so unfinished ones end as text.
        end, pos, top = html.rfind(">") + 1, 0, self.root
        nodes, by_tag, scan = self.nodes, self.by_tag, _TOKEN.search
        opened: dict[str, int] = {}  # open elements by tag: most searches upwards can be skipped

        def rise(to: Node) -> Node:
            node = top
            while node is not to:
                opened[node.tag] -= 1
                node = node.parent
            return to

        while True:
            hit = scan(html, pos, end)
            text = html[pos : hit.start() if hit else len(html)]
            if text:
                top.kids.append(unescape(text) if "&" in text else text)
            if hit is None:
                return
            pos, tag = hit.end(), hit.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if hit.group(1):
                if opened.get(tag):
                    top = rise(_close(top, tag))
                continue
            if tag in _CLOSES_P and opened.get("p"):
                top = rise(_end_open(top, {"p"}, _P_FENCE))
            if tag in _ENDS and any(opened.get(t) for t in _ENDS[tag][0]):
                top = rise(_end_open(top, *_ENDS[tag]))
            raw = hit.group(3)
            node = Node(tag, raw, top, len(nodes))
            nodes.append(node)
            by_tag.setdefault(tag, []).append(node)
            top.kids.append(node)
            if tag in _RAW:
                stop = _RAW_END[tag].search(html, pos)
                upto = stop.start() if stop else len(html)
                if upto > pos:
                    inner = html[pos:upto]
                    node.kids.append(unescape(inner) if tag in ("title", "textarea") else inner)
                pos = html.find(">", upto) + 1 or len(html)
                end = max(end, pos)
            elif tag not in _VOID:
                top = node
                opened[tag] = opened.get(tag, 0) + 1

    def select(self, selector: "Selector") -> list[Node]:
        hits = {}
        for steps in selector.alternatives:
            last = steps[-1][1]
            pool = self.by_tag.get(last.tag, ()) if last.tag else self.nodes
            for node in pool:
                if last.matches(node) and _ancestors_match(node, steps, len(steps) - 1):
                    hits[node.order] = node
        return [hits[k] for k in sorted(hits)] if len(selector.alternatives) > 1 else list(hits.values())


def _end_open(top: Node, ended: set, fence) -> Node:
    node = top
    while node.parent is not None:
        if node.tag in ended:
            return node.parent
        if node.tag in fence:
            return top
        node = node.parent
    return top


def _close(top: Node, tag: str) -> Node:
    node, inline = top, tag not in _BLOCK
    while node.parent is not None:
        if node.tag == tag:
            return node.parent
        if inline and node.tag in _BLOCK:
            return top
        node = node.parent
    return top


_SIMPLE = re.compile(
    r"""(?P<tag>[a-zA-Z][\w-]*|\*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)"""
    r"""|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*^$~]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]"""
    r"""|:nth-of-type\(\s*(?P<nth>\d+)\s*\)"""
)
_COMPARE = {
    "=": lambda have, want: have == want,
    "*=": lambda have, want: want != "" and want in have,
    "^=": lambda have, want: want != "" and have.startswith(want),
    "$=": lambda have, want: want != "" and have.endswith(want),
    "~=": lambda have, want: want in have.split(),
}


class Compound:
    """One step of a selector, e.g. ``a.next[href]``."""

    def __init__(self, text: str):
        self.tag, self.classes, self.tests, self.nth, self.hints = "", [], [], 0, []
        pos = 0
        while pos < len(text):
            part = _SIMPLE.match(text, pos)
            if part is None:
                raise ValueError(f"selector not supported: {text!r}")
            pos = part.end()
            got = part.groupdict()
            if got["tag"]:
                self.tag = "" if got["tag"] == "*" else got["tag"].lower()
            elif got["cls"]:
                self.classes.append(got["cls"])
            elif got["id"]:
                self.tests.append(("id", "=", got["id"]))
            elif got["nth"]:
                self.nth = int(got["nth"])
            else:
                self.tests.append((got["attr"].lower(), got["op"], got["dq"] or got["sq"] or got["bare"] or ""))
        # Cheap look into the unread attribute text before attributes are parsed.
        self.hints = list(self.classes) + [v for a, op, v in self.tests if a == "id"]

    def matches(self, node: Node) -> bool:
        if self.tag and node.tag != self.tag:
            return False
        for hint in self.hints:
            if hint not in node.raw:
                return False
        if self.classes:
            have = node.attrs.get("class", "").split()
            if any(c not in have for c in self.classes):
                return False
        for name, op, want in self.tests:
            have = node.attrs.get(name)
            if have is None or (op and not _COMPARE[op](have, want)):
                return False
        if self.nth:
            same = (k for k in node.parent.kids if k.__class__ is Node and k.tag == node.tag)
            return next(islice(same, self.nth - 1, None), None) is node
        return True


class Selector:
    """Comma list of step chains; a chain is ``[(combinator, Compound), ...]``."""

    def __init__(self, text: str):
        self.alternatives = []
        for chain in re.split(r",(?![^\[]*\])", text):
            steps, combinator = [], " "
            for word in re.findall(r">|(?:\[[^\]]*\]|[^\s>\[])+", chain):
                if word == ">":
                    combinator = ">"
                else:
                    steps.append((combinator, Compound(word)))
                    combinator = " "
            if steps:
                self.alternatives.append(steps)


def _ancestors_match(node: Node, steps: list, at: int) -> bool:
    if at == 0:
        return True
    combinator, want = steps[at][0], steps[at - 1][1]
    up = node.parent
    while up is not None and up.parent is not None:
        if want.matches(up) and _ancestors_match(up, steps, at - 1):
            return True
        if combinator == ">":
            return False
        up = up.parent
    return False


# ---- what a field takes from its hits -------------------------------------------------


def own_texts(nodes: list[Node]) -> list[str]:
    return [t for n in nodes for k in n.kids if k.__class__ is str and (t := k.strip())]


def all_text(node: Node) -> str:
    return "".join(t.strip() for t in node.texts())


def text_of(nodes: list[Node]) -> str | None:
    """First non-blank text directly inside a hit, else all text of the first hit."""
    direct = own_texts(nodes)
    if direct:
        return direct[0]
    return (all_text(nodes[0]) or None) if nodes else None


def attr_values(nodes: list[Node], name: str) -> list[str]:
    return [n.attrs[name] for n in nodes if name in n.attrs]


def clean_markup(node: Node) -> str:
    """Markup of ``node`` without stripped elements and comments, as one whole document."""
    out: list[str] = []
    stack: list = [node]
    while stack:
        top = stack.pop()
        if top.__class__ is str:
            out.append(escape(top, quote=False))
        elif top.__class__ is tuple:
            out.append(top[0])
        elif top.tag not in STRIP_TAGS:
            attrs = "".join(f" {k}={_quoted(v)}" for k, v in top.attrs.items())
            if top.tag in _VOID:
                out.append(f"<{top.tag}{attrs}/>")
                continue
            if top.tag:
                out.append(f"<{top.tag}{attrs}>")
                stack.append((f"</{top.tag}>",))
            stack.extend(reversed(top.kids))
    text = "".join(out)
    if text.startswith("<html"):
        return text
    return f"<html>{text}</html>" if text.startswith("<body") else f"<html><body>{text}</body></html>"


def _quoted(value: str) -> str:
    value = escape(value, quote=False)
    if '"' not in value:
        return f'"{value}"'
    return f"'{value}'" if "'" not in value else '"' + value.replace('"', "&quot;") + '"'


def raw_images(container: Node) -> list[dict]:
    """Attributes of the images below, each with the caption of the figure it stands in.

    What becomes of them (lazy sources, URLs, blanks) is up to columns.
    """
    found: list[dict] = []
    stack = [(container, "")]
    while stack:
        node, caption = stack.pop()
        if node.tag == "figure":
            note = next((n for n in node.walk() if n.tag == "figcaption"), None)
            caption = "" if note is None else all_text(note)
        elif node.tag == "img":
            found.append({**{k: node.attrs.get(k) for k in ("src", "data-src", "alt")}, "caption": caption})
        stack.extend((k, caption) for k in reversed(node.kids) if k.__class__ is Node)
    return found


def read_more_links(doc: Document) -> list[Node]:
    """Anchors whose first own text holds "read more" in any case."""
    return [
        a
        for a in doc.by_tag.get("a", ())
        if "href" in a.attrs and "read more" in next((k for k in a.kids if k.__class__ is str), "").lower()
    ]


def headline_links(doc: Document) -> list[Node]:
    """Anchors with an ``h3`` child whose class is exactly ``splash``."""
    return [
        a
        for a in doc.by_tag.get("a", ())
        if "href" in a.attrs
        and any(k.__class__ is Node and k.tag == "h3" and k.attrs.get("class") == "splash" for k in a.kids)
    ]
