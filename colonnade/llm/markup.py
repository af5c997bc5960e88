"""A forgiving HTML reader: markup to a stream of tags and text, and to a tree.

It never fails: unclosed and misnested tags, cut-off pages, stray ``<`` and broken references all give some result. Scripts,
styles and the like are read as raw text up to their end tag.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe noembed noframes xmp".split())
RAW_TEXT = frozenset("title textarea".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr li main menu nav ol p pre section summary table caption tbody td tfoot th thead tr ul option legend".split()
)
#: An open element of the key's kind is closed by a start tag of these.
CLOSED_BY = {
    "p": BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "option": {"option"},
    "head": {"body"},
}
#: What a start tag closes, by its name.
CLOSES = {name: tuple(k for k, names in CLOSED_BY.items() if name in names) for name in frozenset().union(*CLOSED_BY.values())}
#: Elements that implied end tags do not reach beyond.
SCOPE = frozenset("html body table td th ul ol dl div article section aside nav main header footer form blockquote fieldset".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"'][^\s=/>]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_SPACE = re.compile(r"\s+")


def attributes(rest: str) -> dict[str, str]:
    """The attributes of a tag, the first of each name."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(rest):
        if value[:1] in "\"'" and value:
            value = value[1:-1]
        out.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return out


def decode(text: str) -> str:
    """Character references resolved."""
    return unescape(text) if "&" in text else text


def squeeze(text: str) -> str:
    """Runs of white space as one space, none at the ends."""
    return " ".join(text.split())


def events(html: str) -> Iterator[tuple[str, str, str]]:
    """('start', name, rest of the tag), ('end', name, ''), ('text', undecoded text, '') and ('raw', name, content)."""
    at, size = 0, len(html)
    search = _TOKEN.search
    while at < size:
        tag = search(html, at)
        if tag is None:
            yield "text", html[at:], ""
            return
        if tag.start() > at:
            yield "text", html[at : tag.start()], ""
        at = tag.end()
        name = tag["name"] or tag["name2"]
        if not name:
            continue
        name = name.lower()
        if tag["end"] or tag["end2"]:
            yield "end", name, ""
            continue
        rest = tag["rest"] or tag["rest2"] or ""
        yield "start", name, rest
        if name in RAW or name in RAW_TEXT:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
            yield "raw", name, html[at : close.start() if close else size]
            yield "end", name, ""
            at = close.end() if close else size


class Node:
    """An element: its name, attributes and children, which are nodes and strings (references resolved)."""

    __slots__ = ("attrs", "children", "name")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.children = name, attrs, []

    def __repr__(self) -> str:
        return f"<{self.name} {self.children!r}>"


def parse(html: str) -> Node:
    """The page as a tree under a nameless root. Raw elements are leaves; comments and declarations are left out.

    Open elements are known by name, so a tag costs the same however many are open.
    """
    root = Node("", {})
    stack = [root]
    places: dict[str, list[int]] = {}  # where the open elements of a name stand
    scopes = [0]  # and those of SCOPE

    def close(depth: int) -> None:
        while len(stack) > depth:
            name = stack.pop().name
            places[name].pop()
            if name in SCOPE:
                scopes.pop()

    for kind, name, rest in events(html):
        if kind == "text":
            stack[-1].children.append(decode(name))
        elif kind == "raw":
            if name in RAW_TEXT:
                stack[-1].children.append(decode(rest))
        elif kind == "start":
            if name in CLOSES:
                depth = max((at[-1] for k in CLOSES[name] if (at := places.get(k))), default=0)
                if depth and depth >= scopes[-1]:
                    close(depth)
            node = Node(name, attributes(rest) if rest else {})
            stack[-1].children.append(node)
            if name not in VOID and (name in BLOCK or not rest.endswith("/")):
                places.setdefault(name, []).append(len(stack))
                if name in SCOPE:
                    scopes.append(len(stack))
                stack.append(node)
        elif (at := places.get(name)) and (name in SCOPE or at[-1] > scopes[-1]):
            close(at[-1])
    return root


def plain_text(html: str, separator: str = "\n") -> str:
    """All text a reader sees, one line for each block."""
    lines: list[str] = []
    held: list[str] = []
    for kind, name, _rest in events(html):
        if kind == "text":
            held.append(name)
        elif kind != "raw" and (name in BLOCK or name in ("br", "title")):
            line = squeeze(decode("".join(held)))
            if line:
                lines.append(line)
            held = []
    line = squeeze(decode("".join(held)))
    if line:
        lines.append(line)
    return separator.join(lines)
