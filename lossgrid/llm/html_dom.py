"""A small, forgiving HTML reader: block elements as a tree of arrays, and the text between their borders.

Only what extraction needs is kept. Inline elements are not nodes: their text belongs to the block around them. Every
block border starts a new block of text. The reader is one pass of a regular expression that never looks back, and its
stack has a depth limit, so its time grows with the length of the page whatever the page holds.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

# Fixed values of HTML: the elements by how they are read.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSE_P = BLOCKS - frozenset("html body caption legend tbody td tfoot th thead tr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style svg template textarea title xmp".split())
CONTROLS = frozenset("button input option select textarea label".split())
HIDDEN = frozenset("button option select head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element that ends open ones of these names, looked for up to an element of the border.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "tr": ({"tr", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
P_BORDER = {"td", "th", "table", "caption", "button"}
MAX_DEPTH = 512

_ATTRIBUTES = r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+)*+"""
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
MARK = re.compile(r"""\bdata-mark="(\w)\"""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PUNCTUATION = re.compile(r"[.,;:!?]")


@lru_cache(maxsize=4096)
def attribute_parts(attributes: str) -> tuple[str, ...]:
    """The distinct letter runs of the naming attributes, in small letters: ``class="postBody-2"`` has post and body."""
    found = dict.fromkeys(
        part.lower() for _, a, b, c in NAMED.findall(attributes) for part in PART.findall(a or b or c) if len(part) > 1
    )
    return tuple(found)[:12]


class Page:
    """Blocks in page order; a node's parent comes before it, node 0 is the page itself.

    ``pieces`` are (node, number of the block of text, text): text as it is displayed, character references decoded.
    """

    def __init__(self, source: str, marked: bool = False):
        self.tag, self.parent, self.parts, self.marks = ["#page"], [-1], [()], [""]
        self.inline, self.controls, self.images = [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []
        self.linked: list[bool] = []
        self._stack: list[tuple[str, int]] = [("#page", 0)]
        self._open: dict[str, int] = {}
        self._block, self._links, self._hidden = 0, 0, 0
        at = 0
        while at < len(source):
            token = TOKEN.search(source, at)
            if token is None:
                self._text(source[at:])
                break
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            name = token[2]
            if name is None:
                continue
            name = name.lower()
            if token[1]:
                self._end(name)
                continue
            self._start(name, token[3], marked)
            if name in RAW and not token[3].endswith("/"):
                close = _closing(name).search(source, at)
                at = close.end() if close else len(source)

    def _text(self, text: str) -> None:
        if self._hidden:
            return
        if "&" in text:
            text = html.unescape(text)
        self.pieces.append((self._stack[-1][1], self._block, text))
        self.linked.append(self._links > 0)

    def _pop_to(self, depth: int) -> None:
        for name, _ in self._stack[depth:]:
            self._open[name] -= 1
            if name in BLOCKS:
                self._block += 1
            elif name == "a":
                self._links -= 1
            if name in HIDDEN:
                self._hidden -= 1
        del self._stack[depth:]

    def _close(self, names: set[str], border: set[str]) -> None:
        if not any(self._open.get(name) for name in names):
            return
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self._stack[depth][0]
            if name in names:
                self._pop_to(depth)
                return
            if name in border:
                return

    def _start(self, name: str, attributes: str, marked: bool) -> None:
        if name in CLOSE_P:
            self._close({"p"}, P_BORDER)
        if name in ENDS:
            self._close(*ENDS[name])
        elif name == "a":
            self._close({"a"}, BLOCKS)
        node = self._stack[-1][1]
        if name in BLOCKS:
            self._block += 1
            self.tag.append(name)
            self.parent.append(node)
            self.parts.append(attribute_parts(attributes) if attributes else ())
            if marked:
                found = MARK.search(attributes)
                self.marks.append(found[1] if found else "")
            node = len(self.tag) - 1
            for counts in (self.inline, self.controls, self.images):
                counts.append(0)
        else:
            self.inline[node] += 1
            self.controls[node] += name in CONTROLS
            self.images[node] += name == "img"
            if name == "br":
                self._text(" ")
        if name in VOID or name in RAW or len(self._stack) >= MAX_DEPTH:
            return
        self._stack.append((name, node))
        self._open[name] = self._open.get(name, 0) + 1
        self._links += name == "a"
        self._hidden += name in HIDDEN

    def _end(self, name: str) -> None:
        if name in VOID or name in RAW:
            return
        if name in BLOCKS:
            border = {"table"} if name in {"td", "th", "tr", "tbody", "thead", "tfoot", "caption"} else {"td", "th"} - {name}
            self._close({name}, border)
        else:
            self._close({name}, BLOCKS)


@lru_cache(maxsize=64)
def _closing(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I)


def joined(pieces: list[tuple[int, int, str]], kept: list[bool]) -> str:
    """The text of the kept pieces: white space inside a block is one space, blocks are joined by one space."""
    out, last = [], -1
    for (_, block, text), keep in zip(pieces, kept, strict=True):
        if keep:
            if block != last:
                out.append(" ")
                last = block
            out.append(text)
    return " ".join("".join(out).split())
