"""A page's element tree as paths: blocks of text with the path they lie in, and a digest per path."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

from xxhash import xxh64_intdigest

# Fixed values of HTML: elements without an end tag, elements whose content is not markup, elements that flow inside
# a line, and the open elements that a start tag closes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math select canvas object audio video".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span "
             "strike strong sub sup time tt u var wbr br img".split())
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPES = set("article aside blockquote body div figure footer form header html li main nav ol section table td th ul".split())
SPACING = {"br", "img", "hr", "wbr"}

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@dataclass
class Node:
    tag: str
    names: tuple[str, ...]
    path: int
    attributes: str


@dataclass
class Page:
    """``blocks``: text and the open elements' nodes, in page order. ``shapes``: per path the tags of its children."""
    blocks: list[tuple[str, tuple[Node, ...]]] = field(default_factory=list)
    shapes: dict[int, list[int]] = field(default_factory=dict)


def parse(html: str) -> Page:
    """One pass over the markup; a broken page gives what can be read of it (a tag cut off at the end is dropped)."""
    page, stack, text = Page(), [Node("#", (), 0, "")], []
    at, n = 0, len(html)

    def flush() -> None:
        block = " ".join(unescape("".join(text)).split())
        text.clear()
        if block:
            page.blocks.append((block, tuple(stack)))

    def pop(k: int) -> None:
        if any(x.tag not in INLINE for x in stack[k:]):
            flush()
        del stack[k:]

    while at < n:
        m = _PIECE.search(html, at)
        if m is None:
            text.append(html[at:])
            break
        if m.start() > at:
            text.append(html[at:m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if k:
                pop(k)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if not attributes.rstrip().endswith("/"):
                at = end.end() if end else n
            continue
        if tag not in INLINE:
            flush()
            for k in range(len(stack) - 1, 0, -1):  # what this start tag closes, up to the next scope
                if stack[k].tag == "p" or stack[k].tag in CLOSES.get(tag, ()):
                    del stack[k:]
                    break
                if stack[k].tag in SCOPES:
                    break
        if tag in SPACING:
            text.append(" ")
        if tag in VOID:
            continue
        names = []
        if attributes:
            for kind, *value in _NAMES.findall(attributes):
                names += ["".join(value).lower()] if kind.lower() == "role" else "".join(value).lower().split()
        key = tag + "".join(sorted("." + re.sub(r"\d+", "0", x) for x in names))
        parent = stack[-1].path
        path = xxh64_intdigest(key, parent) >> 1
        page.shapes.setdefault(parent, []).append(path)
        page.shapes.setdefault(path, [])
        stack.append(Node(tag, tuple(names), path, attributes))
    flush()
    return page
