"""A streaming tokenizer for HTML: text, start tags with their attributes, end tags.

It follows the states of the HTML standard for tags and attributes: quotes count only in values, a value may be quoted
either way or not at all, the first of equal names wins, comments and declarations are skipped, script, style
and the like hold raw text until their end tag, and a tag the text ends in is dropped. One pass, in time proportional to the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

_OPEN = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|!--|[!?/])")
_ATTRIBUTE = re.compile(r"[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*|(?=>)))?)?)")
_COMMENT_END = re.compile(r"--!?>")
RAW = frozenset("script style xmp iframe noembed noframes".split())
DECODED_RAW = frozenset("textarea title".split())


def _attributes(html: str, at: int) -> tuple[dict[str, str] | None, int]:
    """Attributes of a tag and the position behind it; None if the text ends in the tag."""
    found: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(html, at)
        if m is None or m.end() == at:
            return None, len(html)
        at = m.end()
        if m[1]:
            return found, at
        rest = html[at : at + 1]
        if rest in ('"', "'") and m[3] is m[4] is m[5] is None and html[m.end(2) : at].strip().endswith("="):
            return None, len(html)  # a quote that is never closed
        if m[2]:
            value = next((v for v in (m[3], m[4], m[5]) if v is not None), "")
            found.setdefault(m[2].lower(), unescape(value))


def tokens(html: str) -> Iterator[tuple]:
    """``("text", text)``, ``("start", name, attributes)`` and ``("end", name)`` in order; text has its references decoded."""
    at = 0
    while at < len(html):
        m = _OPEN.search(html, at)
        if m is None:
            yield "text", unescape(html[at:])
            return
        if m.start() > at:
            yield "text", unescape(html[at : m.start()])
        at = m.end()
        if m[2]:
            name = m[2].lower()
            given, at = _attributes(html, at)
            if given is None:
                return
            if m[1]:
                yield "end", name
                continue
            yield "start", name, given
            if name in RAW or name in DECODED_RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
                stop = end.start() if end else len(html)
                if stop > at:
                    yield "text", unescape(html[at:stop]) if name in DECODED_RAW else html[at:stop]
                at = stop
        elif m[0] == "<!--":
            if html.startswith((">", "->"), at):
                at = html.index(">", at) + 1
            else:
                end = _COMMENT_END.search(html, at)
                at = end.end() if end else len(html)
        else:
            end = html.find(">", at)
            at = end + 1 if end >= 0 else len(html)


def links(html: str) -> list[tuple[str, str]]:
    """(address, text) of every ``a`` element with an address that is closed, by its end tag or by the next link."""
    out, address, parts, hidden = [], None, [], None

    def close() -> None:
        nonlocal address
        if address is not None:
            out.append((address, "".join(parts).strip(" ")))
        address = None
        parts.clear()

    for token in tokens(html):
        if token[0] == "text":
            if address is not None and hidden is None:
                parts.append(token[1])
        elif token[1] in RAW:
            hidden = token[1] if token[0] == "start" else None
        elif token[1] == "a":
            close()
            if token[0] == "start" and "href" in token[2]:
                address = token[2]["href"]
    return out


def title(html: str) -> str:
    """Text of the first title element, blanks around it gone."""
    inside, parts = False, []
    for token in tokens(html):
        if token[0] == "start" and token[1] == "title":
            inside = True
        elif inside and token[0] == "text":
            parts.append(token[1])
        elif inside and token[0] == "end":
            break
    return "".join(parts).strip(" ")
