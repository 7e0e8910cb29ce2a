"""A page as a list of text blocks with generalised paths, by one scan of its tags."""

from __future__ import annotations

import html
import re

TAG = re.compile(r"<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>", re.S | re.I)
INLINE = frozenset("a abbr b bdi bdo big cite code em font i img ins kbd mark q s small span strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ATTR = re.compile(r"(class|id|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NUMBER = re.compile(r"[\d_-]*\d[\d_-]*")
_SPACE = re.compile("[ \t\r\n\f\v\u00a0]+")


def squeeze(s: str) -> str:
    return _SPACE.sub(" ", s).strip(" ")


def label(tag: str, attrs: str) -> str:
    """Tag and class (else id), numbers generalised: div.c#, p.info."""
    name = ""
    if attrs:
        got = {m[1].lower(): m[2].strip("\"'") for m in _ATTR.finditer(attrs)}
        name = got.get("class") or got.get("id") or got.get("itemprop") or ""
    return f"{tag}.{_NUMBER.sub('#', name.strip().lower())}" if name else tag


def blocks(page: str) -> list[tuple[str, str, int]]:
    """(path, text, letters inside links) of each stretch of text under one path, in page order.

    A path is the labels from the body down. Line breaks and block tags end a block; inline tags end
    one only when they carry a class (a label of their own) or are links, so a paragraph with emphasis
    stays whole."""
    out: list[tuple[str, str, int]] = []
    stack: list[str] = []
    tags: list[str] = []
    cell: list[str] = []
    linked = 0
    at = 0
    inlink = 0

    def end() -> None:
        nonlocal linked
        if cell:
            text = squeeze(html.unescape("".join(cell)))
            if text:
                out.append((">".join(stack), text, linked))
            cell.clear()
        linked = 0

    for m in TAG.finditer(page):
        if m.start() > at:
            piece = page[at : m.start()]
            cell.append(piece)
            if inlink:
                linked += len(piece)
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if m[2]:
            if tag in tags:
                k = len(tags) - 1 - tags[::-1].index(tag)
                if any(t not in INLINE for t in tags[k:]) or "." in stack[k] or tag == "a":
                    end()
                if tag == "a":
                    inlink = max(0, inlink - 1)
                del tags[k:], stack[k:]
            continue
        if tag == "br" or tag == "hr":
            end()
            continue
        if tag in VOID:
            continue
        name = label(tag, m[4])
        if tag not in INLINE or "." in name or tag == "a":
            end()
        if tag == "a":
            inlink += 1
        tags.append(tag)
        stack.append(name)
    if at < len(page):
        cell.append(page[at:])
    end()
    return out
