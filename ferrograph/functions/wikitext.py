"""Wikitext to visible text, templates and sections. Standard library only; one pass over nested marks."""

from __future__ import annotations

import html
import re

from .text import canonical_text

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
_REF = re.compile(r"<ref\b[^>]*/>|<ref\b[^>]*>.*?(?:</ref\s*>|\Z)", re.S | re.I)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_OUTSIDE = re.compile(r"\[(?:https?:)?//\S+(?:\s+([^\]]*))?\]")
_HEADING = re.compile(r"^(={1,6})\s*(.+?)\s*\1\s*$", re.M)
_HIDDEN = re.compile(r"^\s*:?\s*(?:file|image|category)\s*:", re.I)
# Marks of citations, and marks that begin an item of a list; what a section's text is depends on them.
_CITATION = re.compile(r"\[(?:\s*\d+\s*|citation needed)\]", re.I)
_LIST = re.compile(r"^\s*[*#;:]+\s*")


def _balanced(text: str, opening: str, closing: str):
    """(start, end) of outermost pairs; an opening mark without its closing one is left as text."""
    out, stack, i = [], [], 0
    while i < len(text) - 1:
        two = text[i : i + 2]
        if two == opening:
            stack.append(i)
            i += 2
        elif two == closing and stack:
            start = stack.pop()
            if not stack:
                out.append((start, i + 2))
            i += 2
        else:
            i += 1
    return out


def _without(text: str, spans) -> str:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return "".join(out) + text[at:]


def _split(text: str, mark: str) -> list[str]:
    """Parts at a mark that isn't inside a link or template."""
    parts, depth, at, i = [], 0, 0, 0
    while i < len(text):
        two = text[i : i + 2]
        if two in ("{{", "[["):
            depth += 1
            i += 2
        elif two in ("}}", "]]"):
            depth = max(0, depth - 1)
            i += 2
        else:
            if text[i] == mark and not depth:
                parts.append(text[at:i])
                at = i + 1
            i += 1
    return [*parts, text[at:]]


def templates(text: str) -> list[tuple[str, dict[str, str]]]:
    """(name, parameters) of the outermost templates, in order; names and keys single-spaced in small letters."""
    out = []
    tidy = lambda s: re.sub(r"[\s_]+", " ", s).strip().lower()
    for a, b in _balanced(_COMMENT.sub("", text), "{{", "}}"):
        head, *rest = _split(_COMMENT.sub("", text)[a + 2 : b - 2], "|")
        values: dict[str, str] = {}
        for n, part in enumerate(rest, 1):
            key, eq, value = part.partition("=")
            values[tidy(key) if eq else str(n)] = (value if eq else part).strip()
        out.append((tidy(head), values))
    return out


def _tidy(s: str) -> str:
    return re.sub(r"[\s_]+", " ", s).strip().lower()


def every_template(text: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """(name, parameters in order) of all templates, those inside of others too; names and keys single-spaced in small letters."""
    out, todo = [], [_COMMENT.sub("", text)]
    while todo:
        here = todo.pop()
        for a, b in _balanced(here, "{{", "}}"):
            inner = here[a + 2 : b - 2]
            head, *rest = _split(inner, "|")
            params, place = [], 0
            for part in rest:
                key, eq, value = part.partition("=")
                place += not eq
                params.append((_tidy(key), value.strip()) if eq else (str(place), part.strip()))
            out.append((_tidy(head), params))
            todo.append(inner)
    return out


def categories(text: str) -> list[str]:
    """Titles of the categories that a page links to, in order."""
    return [re.sub(r"[\s_]+", " ", m[1]).strip() for m in re.finditer(r"\[\[\s*(category\s*:[^\]|]+)", _COMMENT.sub("", text), re.I)]


def single_line(text: str) -> str:
    """The visible text in its canonical form."""
    return canonical_text(visible(text))


def _links(text: str) -> str:
    for _ in range(5):
        spans = _balanced(text, "[[", "]]")
        if not spans:
            break
        out, at = [], 0
        for a, b in spans:
            inner = text[a + 2 : b - 2]
            out.append(text[at:a])
            if not _HIDDEN.match(inner):
                out.append(_split(inner, "|")[-1])
            at = b
        text = "".join(out) + text[at:]
    return text


def visible(text: str) -> str:
    """What a reader sees: labels of links, no templates, comments, references, tables, files or categories."""
    text = _REF.sub("", _COMMENT.sub("", text))
    text = _without(text, _balanced(text, "{{", "}}"))
    text = _without(text, _balanced(text, "{|", "|}"))
    text = _OUTSIDE.sub(lambda m: m[1] or "", _links(text))
    text = re.sub(r"'{2,5}", "", _HEADING.sub(r"\2", _TAG.sub("", text)))
    lines = [re.sub(r"[^\S\n]+", " ", x).strip() for x in html.unescape(text).split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def body_blocks(text: str) -> str:
    """A section's body: one line for each paragraph or list item, without citations."""
    out: list[str] = []
    fresh = True
    for line in visible(text).split("\n"):
        item = _LIST.match(line)
        plain = _CITATION.sub("", _LIST.sub("", line)).strip()
        if not plain:
            fresh = True
        elif fresh or item:
            out.append(plain)
            fresh = bool(item)
        else:
            out[-1] += " " + plain
    return "\n".join(out)


def sections(text: str, titles: set[str]) -> list[tuple[str, int, str]]:
    """(title, level, body) of the wanted sections, each up to the next heading of its level or above."""
    found = list(_HEADING.finditer(text))
    out = []
    for n, m in enumerate(found):
        level, title = len(m[1]), re.sub(r"\s+", " ", visible(m[2]))
        if title.lower() in titles:
            end = next((x.start() for x in found[n + 1 :] if len(x[1]) <= level), len(text))
            out.append((title, level, body_blocks(text[m.end() : end])))
    return out
