"""Element positions of one HTML text: the per-row helper of the nested HTML jobs.

Real pages are unclean, so this records only what the jobs need: where an
element starts and ends and which element it is in. An end tag closes the
nearest open element of its name and everything left open inside it.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from typing import NamedTuple

# Fixed values of the HTML standard.
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
# A start tag ends an open element of these names, up to the enclosing container.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"tr"}, {"table"}),
}

_ATTRS = r"(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+"
# Comments and declarations, code with its content, and plain tags.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    rf"|<(script|style)(?=[\s/>])({_ATTRS})>.*?(</\1\s*>|\Z)"
    rf"|<(/?)([a-z][^\s/>]*)({_ATTRS})>",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANKS = re.compile(r"\s+")


class Element(NamedTuple):
    tag: str
    attrs: str
    parent: int  # position of the parent in the list, -1 for none
    start: int  # of the start tag
    inner: int  # end of the start tag
    inner_end: int  # start of the end tag
    end: int  # of the end tag


class Step(NamedTuple):
    """One part of a selector: a tag, class tokens, or both."""

    tag: str
    classes: frozenset[str]


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag, first one wins, entities decoded."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(text):
        found.setdefault(name.lower(), entities.unescape(double or single or bare))
    return found


def tags(text: str) -> Iterator[tuple[str, bool, str, int, int]]:
    """(name, is end tag, attributes, start, end) of every tag outside comments and code."""
    for match in _TAG.finditer(text):
        code, code_attrs, code_end, slash, name, attrs = match.groups()
        if name:
            yield name.lower(), slash == "/", attrs, match.start(), match.end()
        elif code:
            yield code.lower(), False, code_attrs, match.start(), match.end(2) + 1
            if code_end:
                yield code.lower(), True, "", match.start(3), match.end()


def elements(text: str) -> list[Element]:
    """All elements in document order."""
    started: list[tuple[str, str, int, int, int]] = []
    inner_ends: list[int] = []
    ends: list[int] = []
    stack: list[int] = []
    open_now: dict[str, int] = {}  # a stray end tag then costs no walk over the stack

    def close(depth: int, inner_end: int, end: int) -> None:
        for at in stack[depth:]:
            inner_ends[at] = ends[at] = inner_end
            open_now[started[at][0]] -= 1
        ends[stack[depth]] = end
        del stack[depth:]

    for name, is_end, attrs, start, end in tags(text):
        if is_end and not open_now.get(name):
            continue
        if is_end:
            for depth in range(len(stack) - 1, -1, -1):
                if started[stack[depth]][0] == name:
                    close(depth, start, end)
                    break
            continue
        if name in IMPLIED_END:
            closed, container = IMPLIED_END[name]
            for depth in range(len(stack) - 1, -1, -1):
                above = started[stack[depth]][0]
                if above in container:
                    break
                if above in closed:
                    close(depth, start, start)
                    break
        started.append((name, attrs, stack[-1] if stack else -1, start, end))
        inner_ends.append(end)
        ends.append(end)
        if name not in VOID_TAGS:  # a slash at the end means nothing elsewhere
            stack.append(len(started) - 1)
            open_now[name] = open_now.get(name, 0) + 1
    if stack:
        close(0, len(text), len(text))
    return [Element(*head, inner_end, end) for head, inner_end, end in zip(started, inner_ends, ends)]


def selector(text: str) -> list[Step]:
    """``nav li.item a`` as steps from the outside in."""
    steps = []
    for part in text.split():
        tag, *classes = part.split(".")
        steps.append(Step(tag.lower(), frozenset(classes)))
    return steps


def fits(element: Element, step: Step) -> bool:
    if step.tag and element.tag != step.tag:
        return False
    return not step.classes or step.classes <= set(attributes(element.attrs).get("class", "").split())


def inside(found: Sequence[Element], scope: int) -> range:
    """Positions of the elements inside another: they follow it in document order."""
    return range(scope + 1, bisect_left(found, found[scope].inner_end, lo=scope + 1, key=lambda e: e.start))


def select(found: Sequence[Element], steps: Sequence[Step], scope: int = -1) -> list[int]:
    """Positions of the elements that match a descendant selector, inside ``scope`` if given."""
    hits = []
    for at in inside(found, scope) if scope >= 0 else range(len(found)):
        if not fits(found[at], steps[-1]):
            continue
        left = len(steps) - 2
        above = found[at].parent
        while left >= 0 and above >= 0 and above != scope:
            left -= fits(found[above], steps[left])
            above = found[above].parent
        if left < 0:
            hits.append(at)
    return hits


def _gap(match: re.Match) -> str:
    return " " if (match[5] or "").lower() in ("br", "p", "li", "td") else ""


def inner_text(text: str) -> str:
    """Text of a piece of HTML: no code or comments, entities decoded, blanks collapsed."""
    return _BLANKS.sub(" ", entities.unescape(_TAG.sub(_gap, text))).strip()
