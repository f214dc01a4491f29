"""HTML to Markdown for one page: the per-row helper of ``html_to_markdown``."""

from __future__ import annotations

import html as entities
import re

from pagemill.operators import markup

_BLANKS = re.compile(r"[ \t\r\n\f]+")
_GAPS = re.compile(r"\n{3,}")
_SKIP = frozenset(("script", "style", "noscript", "svg", "head"))
_BLOCK = frozenset("p div article section main header footer nav aside form ul ol table h1 h2 h3 h4 h5 h6 blockquote".split())


def convert(text: str, links: bool = True) -> str:
    """Headings, lists, links, bold, italics, images and tables as Markdown."""
    out: list[str] = []
    hrefs: list[str] = []
    lists: list[list] = []
    header_cells: list[int] = []
    skip: list[str] = []
    at = 0

    def write(raw: str) -> None:
        plain = _BLANKS.sub(" ", entities.unescape(raw))
        if plain.strip():
            fresh = not out or out[-1].endswith(("\n", " ", "["))
            out.append(plain.lstrip() if fresh else plain)
        elif plain and out and not out[-1].endswith(("\n", " ")):
            out.append(" ")

    for name, is_end, attrs, start, end in [*markup.tags(text), ("", False, "", len(text), len(text))]:
        if not skip and start > at:
            write(re.sub(r"(?s)<!--.*?(?:-->|\Z)|<[!?][^>]*>", "", text[at:start]))
        at = end
        if name in _SKIP:
            if not is_end:
                skip.append(name)
            elif name in skip:
                del skip[skip.index(name) :]
            continue
        if skip:
            continue
        if name in _BLOCK:
            if name in ("ul", "ol"):
                if is_end:
                    if lists:
                        lists.pop()
                else:
                    lists.append([name, 0])
            out.append("\n" if name in ("ul", "ol") and lists and (is_end or len(lists) > 1) else "\n\n")
            if not is_end and len(name) == 2 and name[0] == "h":
                out.append("#" * int(name[1]) + " ")
        elif name == "br":
            out.append("\n")
        elif name in ("b", "strong"):
            out.append("**")
        elif name in ("i", "em"):
            out.append("*")
        elif name == "li" and not is_end:
            kind = lists[-1] if lists else ["ul", 0]
            kind[1] += 1
            mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
            out.append("\n" + "  " * max(len(lists) - 1, 0) + mark + "")
        elif name == "a" and links:
            if not is_end:
                hrefs.append(markup.attributes(attrs).get("href", ""))
                out.append("[")
            elif hrefs:
                out.append(f"]({hrefs.pop()})")
        elif name == "img":
            found = markup.attributes(attrs)
            out.append(f"![{found.get('alt', '')}]({found.get('src', '')})")
        elif name == "tr":
            if not is_end:
                header_cells.append(0)
                out.append("\n|")
            elif header_cells:
                columns = header_cells.pop()
                if columns:
                    out.append("\n" + "|" + " --- |" * columns)
        elif name in ("td", "th"):
            if not is_end:
                out.append(" ")
                if name == "th" and header_cells:
                    header_cells[-1] += 1
            else:
                out.append(" |")
    joined = "".join(out)
    lines = "\n".join(line.rstrip() for line in joined.split("\n"))
    return _GAPS.sub("\n\n", lines).strip()
