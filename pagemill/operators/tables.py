"""Table markup to cells: the per-row helper of ``table_cells``."""

from __future__ import annotations

from collections.abc import Iterator

from pagemill.operators import markup

HEADER_CLASS = "headerCell"  # fixed value: the class of header cells made of ``td``


# Fixed values of the HTML standard: the most columns and rows a cell can span.
MOST_SPANNED = {"colspan": 1_000, "rowspan": 65_534}


def _span(attrs: dict[str, str], name: str) -> int:
    value = attrs.get(name, "").strip()
    known = value.isascii() and value.isdigit()
    return min(max(int(value[-9:]) if len(value) < 10 else MOST_SPANNED[name], 1), MOST_SPANNED[name]) if known else 1


def grid(found: list[markup.Element], text: str, table: int) -> list[dict[int, tuple[str, bool]]]:
    """Rows of column -> (text, is header), spans filled by repeating the value.

    Rows of a nested table belong to that table; its text stays in the cell.
    """

    def owner(at: int) -> int:
        at = found[at].parent
        while at >= 0 and found[at].tag != "table":
            at = found[at].parent
        return at

    inside = markup.inside(found, table)
    own_rows = [at for at in inside if found[at].tag == "tr" and owner(at) == table]
    rows: list[dict[int, tuple[str, bool]]] = [{} for _ in own_rows]
    position = {at: i for i, at in enumerate(own_rows)}
    for at in inside:
        cell = found[at]
        if cell.tag not in ("td", "th") or cell.parent not in position:
            continue
        attrs = markup.attributes(cell.attrs)
        is_header = cell.tag == "th" or HEADER_CLASS in attrs.get("class", "").split()
        value = (markup.inner_text(text[cell.inner : cell.inner_end]), is_header)
        row = position[cell.parent]
        col = 0
        while col in rows[row]:
            col += 1
        for r in range(row, min(row + _span(attrs, "rowspan"), len(rows))):
            for c in range(col, col + _span(attrs, "colspan")):
                rows[r].setdefault(c, value)
    return rows


def headers(rows: list[dict[int, tuple[str, bool]]]) -> tuple[list[str], int]:
    """Column names and the number of header rows.

    The leading all-header rows name the columns, levels joined by a blank; a
    value repeated by a span is used once. Without header rows, or where a
    name is blank, it is ``column_<n>``. Equal names get ``_2``, ``_3`` …, the
    first that no column before has.
    """
    depth = 0
    while depth < len(rows) and rows[depth] and all(is_header for _, is_header in rows[depth].values()):
        depth += 1
    names: list[str] = []
    seen: dict[str, int] = {}
    taken: set[str] = set()
    for col in range(max((max(r) + 1 for r in rows if r), default=0)):
        levels: list[str] = []
        for row in rows[:depth]:
            value = row.get(col, ("", True))[0]
            if value and value not in levels[-1:]:
                levels.append(value)
        name = " ".join(levels) or f"column_{col + 1}"
        free, seen[name] = name, seen.get(name, 0) + 1
        while free in taken or (free == name and seen[name] > 1):
            seen[name] += free != name
            free = f"{name}_{max(seen[name], 2)}"
        taken.add(free)
        names.append(free)
    return names, depth


def cells(text: str, container: str = "") -> Iterator[tuple[int, int, int, str, str | None]]:
    """(table, row, column, header, value) of every body cell of the tables below ``container``, all counted from 1."""
    found = markup.elements(text)
    for table_no, table in enumerate(markup.select(found, markup.selector(f"{container} table")), start=1):
        rows = grid(found, text, table)
        names, depth = headers(rows)
        for row_no, row in enumerate(rows[depth:], start=1):
            for col, name in enumerate(names):
                value = row.get(col, ("", False))[0]
                yield table_no, row_no, col + 1, name, value or None
