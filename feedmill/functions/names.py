"""Hyphenated record names and how they map to columns."""

from __future__ import annotations

import re
from collections.abc import Iterable

_QUOTED = re.compile(r"('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")")
_HYPHENATED = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(?:-[A-Za-z0-9_]+)+")


def column_name(name: str) -> str:
    """Record name to column name: hyphens become underscores."""
    return name.strip().replace("-", "_")


def find_column(columns: Iterable[str], name: str) -> str | None:
    """The column that matches ``name`` regardless of hyphens, if any."""
    wanted = column_name(name)
    return next((c for c in columns if column_name(c) == wanted), None)


def get_column(columns: Iterable[str], name: str) -> str:
    """Like :func:`find_column`, but a missing column is an error."""
    columns = list(columns)
    found = find_column(columns, name)
    if found is None:
        raise ValueError(f"no column '{name}' among {columns}")
    return found


def quoted(name: str) -> str:
    """A column name as an SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(text: str, columns: Iterable[str]) -> str:
    """Rewrite record names in an expression so that Spark SQL can read it.

    Only hyphenated names that exist as columns are rewritten, longest match
    first, so ``A-B`` stays a subtraction unless a column ``A_B`` exists. A lone
    underscore between blanks is the feed notation for minus. Quoted text is
    left alone.
    """
    columns = list(columns)

    def name(match: re.Match[str]) -> str:
        parts = match.group(0).split("-")
        out: list[str] = []
        while parts:
            for size in range(len(parts), 0, -1):
                found = find_column(columns, "-".join(parts[:size])) if size > 1 else None
                if found is not None or size == 1:
                    out.append(quoted(found) if found is not None else parts[0])
                    parts = parts[size:]
                    break
        return " - ".join(out)

    pieces = _QUOTED.split(text)
    for i in range(0, len(pieces), 2):
        plain = re.sub(r"(?<=\s)_(?=\s)", "-", pieces[i])
        pieces[i] = _HYPHENATED.sub(name, plain)
    return "".join(pieces)
