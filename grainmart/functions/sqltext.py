"""Quoting for expressions written as SQL text.

Reports over more than a hundred columns are built as text, because one parsed string is much
cheaper to hand to the planner than hundreds of separate Column objects.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: object) -> str:
    """A string, number or boolean as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"({value!r}D)"
    return str(value)


def struct(fields: Mapping[str, str]) -> str:
    return "named_struct(" + ", ".join(f"{literal(n)}, {sql}" for n, sql in fields.items()) + ")"


def rows(structs: Iterable[str]) -> str:
    """A table-valued expression with one row per struct."""
    return f"inline(array({', '.join(structs)}))"
