"""SQL text helpers for wide projections: names and literals quoted for ``selectExpr``."""

from __future__ import annotations


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
