"""Row filters given as text.

The text is an expression over column names with comparisons, ``in``, boolean words or signs and
arithmetic. A missing value is unequal to everything and in no list, so ``a != b`` and ``a not in``
hold for it, and the negation of a condition that is unknown holds.
"""

from __future__ import annotations

import ast
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ARITHMETIC = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: F.try_divide, ast.Mod: lambda a, b: a % b}
_ORDER = {ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b}


def combine(*filters: str | None) -> str | None:
    """All the given filters; None asks for nothing."""
    given = [f for f in filters if f]
    return " and ".join(f"({f})" for f in given) or None


def _listed(node: ast.expr) -> list[object]:
    if not isinstance(node, (ast.List, ast.Tuple, ast.Set)):
        raise ValueError("'in' needs a list of values")
    return [ast.literal_eval(x) for x in node.elts]


def _known(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _compiled(node: ast.expr, names: dict[str, str]) -> Column:
    if isinstance(node, ast.Constant):
        return F.lit(node.value)
    if isinstance(node, ast.Name):
        return F.col(f"`{names.get(node.id, node.id)}`")
    if isinstance(node, ast.BoolOp):
        parts = [_known(_compiled(x, names)) for x in node.values]
        out = parts[0]
        for p in parts[1:]:
            out = out & p if isinstance(node.op, ast.And) else out | p
        return out
    if isinstance(node, ast.UnaryOp):
        inner = _compiled(node.operand, names)
        if isinstance(node.op, (ast.Not, ast.Invert)):
            return ~_known(inner)
        if isinstance(node.op, ast.USub):
            return -inner
    if isinstance(node, ast.BinOp):
        a, b = _compiled(node.left, names), _compiled(node.right, names)
        if isinstance(node.op, ast.BitAnd):
            return _known(a) & _known(b)
        if isinstance(node.op, ast.BitOr):
            return _known(a) | _known(b)
        if type(node.op) in _ARITHMETIC:
            return _ARITHMETIC[type(node.op)](a, b)
    if isinstance(node, ast.Compare):
        out, left = None, node.left
        for op, right in zip(node.ops, node.comparators, strict=True):
            if isinstance(op, (ast.In, ast.NotIn)):
                here = _known(_compiled(left, names).isin(_listed(right)))
                here = ~here if isinstance(op, ast.NotIn) else here
            else:
                a, b = _compiled(left, names), _compiled(right, names)
                if isinstance(op, ast.Eq):
                    here = _known(a == b)
                elif isinstance(op, ast.NotEq):
                    here = ~_known(a == b)
                elif type(op) in _ORDER:
                    here = _known(_ORDER[type(op)](a, b))
                else:
                    raise ValueError(f"{type(op).__name__} has no place in a filter")
            out, left = here if out is None else out & here, right
        return out
    raise ValueError(f"{type(node).__name__} has no place in a filter")


def condition(text: str) -> Column:
    """The filter as a column; only the forms named above are accepted."""
    names: dict[str, str] = {}

    def plain(m: re.Match[str]) -> str:
        key = f"_quoted_{len(names)}"
        names[key] = m[1]
        return key

    return _compiled(ast.parse(re.sub(r"`([^`]+)`", plain, text).strip(), mode="eval").body, names)


def where(df: DataFrame, text: str | None) -> DataFrame:
    return df.where(condition(text)) if text else df
