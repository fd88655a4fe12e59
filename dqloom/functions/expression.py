"""A small expression language over typed columns, compiled to Column."""

from __future__ import annotations

import ast
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BINARY: dict[type, Callable] = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: F.try_divide, ast.Mod: F.try_mod, ast.Pow: F.pow}
_COMPARE: dict[type, Callable] = {ast.Lt: operator.lt, ast.LtE: operator.le, ast.Gt: operator.gt, ast.GtE: operator.ge, ast.Eq: operator.eq, ast.NotEq: operator.ne}
_CALLS: dict[str, Callable] = {"abs": F.abs, "sqrt": F.sqrt, "floor": F.floor, "ceil": F.ceil, "exp": F.exp, "log": F.log, "sin": F.sin, "cos": F.cos}


def names(text: str) -> set[str]:
    """Column names that an expression uses."""
    return {n.id for n in ast.walk(ast.parse(text, mode="eval")) if isinstance(n, ast.Name)} - set(_CALLS)


def compile_expression(text: str, column: Callable[[str], Column]) -> Column:
    """The expression over column(name). Raises ValueError for anything outside the language; never evaluates text."""
    try:
        tree = ast.parse(text.strip(), mode="eval")
    except SyntaxError as e:
        raise ValueError(f"cannot read expression {text!r}") from e

    def build(node: ast.AST) -> Column:
        if isinstance(node, ast.Name):
            return column(node.id)
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float, str, bool)):
            return F.lit(node.value)
        if isinstance(node, ast.UnaryOp):
            v = build(node.operand)
            if isinstance(node.op, ast.USub):
                return -v
            if isinstance(node.op, ast.UAdd):
                return v
            if isinstance(node.op, (ast.Not, ast.Invert)):
                return ~F.coalesce(v, F.lit(False))
        if isinstance(node, ast.BinOp):
            if type(node.op) in (ast.BitAnd, ast.BitOr):
                a, b = (F.coalesce(build(x), F.lit(False)) for x in (node.left, node.right))
                return a & b if isinstance(node.op, ast.BitAnd) else a | b
            if isinstance(node.op, ast.FloorDiv):
                return F.floor(F.try_divide(build(node.left), build(node.right)))
            if type(node.op) in _BINARY:
                return _BINARY[type(node.op)](build(node.left), build(node.right))
        if isinstance(node, ast.BoolOp):
            parts = [F.coalesce(build(v), F.lit(False)) for v in node.values]
            out = parts[0]
            for p in parts[1:]:
                out = out & p if isinstance(node.op, ast.And) else out | p
            return out
        if isinstance(node, ast.Compare):
            out, left = None, node.left
            for op, right in zip(node.ops, node.comparators, strict=True):
                if isinstance(op, (ast.In, ast.NotIn)) and isinstance(right, (ast.List, ast.Tuple)):
                    part = build(left).isin(*[build(x) for x in right.elts])
                    part = ~part if isinstance(op, ast.NotIn) else part
                elif type(op) in _COMPARE:
                    part = _COMPARE[type(op)](build(left), build(right))
                else:
                    raise ValueError(f"unsupported comparison in {text!r}")
                part = F.coalesce(part, F.lit(False))
                out, left = part if out is None else out & part, right
            return out
        if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id in _CALLS and len(node.args) == 1 and not node.keywords:
            return _CALLS[node.func.id](build(node.args[0]))
        raise ValueError(f"unsupported {type(node).__name__} in {text!r}")

    return build(tree.body)
