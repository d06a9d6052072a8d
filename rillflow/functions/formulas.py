"""Equations given as text, compiled to column expressions.

Regional curves and other equations come from parameter tables.  They are parsed to a syntax tree of which only
arithmetic, names, numbers and a few functions are allowed, so nothing is ever evaluated as code, and the result is
a Catalyst expression.
"""

from __future__ import annotations

import ast
import math
import operator
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_BINARY = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: lambda a, b: a / F.nullif(b, F.lit(0.0)), ast.Pow: F.pow, ast.Mod: operator.mod}
_CALLS = {"exp": F.exp, "log": F.log, "log10": F.log10, "sqrt": F.sqrt, "abs": F.abs, "ceil": F.ceil, "floor": F.floor, "round": F.round, "min": F.least, "max": F.greatest}


class FormulaError(ValueError):
    """The text is no formula, or one with unknown names."""


def names_in(text: str) -> set[str]:
    return {n.id for n in ast.walk(_parse(text)) if isinstance(n, ast.Name) and n.id not in _CALLS}


def _parse(text: str) -> ast.expr:
    try:
        return ast.parse(text.replace("^", "**").strip(), mode="eval").body
    except (SyntaxError, AttributeError) as e:
        raise FormulaError(f"not a formula: {text!r}") from e


def formula(text: str, columns: Mapping[str, Column]) -> Column:
    """A double column; division by zero, infinite and undefined results are null."""

    def build(node: ast.expr) -> Column:
        match node:
            case ast.Constant(value=int() | float() as v) if not isinstance(v, bool) and math.isfinite(v):
                return F.lit(float(v))
            case ast.Name(id=name):
                if name not in columns:
                    raise FormulaError(f"unknown name {name!r} in {text!r}")
                return columns[name].cast("double")
            case ast.BinOp(left=a, op=op, right=b) if type(op) in _BINARY:
                return _BINARY[type(op)](build(a), build(b))
            case ast.UnaryOp(op=ast.USub(), operand=a):
                return -build(a)
            case ast.UnaryOp(op=ast.UAdd(), operand=a):
                return build(a)
            case ast.Call(func=ast.Name(id=name), args=args, keywords=[]) if name in _CALLS and args:
                if name == "round" and len(args) == 2 and isinstance(args[1], ast.Constant):
                    return F.round(build(args[0]), int(args[1].value))
                return _CALLS[name](*map(build, args))
        raise FormulaError(f"not allowed in a formula: {text!r}")

    out = build(_parse(text)).cast("double")
    return F.when(~F.isnan(out) & (F.abs(out) < math.inf), out)


def evaluate(text: str, values: Mapping[str, float] | None = None) -> float:
    """One number from constants, on the driver; for checking parameter tables."""
    values = dict(values or {})
    ops = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv, ast.Pow: operator.pow}

    def run(node: ast.expr) -> float:
        match node:
            case ast.Constant(value=int() | float() as v) if not isinstance(v, bool):
                return float(v)
            case ast.Name(id=name) if isinstance(values.get(name), (int, float)):
                return float(values[name])
            case ast.BinOp(left=a, op=op, right=b) if type(op) in ops:
                return ops[type(op)](run(a), run(b))
            case ast.UnaryOp(op=ast.USub(), operand=a):
                return -run(a)
            case ast.Call(func=ast.Name(id=name), args=[a]) if name in ("exp", "log", "log10", "sqrt"):
                return getattr(math, name)(run(a))
        raise FormulaError(f"can't evaluate {text!r}")

    try:
        out = run(_parse(text))
    except (ZeroDivisionError, OverflowError, TypeError, ValueError) as e:
        raise FormulaError(str(e)) from e
    if isinstance(out, complex) or not math.isfinite(out):
        raise FormulaError(f"{text!r} isn't finite")
    return out


def regional_curve(text: str, parameters: Mapping[str, float], drainage: Column, cubic_metres: bool = False) -> Column:
    """Discharge from an equation in DRNAREA and a watershed's parameters."""
    q = formula(text, {**{k: F.lit(float(v)) for k, v in parameters.items()}, "DRNAREA": drainage})
    return q * 0.028316846592 if cubic_metres else q


def bankfull_width(drainage: Column, precipitation: Column) -> Column:
    """Square kilometres and millimetres to metres."""
    return formula("0.177 * (a ** 0.397) * (p ** 0.453)", {"a": drainage, "p": precipitation})
