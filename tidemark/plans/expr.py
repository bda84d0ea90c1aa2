"""Expression grammar, type inference by structure, validation.

Grammar (JSON)::

    series leaf   {"series_code": "X"}            (or "seriesCode")
    series_math   {"op": add|subtract|multiply|ratio, "left": e, "right": e, "scale"?: number}
    window_op     {"op": sma|ema|sum|max|min|lag|shift, "series": e, "window": int >= 1}
    composite     {"op": sum|avg|max|min, "operands": [e, e, ...]}

``lag`` is calendar days (as-of backward); ``shift`` is a positional lag by
rows (our name for the row-shift primitive).  Divergences: a boolean
``window`` is rejected.

Messages follow the reference's wording because run status codes are
classified from them (see ``tidemark.sinks.ledger.classify_error``).
"""

from __future__ import annotations

import json

from tidemark.operators.arith import SERIES_MATH_OPS
from tidemark.operators.composite import COMPOSITE_OPS

EXPRESSION_TYPES = ("series_math", "window_op", "composite")
MAX_WINDOW = 2**31 - 1
WINDOW_OPS = ("sma", "ema", "sum", "max", "min", "lag", "shift")


class InvalidExpressionError(ValueError):
    pass


class ExpressionEvaluationError(ValueError):
    pass


def parse(expression) -> dict:
    if isinstance(expression, (str, bytes)):
        expression = json.loads(expression)
    if not isinstance(expression, dict):
        raise InvalidExpressionError(f"Cannot resolve operand: {expression}")
    return expression


def canonical(node) -> str:
    return json.dumps(node, sort_keys=True, separators=(",", ":"))


def leaf_code(operand: dict):
    return operand.get("series_code") or operand.get("seriesCode")


def infer_type(node: dict) -> str:
    """Type of a nested node from its fields, then from its op."""
    op = node.get("op")
    if "series" in node and "window" in node and op in WINDOW_OPS:
        return "window_op"
    if "operands" in node and op in COMPOSITE_OPS:
        return "composite"
    if "left" in node and "right" in node and op in SERIES_MATH_OPS:
        return "series_math"
    if op in SERIES_MATH_OPS:
        return "series_math"
    if op in COMPOSITE_OPS:
        return "composite"
    raise InvalidExpressionError(f"Unknown operation: {op}")


def check_type(expression_type) -> str:
    t = getattr(expression_type, "value", expression_type)
    if t not in EXPRESSION_TYPES:
        raise InvalidExpressionError(f"Unknown expression type: {expression_type}")
    return t


def check_op(node: dict, expression_type: str) -> str:
    op = node.get("op")
    if not op:
        raise InvalidExpressionError(f"Missing operation in {expression_type} expression")
    allowed = {"series_math": SERIES_MATH_OPS, "window_op": WINDOW_OPS,
               "composite": COMPOSITE_OPS}[expression_type]
    if op not in allowed:
        label = {"series_math": "series_math op", "window_op": "window_op",
                 "composite": "composite op"}[expression_type]
        raise InvalidExpressionError(f"Unknown {label}: {op}")
    return op


def check_window(node: dict) -> int:
    w = node.get("window")
    if isinstance(w, bool) or not isinstance(w, int) or not 1 <= w <= MAX_WINDOW:
        raise InvalidExpressionError(f"Invalid window: {w}")
    return w


def check_scale(node: dict) -> None:
    s = node.get("scale")
    if s is not None and (isinstance(s, bool) or not isinstance(s, (int, float))):
        raise InvalidExpressionError(f"Invalid scale: {s}")


def check_operands(node: dict) -> list:
    operands = node.get("operands") or []
    if not isinstance(operands, list) or len(operands) < 2:
        raise InvalidExpressionError("Composite requires at least 2 operands")
    return operands


def classify_operand(operand):
    """-> ("leaf", code) or ("node", type); raises like the reference."""
    if operand is None:
        raise InvalidExpressionError("Missing operand")
    if not isinstance(operand, dict):
        raise InvalidExpressionError(f"Cannot resolve operand: {operand}")
    code = leaf_code(operand)
    if code:
        return "leaf", code
    if "op" in operand:
        if not operand.get("op"):
            raise InvalidExpressionError("Missing operation in operand")
        return "node", infer_type(operand)
    raise InvalidExpressionError(f"Cannot resolve operand: {operand}")


def children(node: dict, expression_type: str) -> list:
    if expression_type == "series_math":
        return [node.get("left"), node.get("right")]
    if expression_type == "window_op":
        return [node.get("series")]
    return list(node.get("operands") or [])


def validate(expression, expression_type) -> list[str]:
    """Raise the first error in evaluation order; return leaf codes
    (in first-use order).  Pure Python, no Spark: runs before any job."""
    codes: list[str] = []

    def walk(node: dict, t: str) -> None:
        check_op(node, t)
        if t == "series_math":
            check_scale(node)
        if t == "window_op":
            check_window(node)
        if t == "composite":
            check_operands(node)
        for child in children(node, t):
            kind, what = classify_operand(child)
            if kind == "leaf":
                if what not in codes:
                    codes.append(what)
            else:
                walk(child, what)

    walk(parse(expression), check_type(expression_type))
    return codes
