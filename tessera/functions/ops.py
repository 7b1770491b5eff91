"""Scalar feature operators (A1-A13, A17, A21) as native Column builders.

All arithmetic runs in double so ANSI mode never raises on long overflow;
division by zero yields null through ``try_divide``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def _d(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# --- A1-A6: the named operations ------------------------------------------------

def subtract(cols: list[str]) -> Column:
    return _d(cols[0]) - _d(cols[1])


def add(cols: list[str]) -> Column:
    """n-ary sum; null when any input is null (as pandas)."""
    return reduce(lambda a, b: a + b, [_d(c) for c in cols])


def multiply(cols: list[str]) -> Column:
    return reduce(lambda a, b: a * b, [_d(c) for c in cols])


def divide(cols: list[str]) -> Column:
    """in[0] / in[1]; a zero denominator gives null."""
    return F.try_divide(_d(cols[0]), _d(cols[1]))


def divide_percent(cols: list[str]) -> Column:
    return divide(cols) * F.lit(100.0)


def log1p(cols: list[str]) -> Column:
    return F.log1p(_d(cols[0]))


OPERATIONS: dict[str, Callable[[list[Column]], Column]] = {
    "subtract": subtract,
    "add": add,
    "multiply": multiply,
    "divide": divide,
    "divide_percent": divide_percent,
    "log": log1p,
}


def get_operation(name: str) -> Callable[[list[Column]], Column]:
    """Look up an operation; unknown names raise ValueError."""
    if name not in OPERATIONS:
        raise ValueError(f"Operation '{name}' not found. Available: {list(OPERATIONS)}")
    return OPERATIONS[name]


def register_operation(name: str, fn: Callable[[list[Column]], Column]) -> None:
    """Add a user operation (a builder from input columns to a Column)."""
    OPERATIONS[name] = fn


def apply_operations(df: DataFrame, operations: Iterable[Mapping], on_error: str = "skip"
                     ) -> tuple[DataFrame, list[dict]]:
    """Apply an ordered operation list; later ops see earlier outputs.

    Each op is ``{name?, operation|type, inputs, output}``. Ops without a name
    are skipped. With ``on_error="skip"`` (training) failures are logged and
    the op is left out, as are ops whose inputs are missing (a warning; not
    reported as applied); with ``"raise"`` (scoring) all of these raise.
    All outputs land in one projection.
    """
    exprs: dict[str, Column] = {}
    available = set(df.columns)
    applied: list[dict] = []
    out = df
    for op in operations:
        op_name = op.get("operation") or op.get("type")
        if not op_name:
            log.warning("operation without 'operation' field: %s", op)
            continue
        try:
            fn = get_operation(op_name)
            inputs, output = list(op["inputs"]), op["output"]
            missing = [c for c in inputs if c not in available]
            if missing:
                if on_error == "raise":
                    raise ValueError(f"operation {op_name}: missing inputs {missing}")
                log.warning("operation %s skipped: missing inputs %s", op_name, missing)
                continue
            if any(c in exprs for c in inputs):
                # depends on a pending output: materialise that level first
                out, exprs = out.withColumns(exprs), {}
            exprs[output] = fn([F.col(c) for c in inputs])
            available.add(output)
            applied.append({"name": op.get("name", op_name), "output": output, "inputs": inputs})
        except Exception:
            if on_error == "raise":
                raise
            log.exception("failed to apply operation %s", op_name)
    return (out.withColumns(exprs) if exprs else out), applied


# --- A9-A13: ratios and flags ---------------------------------------------------

def ratio(a: str | Column, b: str | Column, rule: str = "zero") -> Column:
    """A9. rule ``zero``: 0 when the denominator is 0; ``null``: x/0 -> null
    (the reference gives inf there); ``fill0``: nulls filled with 0 first."""
    num, den = _d(a), _d(b)
    if rule == "fill0":
        num, den = F.coalesce(num, F.lit(0.0)), F.coalesce(den, F.lit(0.0))
        return F.when(den == 0, F.lit(0.0)).otherwise(num / den)
    if rule == "zero":
        return F.when(den == 0, F.lit(0.0)).otherwise(num / den)
    if rule == "null":
        return F.try_divide(num, den)
    raise ValueError(f"unknown ratio rule {rule}")


def is_one(c: str | Column) -> Column:
    """Null-safe ``c == 1`` (null counts as not set, as in pandas)."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c) == 1, F.lit(False))


def flag_or(*cols: str | Column) -> Column:
    """A10: 1 when any 0/1 flag is set."""
    return reduce(lambda a, b: a | b, [is_one(c) for c in cols]).cast("int")


def flag_and(*predicates: Column) -> Column:
    """1 when all predicates hold (null -> 0)."""
    return F.coalesce(reduce(lambda a, b: a & b, predicates), F.lit(False)).cast("int")


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Sum of w_i * flag_i with nulls as 0."""
    return reduce(lambda a, b: a + b,
                  [F.coalesce(_d(c), F.lit(0.0)) * F.lit(float(w)) for c, w in weights.items()])


def row_sum(cols: Iterable[str | Column]) -> Column:
    """Row-wise sum, nulls skipped, all-null -> 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_d(c), F.lit(0.0)) for c in cols])


# --- A17, A21 -------------------------------------------------------------------

def symlog(c: str | Column) -> Column:
    x = _d(c)
    return F.signum(x) * F.log1p(F.abs(x))


def symexp(c: str | Column) -> Column:
    x = _d(c)
    return F.signum(x) * F.expm1(F.abs(x))
