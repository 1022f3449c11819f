"""Expression text for wide per-label expressions.

Per-label work is K (or K x |T|, K x d) scalar expressions.  Built node by
node with the Column API, every node is a round trip to the JVM (and another
one when the Python handle is collected), which made plan construction cost
more than running the plan.  Here the same expressions are written as Spark
SQL expression text and handed over once per output column (``F.expr`` /
``selectExpr``); Catalyst parses and optimises them exactly like the Column
form, and they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ident(name: str) -> str:
    """Quoted column name."""
    return "`" + name.replace("`", "``") + "`"


def lit(v) -> str:
    """A typed literal: double (``D``), int/bigint, string, boolean, null."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v) if -(2 ** 31) <= v < 2 ** 31 else f"{v}L"
    if isinstance(v, float):
        if math.isnan(v):
            return "CAST('NaN' AS DOUBLE)"
        if math.isinf(v):
            return "CAST('Infinity' AS DOUBLE)" if v > 0 else "CAST('-Infinity' AS DOUBLE)"
        return f"{v!r}D"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"no literal for {type(v).__name__}")


def elem(col: str, i: int) -> str:
    """Element i (0-based) of an array column."""
    return f"{ident(col)}[{i}]"


def fsum(parts: Sequence[str]) -> str:
    """Left-to-right sum in the given (fixed) order."""
    return "(" + " + ".join(f"({p})" for p in parts) + ")"


def all_of(parts: Sequence[str]) -> str:
    return "(" + " AND ".join(f"({p})" for p in parts) + ")"


def safe_div(a: str, b: str) -> str:
    """a / b as double, 0.0 when b is zero (zero_division=0); the division is
    never evaluated on a zero divisor, so ANSI mode cannot raise."""
    return (f"(CASE WHEN ({b}) = 0 THEN 0.0D "
            f"ELSE CAST(({a}) AS DOUBLE) / CAST(({b}) AS DOUBLE) END)")


def above(p: str, t, op: str = "gt") -> str:
    """Positive decision: strict ``p > t`` (evaluation) or ``p >= t`` (serving).

    A missing score, null or NaN, is never positive, so every cell is either
    predicted or not.  ``t`` is a number or SQL text (a threshold column)."""
    if op not in ("gt", "ge"):
        raise ValueError(f"op must be 'gt' or 'ge', not {op!r}")
    limit = t if isinstance(t, str) else lit(float(t))
    return f"coalesce(({p}) {'>' if op == 'gt' else '>='} {limit} AND NOT isnan({p}), false)"


def score_or_lowest(p: str) -> str:
    """The score, minus infinity when it is missing (null or NaN): below every threshold and rank."""
    return f"CASE WHEN ({p}) IS NULL OR isnan({p}) THEN CAST('-Infinity' AS DOUBLE) ELSE ({p}) END"


def as_int(cond: str) -> str:
    return f"CAST({cond} AS INT)"


def named_struct(fields: Iterable[tuple]) -> str:
    return "named_struct(" + ", ".join(f"{lit(n)}, {e}" for n, e in fields) + ")"


def inline_rows(structs: Sequence[str]) -> Column:
    """One output row per struct (all structs share one schema)."""
    return F.expr("inline(array(" + ", ".join(structs) + "))")


def array_of(items: Sequence[str]) -> str:
    return "array(" + ", ".join(items) + ")"


def sigmoid(z: str) -> str:
    return f"(1.0D / (1.0D + exp(-({z}))))"


def count_below(x: str, ts: Sequence[float], inclusive: bool = False) -> str:
    """#{t in ts : t < x} (or t <= x) for ascending distinct ts, as a balanced
    CASE tree: log2(|ts|) comparisons per value."""
    def cmp(t):
        return f"{lit(float(t))} <= ({x})" if inclusive else f"{lit(float(t))} < ({x})"

    def rec(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi + 1) // 2
        return f"CASE WHEN {cmp(ts[mid - 1])} THEN {rec(mid, hi)} ELSE {rec(lo, mid - 1)} END"
    return rec(0, len(ts))


# --- label vectors (``vec`` is SQL text of an array<int>) ---------------------------

def binarize(score: str, k: int, ts: Sequence[float], op: str = "gt") -> str:
    """Scores -> 0/1 int vector with one threshold per label."""
    return array_of([as_int(above(elem(score, i), ts[i], op)) for i in range(k)])


def vec_elem(vec: str, i: int) -> str:
    return f"({vec})[{i}]"


def vector_sum(vec: str, k: int) -> str:
    return "(" + " + ".join(vec_elem(vec, i) for i in range(k)) + ")"


def decode_names(vec: str, names: Sequence[str], empty_as: str | None = None, sep: str = ",") -> str:
    """Vector -> names of its 1 entries joined by ``sep``; empty -> ``empty_as``."""
    parts = ", ".join(f"CASE WHEN {vec_elem(vec, i)} = 1 THEN {lit(n)} END" for i, n in enumerate(names))
    joined = f"concat_ws({lit(sep)}, {parts})"
    if empty_as is None:
        return joined
    return f"(CASE WHEN {joined} = '' THEN {lit(empty_as)} ELSE {joined} END)"


def vector_key(vec: str, k: int) -> str:
    """Vector rendered as '0,1,0': orders like the vector itself (0/1 entries)."""
    return "concat_ws(',', " + ", ".join(f"CAST({vec_elem(vec, i)} AS STRING)" for i in range(k)) + ")"
