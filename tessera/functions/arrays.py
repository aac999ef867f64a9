"""JVM-side array expressions over tensor columns (no Python in the plan).

These cover scaling, one-hot labels, arg-max and small dense/softmax layers
written with higher-order functions: rows never leave the JVM. Lambdas are
interpreted, so this is for small layers. Large layers run in NumPy over Arrow batches (``tessera.functions.layers``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: lambdas compute
    what they refer to again for every element, a bound variable is only read."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def to_double(arr: str | Column) -> Column:
    return _col(arr).cast("array<double>")


def scale_range(arr: str | Column, in_lo: float = 0.0, in_hi: float = 255.0,
                lo: float = 0.0, hi: float = 1.0) -> Column:
    """Linear map of every element from [in_lo, in_hi] to [lo, hi]."""
    span = (hi - lo) / (in_hi - in_lo)
    return F.transform(to_double(arr), lambda x: F.lit(lo) + (x - F.lit(in_lo)) * F.lit(span))


def one_hot(label_idx: str | Column, n: int) -> Column:
    """Vector of ``n`` doubles with 1.0 at ``label_idx``; out of range is an error."""
    idx = _col(label_idx)
    checked = F.when((idx >= 0) & (idx < n), idx).otherwise(
        F.raise_error(F.concat(F.lit("label index out of range: "), idx.cast("string"))))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == checked).cast("double"))


def argmax(arr: str | Column) -> Column:
    """0-based index of the largest element; the first one wins ties."""
    a = _col(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def array_sum(arr: str | Column) -> Column:
    return F.aggregate(to_double(arr), F.lit(0.0), lambda acc, x: acc + x)


def relu(arr: str | Column) -> Column:
    return F.transform(_col(arr), lambda x: F.greatest(x, F.lit(0.0)))


def dense(arr: str | Column, weights: np.ndarray, bias: np.ndarray) -> Column:
    """``W x + b`` for a weight matrix ``[n_out, n_in]`` held as literals.

    For small layers only (the literal is part of the plan)."""
    rows = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in weights])
    b = F.array(*[F.lit(float(v)) for v in bias.reshape(-1)])

    def unit(x, row, c):
        return F.aggregate(F.zip_with(x, row, lambda a, v: a * v), F.lit(0.0), lambda acc, y: acc + y) + c

    return _let(to_double(arr), lambda x: F.zip_with(rows, b, lambda row, c: unit(x, row, c)))


def softmax(arr: str | Column) -> Column:
    """Max-shifted softmax of a logit vector, linear in its length."""
    return _let(_col(arr), lambda z: _let(F.array_max(z), lambda m: _let(
        F.transform(z, lambda v: F.exp(v - m)), lambda e: _let(
            F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v), lambda s: F.transform(e, lambda v: v / s)))))


def nll(probs: str | Column, label_idx: str | Column, eps: float = 1e-15) -> Column:
    """Negative log-likelihood of the true class for one row."""
    p = F.element_at(_col(probs), _col(label_idx) + 1)
    return -F.log(F.greatest(p, F.lit(eps)))

