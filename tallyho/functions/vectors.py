"""Column expressions for dense vectors and per-row losses.

Dense vectors live in ``ARRAY<DOUBLE>`` columns.  A model vector that the
driver holds (a d-vector, d small) is inlined as literals so the dot product
is a plain arithmetic expression that whole-stage codegen compiles; only
when both operands are columns do we fall back to the higher-order
``aggregate(zip_with(...))`` form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _checked(value: Column, d: int, *vectors: Column) -> Column:
    """``value`` if every vector has ``d`` entries, null if one is null;
    vectors of another length make the query fail instead of being cut."""
    fits, missing = F.size(vectors[0]) == d, vectors[0].isNull()
    for v in vectors[1:]:
        fits, missing = fits & (F.size(v) == d), missing | v.isNull()
    wrong = F.raise_error(F.lit(f"vectors must have {d} entries")).cast("double")
    return F.when(missing, F.lit(None)).when(fits, value).otherwise(wrong)


def literal_dot(x: Column | str, coeffs: Sequence[float]) -> Column:
    """``<x, coeffs>`` for an array column ``x`` and driver-side coefficients."""
    x = _col(x)
    terms = [x.getItem(i) * F.lit(float(c)) for i, c in enumerate(coeffs)]
    if not terms:
        return F.lit(0.0)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return _checked(total, len(terms), x)


def column_dot(a: Column | str, b: Column | str, d: int | None = None) -> Column:
    """``<a, b>`` for two array columns; unrolled when the length ``d`` is known."""
    a, b = _col(a), _col(b)
    if d is not None:
        total = a.getItem(0) * b.getItem(0)
        for k in range(1, d):
            total = total + a.getItem(k) * b.getItem(k)
        return _checked(total, d, a, b)
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def log1pexp(z: Column) -> Column:
    """Numerically stable ``log(1 + exp(z))`` (finite for |z| up to 1e308)."""
    return F.when(z > 0, z + F.log1p(F.exp(-z))).otherwise(F.log1p(F.exp(z)))


def logistic_loss(y: Column | str, margin: Column | str) -> Column:
    """``log(1 + exp(-y * margin))``."""
    return log1pexp(-_col(y) * _col(margin))


def logistic_weight(y: Column | str, margin: Column | str) -> Column:
    """Scalar part of the logistic-loss gradient: ``-y / (1 + exp(y * margin))``."""
    y, m = _col(y), _col(margin)
    return -y / (F.lit(1.0) + F.exp(y * m))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
