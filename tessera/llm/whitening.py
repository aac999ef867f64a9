"""Embedding whitening with components from an exact characteristic polynomial.

Entries become integers, so sums and the scatter ``M = n * sum(x x') - S S'`` (n squared
times the covariance) are exact. The characteristic polynomial of M is found modulo many
31-bit primes (reduction to Hessenberg form, then its recurrence), one row of a Spark
table per prime, and put together by Chinese remaindering; the number of primes follows a
proven bound on the coefficients. All roots of it are real, so the sign changes of the
polynomial shifted to a point count the roots above that point, multiplicities included:
bisection on that count isolates the largest roots, and bisection on the sign refines
each to ``ROOT_BITS`` bits. Components are the null space of ``M - root``, by inverse
iteration in ``DIGITS``-digit arithmetic; roots that agree to ``SAME_BITS`` bits share an
orthonormal basis.

At scale: two narrow passes over the vectors (sums, then projection). A task of the first
sends one row per entry of the scatter's upper triangle, summed by Spark as exact
decimals. What reaches the driver depends on the dimension only: d (d + 3) / 2 + 1 sums,
and d + 1 residues per prime. The weights (components x d) travel with the closure.

Defined cases: a vector that is NULL, or holds NULL or a non-finite entry, is left out, and
so is one shorter than the longest; NULL and repeated ids are kept, each row with its own
output; an empty table (or one without a usable vector) gives no rows. Fewer dimensions
than ``components`` give fewer components. A component of variance zero has whitened 0 and
explained 0 and doesn't count in ``identity_error`` (NULL if no other is left).
``deviation`` is NULL where it exceeds a long; ``deviation_exact`` holds it as a decimal
then too. An entry too large for a long, or sums beyond 38 digits, stop the job.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from decimal import Context, Decimal, localcontext

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import written

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
ROOT_BITS = 256
SAME_BITS = 128
DIGITS = 120
PRIMES_PER_TASK = 8
_EXACT = 2 ** 53   # whole numbers a double holds
_LONG = 2 ** 63
_ROWS = 4096       # rows multiplied at once: entries below 2**20 keep products exact


# -- integers from vectors ---------------------------------------------------

def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``_id, _v`` (doubles) of the rows with a whole, finite, full-length vector."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).alias("_id"), v.alias("_v")).filter(fine & (F.size("_v") > 0))
    longest = rows.agg(F.max(F.size("_v"))).first()[0]
    return rows.filter(F.size("_v") == F.lit(longest)).withColumn("_d", F.lit(longest))


def whole(batch: pa.RecordBatch, dim: int, scale: int, offset: int) -> np.ndarray:
    """The batch's vectors as an integer matrix."""
    column = batch.column(batch.schema.get_field_index("_v"))
    x = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim)
    if x.size and np.abs(x).max() >= 2.0 ** 62:
        raise ValueError("an entry does not fit a long")
    return x.astype(np.int64) + offset


def gram(x: np.ndarray) -> np.ndarray:
    """x'x exactly, as Python integers."""
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for at in range(0, len(x), _ROWS):
        part = x[at:at + _ROWS]
        if np.abs(part).max() < 2 ** 20:
            f = part.astype(np.float64)
            total = total + (f.T @ f).astype(np.int64).astype(object)
        else:
            o = part.astype(object)
            total = total + o.T @ o
    return total


def exact_sums(rows: DataFrame, dim: int, scale: int = SCALE, offset: int = OFFSET) -> tuple[int, list[int], list[list[int]]]:
    """Number of vectors, their sums and their scatter ``n * sum(x x') - S S'``."""
    upper = np.triu_indices(dim)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for b in batches:
            x = whole(b, dim, scale, offset)
            n += len(x)
            sums = sums + x.astype(object).sum(axis=0) if len(x) else sums
            products = products + gram(x)
        if n:
            values = [n, *sums.tolist(), *products[upper].tolist()]
            yield pa.record_batch([pa.array(range(len(values)), pa.int32()),
                                   pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))], ["place", "value"])

    total = rows.select("_v").mapInArrow(partial, "place int, value decimal(38,0)").groupBy("place").agg(F.sum("value").alias("value"))
    values = {r["place"]: int(r["value"]) for r in total.collect()}  # d (d + 3) / 2 + 1 rows
    n, sums = values[0], [values[1 + i] for i in range(dim)]
    scatter = [[0] * dim for _ in range(dim)]
    for k, (i, j) in enumerate(zip(*upper)):
        scatter[i][j] = scatter[j][i] = n * values[1 + dim + k] - sums[i] * sums[j]
    return n, sums, scatter


# -- characteristic polynomial -------------------------------------------------

def primes_below(top: int, product: int) -> list[int]:
    """The largest primes below ``top`` (at most 2**31) whose product exceeds ``product``."""
    def is_prime(n: int) -> bool:
        if any(n % q == 0 for q in (2, 3, 5, 7)):
            return n in (2, 3, 5, 7)
        r = ((n - 1) & -(n - 1)).bit_length() - 1
        for base in (2, 3, 5, 7):  # these decide all n below 3.2e9
            y = pow(base, (n - 1) >> r, n)
            if y not in (1, n - 1) and all((y := y * y % n) != n - 1 for _ in range(r - 1)):
                return False
        return True

    found, have, n = [], 1, top
    while have <= product:
        n -= 1
        if is_prime(n):
            found.append(n)
            have *= n
    return found


def coefficient_bound(trace: int, dim: int) -> int:
    """No coefficient is larger: all roots are >= 0, so the k-th elementary symmetric
    sum is at most C(d, k) (trace / d)**k (Maclaurin)."""
    return max(math.comb(dim, k) * trace ** k // dim ** k + 1 for k in range(dim + 1))


def charpoly_mod(matrix: list[list[int]], primes: np.ndarray) -> np.ndarray:
    """Coefficients (ascending powers) of det(t - matrix) modulo each prime: [primes, d + 1]."""
    d, b = len(matrix), len(primes)
    p = primes.astype(np.int64)
    h = np.array([[[v % int(q) for v in row] for row in matrix] for q in p], np.int64).reshape(b, d, d)
    each, p1, p2 = np.arange(b), p[:, None], p[:, None, None]

    def inverse(values):
        return np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(values, p)], np.int64)

    for m in range(1, d - 1):  # Hessenberg form by similarity
        pivot = m + np.argmax(h[:, m:, m - 1] != 0, axis=1)
        rows = h[each, pivot].copy()
        h[each, pivot] = h[:, m]
        h[:, m] = rows
        cols = h[each, :, pivot].copy()
        h[each, :, pivot] = h[:, :, m]
        h[:, :, m] = cols
        u = h[:, m + 1:, m - 1] * inverse(h[:, m, m - 1])[:, None] % p1
        h[:, m + 1:] = (h[:, m + 1:] - u[:, :, None] * h[:, m:m + 1] % p2) % p2
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * u[:, None, :] % p2).sum(axis=2)) % p1
    polys = [np.zeros((b, d + 1), np.int64)]
    polys[0][:, 0] = 1
    for k in range(d):
        last = polys[-1]
        new = np.zeros_like(last)
        new[:, 1:] = last[:, :-1]
        new = (new - h[:, k, k][:, None] * last % p1) % p1
        t = np.ones(b, np.int64)
        for i in range(k - 1, -1, -1):
            t = t * h[:, i + 1, i] % p
            new = (new - (t * h[:, i, k] % p)[:, None] * polys[i] % p1) % p1
        polys.append(new)
    return polys[-1]


def remainder_theorem(residues: list[list[int]], primes: list[int]) -> list[int]:
    """The integers nearest zero with the given residues."""
    product = math.prod(primes)
    out = [0] * len(residues[0])
    for row, q in zip(residues, primes):
        rest = product // q
        unit = rest * pow(rest, -1, q)
        out = [(a + unit * int(r)) % product for a, r in zip(out, row)]
    return [a - product if a > product // 2 else a for a in out]


def charpoly(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Exact characteristic polynomial (ascending powers) of a positive semi-definite
    integer matrix; the primes are shared out over the cluster."""
    dim = len(matrix)
    primes = primes_below(2 ** 31, 2 * coefficient_bound(sum(matrix[i][i] for i in range(dim)), dim))

    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), PRIMES_PER_TASK):
                q = f["prime"].to_numpy()[at:at + PRIMES_PER_TASK]
                yield pd.DataFrame({"prime": q, "residues": list(charpoly_mod(matrix, q))})

    tasks = math.ceil(len(primes) / PRIMES_PER_TASK)
    table = spark.createDataFrame([(i, q) for i, q in enumerate(primes)], "i long, prime long").repartition(tasks, "i").select("prime")
    found = {r["prime"]: r["residues"] for r in table.mapInPandas(reduce, "prime long, residues array<long>").collect()}
    return remainder_theorem([found[q] for q in primes], primes)


# -- roots ---------------------------------------------------------------------

def roots_above(coefs: list[int], num: int, bits: int) -> int:
    """Roots greater than ``num / 2**bits``, each as often as it is one. Exact for a
    polynomial with real roots only: shifted there, its sign changes are that number."""
    d = len(coefs) - 1
    c = [v << bits * (d - j) for j, v in enumerate(coefs)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += num * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(coefs: list[int], num: int, bits: int) -> int:
    d, acc = len(coefs) - 1, 0
    for j in range(d, -1, -1):
        acc = acc * num + (coefs[j] << bits * (d - j))
    return (acc > 0) - (acc < 0)


def largest_roots(coefs: list[int], most: int, bits: int = ROOT_BITS) -> list[tuple[int, int]]:
    """The ``most`` largest roots, falling, as ``(num, s)`` for ``num / 2**s``, to
    ``bits`` bits. ``coefs`` (ascending, monic) has real roots >= 0 only."""
    zeros = next(j for j, v in enumerate(coefs) if v)
    c = coefs[zeros:]
    d, found = len(c) - 1, []
    top = -c[-2] if d else 0  # the sum of the roots
    todo = [(0, top, 0, d, 0)] if d else []  # (lo, hi] with the roots above either end
    while todo and len(found) < most:
        lo, hi, s, above_lo, above_hi = todo.pop()
        if above_lo == above_hi:
            continue
        close = lo > 0 and (hi - lo) << bits < lo
        if above_lo - above_hi > 1 and not close:
            mid, s = lo + hi, s + 1
            above = roots_above(c, mid, s)
            todo += [(2 * lo, mid, s, above_lo, above), (mid, 2 * hi, s, above, above_hi)]
            continue
        if above_lo - above_hi == 1:
            right = -1 if above_hi % 2 else 1  # the sign between this root and the next
            if sign_at(c, hi, s) == 0:
                lo = hi
            while not (lo > 0 and (hi - lo) << bits < lo):
                mid, lo, hi, s = lo + hi, 2 * lo, 2 * hi, s + 1
                at = sign_at(c, mid, s)
                lo, hi = (mid, mid) if at == 0 else (lo, mid) if at == right else (mid, hi)
        found += [(lo + hi, s + 1)] * (above_lo - above_hi)
    return (found + [(0, 0)] * zeros)[:most]


# -- components ------------------------------------------------------------------

def _null_space(matrix: list[list[int]], root: Decimal, size: int) -> list[np.ndarray]:
    """Orthonormal basis (``size`` vectors) of what ``matrix - root`` almost maps to zero."""
    d = len(matrix)
    lu = np.array([[Decimal(v) for v in row] for row in matrix], object).reshape(d, d)
    norm = max(max(abs(v) for v in row) for row in lu) or Decimal(1)
    for i in range(d):
        lu[i, i] -= root
    order = np.arange(d)
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(lu[i, k]))
        lu[[k, best]], order[[k, best]] = lu[[best, k]], order[[best, k]]
        if lu[k, k] == 0:
            lu[k, k] = norm.scaleb(20 - DIGITS)
        lu[k + 1:, k] = lu[k + 1:, k] / lu[k, k]
        lu[k + 1:, k + 1:] -= np.outer(lu[k + 1:, k], lu[k, k + 1:])

    def solve(b):
        y = b[order]
        for k in range(d):
            y[k + 1:] = y[k + 1:] - lu[k + 1:, k] * y[k]
        for k in range(d - 1, -1, -1):
            y[k] = y[k] / lu[k, k]
            y[:k] = y[:k] - lu[:k, k] * y[k]
        return y

    draw = random.Random(d * 1000 + size)
    basis = [np.array([Decimal(draw.randrange(1, 1 << 30)) for _ in range(d)], object) for _ in range(size)]
    for _ in range(3):
        done: list[np.ndarray] = []
        for v in basis:
            v = solve(v)
            v = v / max(abs(x) for x in v)
            for _again in range(2):
                for w in done:
                    v = v - w * (v * w).sum()
            done.append(v / (v * v).sum().sqrt())
        basis = done
    return basis


def components(spark: SparkSession, matrix: list[list[int]], most: int = COMPONENTS) -> tuple[list[Decimal], list[list[Decimal]]]:
    """The largest eigenvalues, falling, and their unit eigenvectors (the largest entry
    of each is positive) of a positive semi-definite integer matrix."""
    roots = largest_roots(charpoly(spark, matrix), most)
    with localcontext(Context(prec=DIGITS, Emax=10 ** 9, Emin=-10 ** 9)):
        values = [Decimal(num) / Decimal(2) ** s for num, s in roots]
        vectors: list[list[Decimal]] = []
        while len(vectors) < len(values):
            at = len(vectors)
            near = Decimal(2) ** -SAME_BITS * values[at]
            size = sum(1 for v in values[at:] if values[at] - v <= near)
            for v in _null_space(matrix, values[at], size):
                lead = max(range(len(v)), key=lambda i: (abs(v[i]), -i))
                vectors.append([x if v[lead] > 0 else -x for x in v])
        return values, vectors


# -- whitening --------------------------------------------------------------------

SCHEMA = "vec_id long, component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS,
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """One row per usable vector and component: see ``SCHEMA`` and the module's docstring."""
    spark = vectors.sparkSession
    id_type = vectors.select(F.col(id_col)).schema[0].dataType.simpleString()
    schema = SCHEMA.replace("vec_id long", f"vec_id {id_type}")
    rows = usable(vectors, id_col, vec_col)
    first = rows.select("_d").first()
    if first is None:
        return spark.createDataFrame([], schema)
    dim = first["_d"]
    n, sums, scatter = exact_sums(rows, dim, scale, offset)
    values, axes = components(spark, scatter, min(most, dim))
    with localcontext(Context(prec=DIGITS)):
        trace = Decimal(sum(scatter[i][i] for i in range(dim)))
        weights = np.array([[float(x / e.sqrt()) if e > 0 else 0.0 for x in v] for e, v in zip(values, axes)])
        explained = [float(e / trace) if trace > 0 else 0.0 for e in values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = whole(b, dim, scale, offset)
            wide = len(x) and n * int(np.abs(x).max()) + max(map(abs, sums)) >= _LONG // 2
            y = x.astype(object) * n - np.array(sums, object) if wide else x * n - np.array(sums, np.int64)
            if not wide and dim * (int(np.abs(y).max(initial=0)) ** 2) < _LONG:
                square = (y * y).sum(axis=1).tolist()
            else:
                o = y.astype(object)
                square = (o * o).sum(axis=1).tolist()
            out = (y.astype(np.float64) @ weights.T).reshape(-1)
            places = pa.array(np.arange(len(x) + 1) * len(weights), pa.int32())
            yield pa.record_batch([b.column(b.schema.get_field_index("_id")),
                                   pa.array([v if v < _LONG else None for v in square], pa.int64()),
                                   pa.array([Decimal(v) for v in square], pa.decimal128(38, 0)),
                                   pa.ListArray.from_arrays(places, pa.array(out, pa.float64()))],
                                  ["vec_id", "deviation", "deviation_exact", "_w"])

    wide_rows = written(rows.mapInArrow(
        project, f"vec_id {id_type}, deviation long, deviation_exact decimal(38,0), _w array<double>"), "whitened")
    return (wide_rows.select("vec_id", "deviation", "deviation_exact", F.posexplode("_w").alias("_k", "whitened"))
            .select("vec_id", (F.col("_k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
                    "deviation", "deviation_exact", "whitened",
                    F.element_at(F.array(*[F.lit(e) for e in explained]), F.col("_k") + 1).alias("explained"),
                    F.lit(identity_error(wide_rows, [k for k, e in enumerate(values) if e > 0])).cast("double").alias("identity_error")))


def identity_error(wide_rows: DataFrame, live: list[int]) -> float | None:
    """Largest absolute entry of (covariance of the whitened columns ``live`` - identity)."""
    if not live:
        return None
    entries = [F.abs(F.covar_pop(F.col("_w")[i], F.col("_w")[j]) - float(i == j)) for i in live for j in live if i <= j]
    return wide_rows.agg(F.array_max(F.array(*entries))).first()[0]
