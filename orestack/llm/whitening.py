"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orestack.llm.common import saved

SCALE, OFFSET = 64, 1_000_000  # x = floor(SCALE * c) + OFFSET
LARGEST = 2.0 ** 53  # of SCALE * c; greater ones count as this
ROOT_BITS = 160  # a root is isolated to this many bits
SAME_BITS = 80  # roots that agree to so many bits share a null space
DIGITS = 80  # of the solutions of inverse iteration
LIMBS = 7  # of 32 bits, of an exact sum that Spark adds up
_SUM = ", ".join(f"l{i} long" for i in range(LIMBS))


# -- exact sums ---------------------------------------------------------------------------------

def limbs(value: int) -> list[int]:
    """The value in base 2 to the 32, lowest first; the last one carries the sign."""
    return [(value >> 32 * i) & 0xFFFFFFFF for i in range(LIMBS - 1)] + [value >> 32 * (LIMBS - 1)]


def added(parts: DataFrame, *keys: str) -> dict[tuple, int]:
    """The exact sums of ``limbs`` per key."""
    sums = parts.groupBy(*keys).agg(*(F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)))
    return {tuple(r[k] for k in keys): sum(r[f"l{i}"] << 32 * i for i in range(LIMBS)) for r in sums.collect()}


def product(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` without rounding, as Python integers."""
    top = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if top < 1 << 53:
        wide = y.astype(float)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = y if top < 1 << 62 else y.astype(object)
    return (wide.T @ wide).astype(object)


def stacked(column: pd.Series, dim: int) -> np.ndarray:
    return np.array(column.to_list(), np.int64).reshape(len(column), dim)


# -- characteristic polynomial --------------------------------------------------------------------

def primes(count: int) -> list[int]:
    """The largest primes below 2 to the 31, whose products of residues fit 64 bits."""
    found, n = [], (1 << 31) - 1
    while len(found) < count:
        odd, twos = n - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        if all(pow(a, odd, n) == 1 or any(pow(a, odd << i, n) == n - 1 for i in range(twos)) for a in (2, 3, 5, 7)):
            found.append(n)
        n -= 2
    return found


def hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A matrix of Hessenberg form that is similar to the given one, modulo ``p``."""
    h = matrix.copy()
    for k in range(len(h) - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(axis=1)) % p
    return h


def characteristic(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of ``det(t - matrix)`` modulo ``p``, constant first."""
    h, d = hessenberg(matrix, p), len(matrix)
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - h[k - 1, k - 1] * polys[k - 1]) % p
        chain, factors = 1, np.zeros(k - 1, np.int64)
        for i in range(k - 1, 0, -1):
            chain = chain * int(h[i, i - 1]) % p
            factors[i - 1] = chain * int(h[i - 1, k - 1]) % p
        polys[k] = (polys[k] - (polys[:k - 1] * factors[:, None] % p).sum(axis=0)) % p
    return polys[d]


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of the characteristic polynomial of an integer matrix without negative eigenvalues, constant first.

    Spark tasks take a prime each; the residues are joined by Chinese remaindering. The k-th symmetric sum of
    numbers that are not negative is at most that of equal numbers with the same sum, which bounds the primes
    needed. One prime more checks the result.
    """
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bits = max((math.comb(d, k) * -(-trace // d) ** k).bit_length() for k in range(d + 1)) + 1
    chosen = primes(-(-bits // 30) + 1)

    def residues(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            reduced = [characteristic(np.array([[v % p for v in row] for row in matrix], np.int64), p)
                       for p in batch["p"].tolist()]
            yield pd.DataFrame({"p": batch["p"], "c": [r.tolist() for r in reduced]})

    tasks = min(len(chosen), spark.sparkContext.defaultParallelism)
    table = spark.createDataFrame([(p,) for p in chosen], "p long").repartition(tasks, "p")
    found = {r["p"]: r["c"] for r in table.mapInPandas(residues, "p long, c array<long>").collect()}
    used, spare = chosen[:-1], chosen[-1]
    whole = math.prod(used)
    shares = [whole // p * pow(whole // p, -1, p) for p in used]
    values = [sum(found[p][k] * share for p, share in zip(used, shares)) % whole for k in range(d + 1)]
    values = [v - whole if 2 * v > whole else v for v in values]
    if [v % spare for v in values] != list(found[spare]):
        raise ArithmeticError("the residues of the characteristic polynomial do not agree")
    return values


# -- roots ----------------------------------------------------------------------------------------

def above(poly: list[int], a: int, scale: int) -> int:
    """How many roots are greater than ``a / 2**scale``, multiplicities counted.

    All roots are real, so Descartes' count of sign changes of the shifted polynomial is exact.
    """
    d = len(poly) - 1
    c = [v << scale * (d - k) for k, v in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(s != t for s, t in zip(signs, signs[1:]))


def sign(poly: list[int], a: int, scale: int) -> int:
    """The sign of the polynomial at ``a / 2**scale``."""
    value, d = 0, len(poly) - 1
    for k in range(d, -1, -1):
        value = value * a + (poly[k] << scale * (d - k))
    return (value > 0) - (value < 0)


def root(poly: list[int], rank: int, top: int) -> tuple[int, int]:
    """The ``rank``-th greatest root as ``a / 2**scale`` from above, from an interval of ``ROOT_BITS`` bits.

    The interval is halved by exact counts of the roots above its middle, and by signs once it holds one root.
    """
    low, high, scale = 0, 1 << top.bit_length(), 0
    over_low, over_high = above(poly, 0, 0), 0
    end = sign(poly, high, 0)
    while (high - low).bit_length() + ROOT_BITS > low.bit_length():
        low, high, scale = 2 * low, 2 * high, scale + 1
        middle = (low + high) // 2
        if over_low - over_high == 1 and end:
            side = sign(poly, middle, scale)
            if side == 0:
                return middle, scale
            low, high = (low, middle) if side == end else (middle, high)
            continue
        over = above(poly, middle, scale)
        if over >= rank:
            low, over_low = middle, over
        else:
            high, over_high, end = middle, over, sign(poly, middle, scale)
    return high, scale


def null_space(matrix: list[list[int]], value: Fraction, size: int) -> list[list[float]]:
    """``size`` orthonormal vectors that the matrix multiplies by ``value``, by inverse iteration."""
    d = len(matrix)
    random = np.random.default_rng(11)
    with localcontext() as context:
        context.prec = DIGITS
        shift = Decimal(value.numerator) / Decimal(value.denominator)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        a[np.diag_indices(d)] -= shift
        tiny = Decimal(10) ** (10 - DIGITS) * max(Decimal(1), *(abs(v) for v in a.ravel()))
        order = np.arange(d)
        for k in range(d):
            pivot = k + int(np.argmax([abs(v) for v in a[k:, k]]))
            if pivot != k:
                a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1:, k] /= a[k, k]
            a[k + 1:, k + 1:] -= np.multiply.outer(a[k + 1:, k], a[k, k + 1:])
        basis = [np.array([Decimal(int(v)) for v in random.integers(-999, 1000, d)], object) for _ in range(size)]
        for _ in range(3):
            out: list[np.ndarray] = []
            for b in basis:
                z = b[order]
                for k in range(d):
                    z[k + 1:] -= a[k + 1:, k] * z[k]
                for k in range(d - 1, -1, -1):
                    z[k] = z[k] / a[k, k]
                    z[:k] -= a[:k, k] * z[k]
                z = z / max(abs(v) for v in z)
                for _ in range(2):
                    for other in out:
                        z = z - other * (other * z).sum()
                    z = z / (z * z).sum().sqrt()
                out.append(z)
            basis = out
        return [[float(v) for v in b] for b in basis]


# -- the operator ---------------------------------------------------------------------------------

@dataclass
class Whitening:
    """What the fit list says: its size and sums, and the components by falling variance."""

    dim: int
    n: int
    sums: list[int]
    variances: list[float]
    explained: list[float]
    axes: list[list[float]]  # one unit vector per component

    def projector(self):
        """A function from integer vectors to exact deviations and whitened values, for tasks."""
        n = self.n
        shift = np.array([s // n for s in self.sums], np.int64)
        left = [s - n * int(c) for s, c in zip(self.sums, shift)]  # of the sums of x - shift
        centre = np.array([float(Fraction(v, n)) for v in left])
        axes = np.array(self.axes).reshape(len(self.axes), self.dim).T / np.sqrt(self.variances)

        def of(x: np.ndarray) -> tuple[list[int], np.ndarray]:
            y = x - shift
            most = (int(np.abs(y).max(initial=0)) + 1) * n
            z = y * n - np.array(left, np.int64) if most ** 2 * self.dim < 1 << 62 else y.astype(object) * n - np.array(left, object)
            # Added in a fixed order, so that equal vectors have equal values in every batch.
            return (z * z).sum(axis=1).tolist(), np.einsum("nd,dk->nk", y - centre, axes, optimize=False)

        return of


def integers(vectors: DataFrame, key: str, vector: str, dim: int | None = None) -> tuple[DataFrame, int]:
    """``key`` and ``x`` of the rows that take part, and their number of components."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = vectors.filter(F.col(vector).isNotNull() & fine)
    if dim is None:
        sizes = usable.groupBy(F.size(vector).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
        dim = sizes["dim"] if sizes else 0

    def whole(c: Column) -> Column:
        times = c.cast("double") * F.lit(float(SCALE))
        return F.floor(F.greatest(F.least(times, F.lit(LARGEST)), F.lit(-LARGEST))) + F.lit(OFFSET)

    rows = usable.filter(F.size(vector) == dim).select(F.col(key).alias("key"), F.transform(vector, whole).alias("x"))
    return rows, dim


def sums_of(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """The number of vectors and their exact sums per dimension."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total = 0, [0] * dim
        for batch in batches:
            x = stacked(batch["x"], dim)
            wide = x if int(np.abs(x).max(initial=0)) * len(x) < 1 << 62 else x.astype(object)
            count, total = count + len(x), [a + int(b) for a, b in zip(total, wide.sum(axis=0))]
        if count:
            yield pd.DataFrame([[i, *limbs(v)] for i, v in enumerate([*total, count])], columns=["i", *(f"l{i}" for i in range(LIMBS))])

    found = added(fit.mapInPandas(partial, f"i int, {_SUM}"), "i")
    return found.get((dim,), 0), [found.get((i,), 0) for i in range(dim)]


def scatter(fit: DataFrame, dim: int, n: int, sums: list[int]) -> list[list[int]]:
    """``n * n`` times the covariance, exact: vectors are centred on whole numbers before they are multiplied."""
    shift = [s // n for s in sums]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            part = product(stacked(batch["x"], dim) - np.array(shift, np.int64))
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame([[i, j, *limbs(int(total[i, j]))] for i in range(dim) for j in range(i, dim)],
                               columns=["i", "j", *(f"l{i}" for i in range(LIMBS))])

    found = added(fit.mapInPandas(partial, f"i int, j int, {_SUM}"), "i", "j")
    left = [s - n * c for s, c in zip(sums, shift)]
    return [[n * found[min(i, j), max(i, j)] - left[i] * left[j] for j in range(dim)] for i in range(dim)]


def components(spark: SparkSession, matrix: list[list[int]], count: int) -> list[tuple[Fraction, list[float]]]:
    """Up to ``count`` eigenvalues above zero, greatest first, with unit eigenvectors; tasks take one each."""
    poly = polynomial(spark, matrix)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    count = min(count, above(poly, 0, 0))

    def tasks(rows: list[tuple], schema: str) -> DataFrame:
        return spark.createDataFrame(rows, schema).repartition(max(1, len(rows)), "k")

    def roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [root(poly, k, trace) for k in batch["k"].tolist()]
            yield pd.DataFrame({"k": batch["k"], "a": [str(a) for a, _ in found], "scale": [s for _, s in found]})

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, a, scale, size in zip(*(batch[c].tolist() for c in ("k", "a", "scale", "size"))):
                found = null_space(matrix, Fraction(int(a), 1 << scale), size)
                yield pd.DataFrame({"k": [k + i for i in range(size)], "axis": found})

    rows = sorted(tasks([(k,) for k in range(1, count + 1)], "k int").mapInPandas(roots, "k int, a string, scale int").collect())
    values = [Fraction(int(r["a"]), 1 << r["scale"]) for r in rows]
    groups: list[list] = []
    for r, value in zip(rows, values):
        if groups and (values[groups[-1][0] - 1] - value) * (1 << SAME_BITS) <= value:
            groups[-1][3] += 1
        else:
            groups.append([r["k"], r["a"], r["scale"], 1])
    axes = sorted(tasks([tuple(g) for g in groups], "k int, a string, scale int, size int")
                  .mapInPandas(vectors, "k int, axis array<double>").collect())
    return [(value, list(r["axis"])) for value, r in zip(values, axes)]


def fit(listed: DataFrame, dim: int, count: int = 16) -> Whitening:
    """The whitening of the vectors ``x`` of a fit list that is read several times.

    Only sums of the size of the matrix leave the tasks: its entries, the residues of its polynomial and its
    components. Their size depends on the dimension and never on the rows.
    """
    spark = listed.sparkSession
    n, sums = sums_of(listed, dim)
    found: list[tuple[Fraction, list[float]]] = []
    trace, divisor = 0, 0
    if n:
        matrix = scatter(listed, dim, n, sums)
        divisor = math.gcd(*(v for row in matrix for v in row))
        if divisor:
            matrix = [[v // divisor for v in row] for row in matrix]
            trace = sum(matrix[i][i] for i in range(dim))
            found = components(spark, matrix, count)
    return Whitening(dim, n, sums, [float(value * divisor / n ** 2) for value, _ in found],
                     [float(value / trace) for value, _ in found], [axis for _, axis in found])


def identity_error(listed: DataFrame, model: Whitening) -> float:
    """The largest entry, of either sign, of the whitened fit list's covariance less the identity."""
    size, dim = len(model.axes), model.dim

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        project, total = model.projector(), np.zeros((size, size + 1))
        for batch in batches:
            w = project(stacked(batch["x"], dim))[1]
            total += np.c_[w.T @ w, w.sum(axis=0)]
        yield pd.DataFrame([[i, j, total[i, j]] for i in range(size) for j in range(size + 1)], columns=["i", "j", "s"])

    if not size:
        return 0.0
    sums = {(r["i"], r["j"]): r["s"] for r in listed.mapInPandas(partial, "i int, j int, s double")
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    mean = [sums[i, size] / model.n for i in range(size)]
    return max(abs(sums[i, j] / model.n - mean[i] * mean[j] - (i == j)) for i in range(size) for j in range(size))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = 16, dim: int | None = None) -> DataFrame:
    """``key``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``: a row per row and component.

    Entries become whole numbers ``floor(64 * c) + 1000000``; the fit list holds every different vector of them
    once. Components are numbered by falling variance; those without variance are left out, so equal vectors
    alone give no rows. Where variances agree to 80 bits, any orthonormal basis of their space serves.

    Rows whose vector is null or holds a null or a non-finite entry take no part, and neither do those of
    another number of components than ``dim`` (by default the most frequent one, the greater of equals). Zero vectors and rows without a key
    do, and repeated rows come back as often as they went in. An entry beyond 2**53 / 64 counts as that. ``deviation``
    is a decimal of 38 digits, null where it has more. Other columns are ignored; an empty table gives no rows.
    """
    rows, dim = integers(vectors, key, vector, dim)
    listed = saved(rows.select("x").distinct(), "fit-list")
    model = fit(listed, dim, count)
    error = identity_error(listed, model)

    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = model.projector()
        for batch in batches:
            deviation, whitened = of(stacked(batch, dim))
            yield pd.DataFrame({"deviation": [Decimal(v) if v < 10 ** 38 else None for v in deviation],
                                "whitened": whitened.tolist()})

    projected = F.pandas_udf(project, "deviation decimal(38,0), whitened array<double>")
    if model.axes:
        found = rows.select("key", projected("x").alias("p")).select("key", "p.*")
    else:
        found = rows.limit(0).selectExpr("key", "cast(null AS decimal(38,0)) AS deviation", "cast(array() AS array<double>) AS whitened")
    explained = F.array(*map(F.lit, model.explained)).cast("array<double>")
    return (found.select("key", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select(F.col("key").alias(key), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
