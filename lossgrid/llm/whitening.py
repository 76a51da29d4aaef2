"""Whitening of embeddings by exact integer algebra.

Entries become integers, so the scatter matrix M = n * sum(x x') - (sum x)(sum x)' is exact: tasks sum their rows in
integers, Spark adds the sums of the tasks. Its eigenvalues are n * n times those of the covariance. From there on
the work depends on the number of dimensions only, not on the rows:

1. The characteristic polynomial of M, exactly: for each of many 31-bit primes, M is brought to Hessenberg form and
   its polynomial read off modulo the prime (tasks share out the primes), then the Chinese remainder theorem joins
   the residues. As no eigenvalue is negative, the coefficients are elementary symmetric sums, bounded by the trace.
2. The largest roots by isolation: all roots are real, so the sign changes of the coefficients shifted by a count the
   roots above a exactly, multiple ones included. Isolated roots are narrowed by the sign of the polynomial alone.
3. Each component is a null vector of M - root * I, by inverse iteration in decimals of many digits; vectors of a
   multiple root are made orthogonal to each other.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.llm.arrow import schema_with
from lossgrid.session import materialise

ROWS = 4096
#: Primes worked on at once, as one numpy array.
PRIMES = 8
#: Bits of a root behind its leading one.
ROOT_BITS = 192
LIMB = 40


# --- exact sums ---------------------------------------------------------------------------------------------


def integers(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, floor(scale * entry) as int64) of the vectors of ``dims`` finite entries that fit a long."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # NULL entries become NaN
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    rows = np.flatnonzero(lengths == dims)
    if not len(rows):
        return rows, np.empty((0, dims), np.int64)
    with np.errstate(all="ignore"):
        entries = np.floor(flat[starts[rows][:, None] + np.arange(dims)] * scale)
        fits = (np.abs(entries) < 2.0**62).all(axis=1)
    return rows[fits], entries[fits].astype(np.int64)


def gram(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers; floats, machine words or big integers multiply, as the size of the sums allows."""
    top = int(max(abs(int(y.min())), abs(int(y.max())))) if y.size else 0
    if top * top * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if top * top * len(y) < 1 << 63:
        return (y.T @ y).astype(object)
    big = y.astype(object)
    return big.T.dot(big)


def exact_sums(vectors: DataFrame, dims: int, scale: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, sums, sums of products) of all vectors, as Python integers; a task gives one row per entry."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
        for part in batches:
            _, y = integers(part.column(0), dims, scale)
            for low in range(0, len(y), ROWS):
                block = y[low : low + ROWS]
                n += len(block)
                total += block.astype(object).sum(axis=0)
                products += gram(block)
        found = [(-1, -1, n)] + [(-1, j, int(t)) for j, t in enumerate(total)]
        found += [(i, j, int(products[i, j])) for i in range(dims) for j in range(i, dims)]
        i, j, value = zip(*found, strict=True)
        mask = (1 << LIMB) - 1
        limbs = [[(v >> (k * LIMB)) & mask for v in value] for k in range(3)] + [[v >> (3 * LIMB) for v in value]]
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), **{f"l{k}": pa.array(x, pa.int64()) for k, x in enumerate(limbs)}})

    parts = vectors.mapInArrow(sums, "i int, j int, l0 bigint, l1 bigint, l2 bigint, l3 bigint")
    rows = parts.groupBy("i", "j").agg(*[F.sum(F.col(f"l{k}").cast("decimal(38,0)")).alias(f"l{k}") for k in range(4)]).collect()
    n, total, products = 0, np.zeros(dims, object), np.zeros((dims, dims), object)
    for row in rows:  # one per pair of dimensions
        value = sum(int(row[f"l{k}"]) << (k * LIMB) for k in range(4))
        if row.j < 0:
            n = value
        elif row.i < 0:
            total[row.j] = value
        else:
            products[row.i, row.j] = products[row.j, row.i] = value
    return n, total, products


# --- characteristic polynomial --------------------------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Deterministic for n below 2 ** 32 (bases 2, 7 and 61)."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if base % n and x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes below 2 ** 31, the largest first, whose product exceeds ``bound``."""
    found, product, n = [], 1, (1 << 31) + 1
    while product <= bound:
        n -= 2
        if is_prime(n):
            found.append(n)
            product *= n
    return found


def polynomials_mod(matrix: np.ndarray, primes: Sequence[int]) -> np.ndarray:
    """Coefficients of det(x I - matrix) modulo each prime, lowest power first, by Hessenberg reduction."""
    d, k = len(matrix), len(primes)
    each = np.arange(k)
    a = np.array([[[int(v) % p for v in row] for row in matrix] for p in primes], np.int64).reshape(k, d, d)
    p = np.array(primes, np.int64)
    p1, p2 = p[:, None], p[:, None, None]
    for j in range(d - 2):
        pivot = j + 1 + np.argmax(a[:, j + 1 :, j] != 0, axis=1)  # where all are 0 there is nothing to clear
        a[each, j + 1], a[each, pivot] = a[each, pivot], a[each, j + 1]
        a[each, :, j + 1], a[each, :, pivot] = a[each, :, pivot], a[each, :, j + 1]
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(a[:, j + 1, j], p, strict=True)], np.int64)
        factor = a[:, j + 2 :, j] * inverse[:, None] % p1
        a[:, j + 2 :, :] = (a[:, j + 2 :, :] - factor[:, :, None] * a[:, j + 1, None, :] % p2) % p2
        a[:, :, j + 1] = (a[:, :, j + 1] + (a[:, :, j + 2 :] * factor[:, None, :] % p2).sum(axis=2)) % p1
    leading = np.zeros((k, d + 1, d + 1), np.int64)  # polynomials of the leading blocks
    leading[:, 0, 0] = 1
    for m in range(1, d + 1):
        weights = np.empty((k, m), np.int64)
        below = np.ones(k, np.int64)
        for i in range(m - 1, -1, -1):
            weights[:, i] = a[:, i, m - 1] * below % p
            below = below * (a[:, i, i - 1] if i else 0) % p
        leading[:, m, 1:] = leading[:, m - 1, :-1]
        leading[:, m] = (leading[:, m] - (weights[:, :, None] * leading[:, :m] % p2).sum(axis=1)) % p1
    return leading[:, d]


def symmetric_sums(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """e_0 .. e_d of the eigenvalues of a positive semidefinite integer matrix, exactly."""
    d = len(matrix)
    trace = int(sum(matrix[i, i] for i in range(d)))
    bound = max(math.comb(d, k) * trace**k // d**k for k in range(d + 1)) + 1
    primes = primes_for(bound)
    table = [[int(v) for v in row] for row in matrix]

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first in frame["id"]:
                some = primes[first * PRIMES : (first + 1) * PRIMES]
                rows = polynomials_mod(np.array(table, object), some)
                yield pd.DataFrame({"prime": some, "coefficients": list(rows)})

    blocks = -(-len(primes) // PRIMES)
    tasks = min(blocks, spark.sparkContext.defaultParallelism)
    found = spark.range(0, blocks, 1, tasks).mapInPandas(residues, "prime bigint, coefficients array<bigint>").collect()
    product = math.prod(primes)
    sums = [0] * (d + 1)
    for prime, coefficients in found:
        rest = product // prime
        unit = rest * pow(rest, -1, prime)
        for power, c in enumerate(coefficients):
            sums[d - power] += (-c if (d - power) % 2 else c) % prime * unit
    return [s % product for s in sums]


# --- roots ----------------------------------------------------------------------------------------------------


def roots_above(sums: Sequence[int], numerator: int, bits: int) -> int:
    """How many roots of sum (-1)^k e_k x^(d-k) exceed numerator / 2 ** bits; all its roots are real."""
    while bits and numerator % 2 == 0:
        numerator, bits = numerator // 2, bits - 1
    c = [(-e if k % 2 else e) << (bits * k) for k, e in enumerate(sums)]
    d = len(c) - 1
    for end in range(d, 0, -1):
        for i in range(1, end + 1):
            c[i] += numerator * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs[1:], signs[:-1], strict=True))


def _sign_at(sums: Sequence[int], numerator: int, bits: int) -> int:
    value = 0
    for k, e in enumerate(sums):
        value = value * numerator + ((-e if k % 2 else e) << (bits * k))
    return (value > 0) - (value < 0)


def largest_roots(sums: Sequence[int], wanted: int) -> tuple[list[tuple[int, int]], int]:
    """The largest positive roots, repeated as often as they are multiple: ([(numerator, number of the distinct root)], bits).

    A root is numerator / 2 ** bits, less than one unit too large.
    """
    rank = max((k for k, e in enumerate(sums) if e), default=0)
    wanted = min(wanted, rank)
    if not wanted:
        return [], 0
    sums = sums[: rank + 1]  # roots of 0 divided out
    top = sums[1].bit_length()  # the sum of the roots is below 2 ** top
    # No wanted root is below the rank's share of the product of all.
    bits = max(0, ROOT_BITS + top * (rank - 1) - sums[rank].bit_length() + 1 - top) if rank > 1 else ROOT_BITS
    bits = min(bits, ROOT_BITS + top)
    found: list[tuple[int, int]] = []
    above: dict[int, int] = {}

    def count(x: int) -> int:
        if x not in above:
            above[x] = roots_above(sums, x, bits)
        return above[x]

    above[0], above[1 << (top + bits)] = rank, 0
    distinct = 0
    while len(found) < wanted:
        place = len(found)  # roots found so far lie above
        low = max(x for x, n in above.items() if n > place)
        high = min(x for x, n in above.items() if n <= place)
        while high - low > 1 and count(low) - count(high) > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if count(middle) > place else (low, middle)
        if count(low) - count(high) == 1:
            right = _sign_at(sums, high, bits)
            while high - low > 1:
                middle = (low + high) // 2
                sign = _sign_at(sums, middle, bits)
                if sign == 0:  # the root itself
                    low, high = middle - 1, middle
                    break
                low, high = (low, middle) if sign == right else (middle, high)
        many = count(low) - place
        found += [(high, distinct)] * many
        distinct += 1
    return found[:wanted], bits


# --- null vectors ---------------------------------------------------------------------------------------------


def null_vectors(matrix: np.ndarray, roots: Sequence[tuple[int, int]], bits: int) -> list[list[Decimal]]:
    """A unit vector for each root by inverse iteration; those of one root are orthogonal."""
    d = len(matrix)
    digits = int((ROOT_BITS + 2 * max(1, int(sum(abs(matrix[i, i]) for i in range(d))).bit_length())) * 0.302) + 40
    vectors: list[list[Decimal]] = []
    with decimal.localcontext(decimal.Context(prec=digits, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        base = [[Decimal(int(v)) for v in row] for row in matrix]
        lu = order = None
        for number, (numerator, which) in enumerate(roots):
            if lu is None or which != roots[number - 1][1]:
                root = Decimal(numerator) / Decimal(1 << bits)
                lu, order = _factor([[v - root if i == j else v for j, v in enumerate(row)] for i, row in enumerate(base)], root)
            same = [v for v, (_, w) in zip(vectors, roots, strict=False) if w == which]
            x = [Decimal(1 + (7919 * (i + 1) * (number + 3)) % 1009) for i in range(d)]
            for _ in range(3):
                x = _solve(lu, order, _unit(_without(x, same)))
                x = _unit(_without(x, same))
            largest = max(range(d), key=lambda i: (abs(x[i]), -i))
            vectors.append([-v for v in x] if x[largest] < 0 else x)
    return vectors


def _unit(x: list[Decimal]) -> list[Decimal]:
    largest = max(map(abs, x))
    x = [v / largest for v in x]
    norm = sum(v * v for v in x).sqrt()
    return [v / norm for v in x]


def _without(x: list[Decimal], others: Sequence[list[Decimal]]) -> list[Decimal]:
    for v in others:
        along = sum(a * b for a, b in zip(x, v, strict=True))
        x = [a - along * b for a, b in zip(x, v, strict=True)]
    return x


def _factor(a: list[list[Decimal]], scale: Decimal) -> tuple[list[list[Decimal]], list[int]]:
    """LU factors in place with row exchanges; a pivot of 0 becomes a speck, as the matrix is singular but for rounding."""
    d = len(a)
    speck = abs(scale) * Decimal(10) ** (8 - decimal.getcontext().prec)
    order = list(range(d))
    for j in range(d):
        best = max(range(j, d), key=lambda i: abs(a[i][j]))
        a[j], a[best] = a[best], a[j]
        order[j], order[best] = order[best], order[j]
        if abs(a[j][j]) < speck:
            a[j][j] = speck
        head = a[j]
        for i in range(j + 1, d):
            row = a[i]
            if row[j]:
                f = row[j] / head[j]
                row[j] = f
                row[j + 1 :] = [v - f * h for v, h in zip(row[j + 1 :], head[j + 1 :], strict=True)]
    return a, order


def _solve(lu: list[list[Decimal]], order: list[int], b: list[Decimal]) -> list[Decimal]:
    d = len(lu)
    y = [b[i] for i in order]
    for i in range(d):
        y[i] -= sum(f * v for f, v in zip(lu[i][:i], y[:i], strict=True))
    for i in range(d - 1, -1, -1):
        y[i] = (y[i] - sum(f * v for f, v in zip(lu[i][i + 1 :], y[i + 1 :], strict=True))) / lu[i][i]
    return y


# --- operator -------------------------------------------------------------------------------------------------


@dataclass
class Whitening:
    """What a fit keeps: the number of vectors, their sums, and per component its vector, variance and share."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: list[float]
    explained: list[float]


def _valid(vector: Column) -> Column:
    return F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def fit(vectors: DataFrame, *, vector_col: str = "embedding", components: int = 8, scale: int = 1024) -> Whitening | None:
    """The principal components of floor(scale * entry) over all whole vectors, None where there are none.

    Vectors that are NULL or empty, or hold a NULL, non-finite or unrepresentable entry (2 ** 62 or more after scaling)
    do not count, nor do those that are not as long as most (of equally frequent lengths the largest). Dimensions without
    variance give no component: there are as many as the rank of the covariance, at most ``components``. The scatter
    matrix, dimensions squared, comes to the driver; vectors do not.
    """
    column = vectors.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    length = column.filter(_valid(F.col("v")) & (F.size("v") > 0)).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return None
    n, total, products = exact_sums(column, length.d, scale)
    if not n:
        return None
    matrix = n * products - np.outer(total, total)
    divisor = math.gcd(*[int(v) for v in matrix.reshape(-1)]) or 1
    reduced = matrix // divisor
    sums = symmetric_sums(vectors.sparkSession, reduced)
    roots, bits = largest_roots(sums, components)
    found = null_vectors(reduced, roots, bits)
    trace = int(sum(reduced[i, i] for i in range(len(reduced))))
    values = [decimal.Context(prec=60).divide(Decimal(r), Decimal(1 << bits)) for r, _ in roots]
    return Whitening(
        n=n,
        sums=[int(t) for t in total],
        vectors=np.array([[float(v) for v in x] for x in found], np.float64).reshape(len(found), len(reduced)),
        variances=[float(v * divisor / n / n) for v in values],
        explained=[float(v / trace) for v in values],
    )


def project(vectors: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """One row per whole vector: id, ``deviation`` (sum over dimensions of (n x - S)^2, exact, NULL beyond 38 digits),
    ``whitened`` (array, one value per component)."""
    dims, n = len(model.sums), model.n
    sums = np.array(model.sums, object)
    axes = (model.vectors / (n * np.sqrt(np.array(model.variances)))[:, None]).T
    small = max(map(abs, model.sums))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for low in range(0, part.num_rows, ROWS):
                block = part.slice(low, ROWS)
                at, y = integers(block.column(1), dims, scale)
                if not len(at):
                    continue
                top = n * int(np.abs(y).max()) + small
                z = n * y - sums.astype(np.int64) if top < 1 << 62 else n * y.astype(object) - sums
                if dims * top * top < 1 << 63:
                    deviation = pa.array((z * z).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    exact = (z.astype(object) ** 2).sum(axis=1)
                    deviation = pa.array([Decimal(int(v)) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
                white = np.ascontiguousarray(z.astype(np.float64) @ axes)
                offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * white.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [block.column(0).take(pa.array(at)), deviation, pa.ListArray.from_arrays(offsets, pa.array(white.reshape(-1)))],
                    names=["vec_id", "deviation", "whitened"],
                )

    base = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return base.mapInArrow(rows, schema_with(base, ["vec_id"], "deviation decimal(38,0), whitened array<double>"))


OUTPUT = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8, scale: int = 1024
) -> DataFrame:
    """One row per whole vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    ``identity_error`` is one value, taken from the whitened rows: the largest absolute entry of their covariance less
    the identity. Which vectors count says ``fit``; repeated rows and ids count each, a NULL id is kept. A table without
    such vectors, with a single one or with equal ones only has no component and gives no rows.
    """
    spark = vectors.sparkSession
    model = fit(vectors, vector_col=vector_col, components=components, scale=scale)
    ids = vectors.select(F.col(f"`{id_col}`").alias("vec_id"))
    if model is None or not model.variances:
        return spark.createDataFrame([], schema_with(ids, ["vec_id"], OUTPUT))
    wide = materialise(project(vectors, model, id_col=id_col, vector_col=vector_col, scale=scale), "whitened")
    count = len(model.variances)
    value = [F.col("whitened")[i] for i in range(count)]
    entries = [F.abs(F.covar_pop(value[i], value[j]) - float(i == j)).alias("e") for i in range(count) for j in range(i, count)]
    error = max(wide.agg(*[e.alias(f"e{k}") for k, e in enumerate(entries)]).first())
    share = F.array(*[F.lit(x) for x in model.explained])
    return wide.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        share[F.col("at")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
