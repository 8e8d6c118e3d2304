"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

Spark sums the integer scatter matrix over the distinct vectors, in limbs that never round. Its characteristic polynomial
is computed modulo many primes, one Hessenberg reduction a prime, by Spark tasks, and joined by Chinese remaindering. All
roots are real, so that the sign changes of a shifted polynomial count the roots beyond a point exactly: bisection isolates
the largest ones to any precision. Inverse iteration with exact residuals gives the null vector of each shifted matrix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm.common import saved

#: Entries become floor(SCALE * c) + OFFSET. The offset moves no covariance, so the sums are kept without it.
SCALE, OFFSET = 64, 1000000
#: Bits of a limb in products (two limbs and 4096 rows stay exact in a double) and in sums over tasks.
LIMB, SUM_LIMB, ROWS = 20, 40, 4096
#: Relative precision of roots, bits of vectors in inverse iteration.
ROOT_BITS, VECTOR_BITS = 90, 96
#: Roots closer than this share of the trace share a null space.
SAME = 1e-13


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite entries, and without entries whose integer exceeds a long."""
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < 2.0 ** 56))
    return F.coalesce(fits, F.lit(False))


def scatter_of(rows: np.ndarray) -> list[list[int]]:
    """Exact sum of products of each two columns (Python integers)."""
    size = rows.shape[1]
    total = np.zeros((size, size), dtype=object)
    for start in range(0, len(rows), ROWS):
        rest, limbs = rows[start:start + ROWS], []
        while len(rest) and np.abs(rest).max() >= 1 << LIMB:
            limbs.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
            rest = rest >> LIMB
        limbs.append(rest.astype(np.float64))
        for a, one in enumerate(limbs):
            for b, two in enumerate(limbs):
                total += (one.T @ two).astype(np.int64).astype(object) << (LIMB * (a + b))
    return total.tolist()


def scatter(fit: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """(rows, sums, sums of products) of the integer vectors `y`, exact."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size + 1, size + 1), dtype=object)
        for batch in batches:
            if len(batch):
                y = np.stack(batch["y"].to_list()).astype(np.int64)
                total += np.array(scatter_of(np.column_stack([np.ones(len(y), dtype=np.int64), y])), dtype=object)
        out = []
        for i in range(size + 1):
            for j in range(i, size + 1):
                value, limb = int(total[i, j]), 0
                while not -(1 << SUM_LIMB) <= value < 1 << SUM_LIMB:
                    value, low = divmod(value, 1 << SUM_LIMB)
                    out.append((i, j, limb, low))
                    limb += 1
                out.append((i, j, limb, value))
        yield pd.DataFrame(out, columns=["i", "j", "limb", "value"])

    sums = fit.mapInPandas(partial, "i int, j int, limb int, value long").groupBy("i", "j", "limb").agg(F.sum("value").alias("value"))
    whole = [[0] * (size + 1) for _ in range(size + 1)]
    for r in sums.collect():  # a few limbs for each two dimensions
        whole[r["i"]][r["j"]] += r["value"] << (SUM_LIMB * r["limb"])
    for i in range(size + 1):
        for j in range(i):
            whole[i][j] = whole[j][i]
    return whole[0][0], whole[0][1:], [row[1:] for row in whole[1:]]


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all 32-bit numbers."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1) or n == base:
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31, the largest first, whose product exceeds the bound."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo p, the constant one first: similarity to Hessenberg form, then its minors."""
    h, size = matrix.copy() % p, len(matrix)
    for k in range(size - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        m = h[k + 2:, k] * pow(int(h[k + 1, k]), p - 2, p) % p
        h[k + 2:] = (h[k + 2:] - m[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * m % p).sum(axis=1)) % p
    minors = np.zeros((size + 1, size + 1), dtype=np.int64)
    minors[0, 0] = 1
    for k in range(size):
        weights, path = np.zeros(k + 1, dtype=np.int64), 1
        for i in range(k, -1, -1):
            weights[i] = h[i, k] * path % p
            path = path * int(h[i, i - 1]) % p if i else 0
        minors[k + 1, 1:] = minors[k, :-1]
        minors[k + 1] = (minors[k + 1] - (weights[:, None] * minors[:k + 1] % p).sum(axis=0)) % p
    return minors[size].tolist()


def elementary_sums(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """e_0, e_1, ... of the roots of a positive semidefinite integer matrix: coefficients of its characteristic polynomial."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    # of numbers with this sum, e_k is largest when all are equal
    bound = max(math.comb(size, k) * trace ** k // size ** k + 1 for k in range(size + 1))
    primes = primes_beyond(bound)
    entries = np.array(matrix, dtype=object)

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [polynomial_mod((entries % p).astype(np.int64), p) for p in batch["p"].tolist()]
            yield pd.DataFrame({"p": batch["p"], "coefficients": found})

    tasks = max(1, min(len(primes), spark.sparkContext.defaultParallelism))
    residues = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks) \
        .mapInPandas(reduce, "p long, coefficients array<long>").collect()  # a bounded number of primes, whatever the rows
    product = math.prod(r["p"] for r in residues)
    sums = [0] * (size + 1)
    for r in residues:
        others = product // r["p"]
        unit = others * pow(others, -1, r["p"])
        for k in range(size + 1):
            sums[k] += unit * (r["coefficients"][size - k] if k % 2 == 0 else -r["coefficients"][size - k])
    return [s % product for s in sums]


class Roots:
    """Positive roots of sum (-1)^k e_k x^(n-k), which has no others but zero."""

    def __init__(self, sums: list[int]):
        while len(sums) > 1 and sums[-1] == 0:
            sums = sums[:-1]  # zero is a root once more
        self.degree = len(sums) - 1
        self.coefficients = [(-1) ** k * e for k, e in enumerate(sums)]  # highest power first
        self.counted: dict[tuple[int, int], int] = {}

    def scaled(self, scale: int) -> list[int]:
        """Coefficients for roots times 2**scale."""
        return [c << (scale * k) for k, c in enumerate(self.coefficients)]

    def beyond(self, point: int, scale: int) -> int:
        """Number of roots over point / 2**scale, with multiplicity: sign changes of the polynomial shifted there."""
        if (point, scale) not in self.counted:
            shifted = self.scaled(scale)
            for end in range(self.degree, 0, -1):
                for k in range(1, end + 1):
                    shifted[k] += point * shifted[k - 1]
            signs = [c > 0 for c in shifted if c]
            self.counted[point, scale] = sum(a != b for a, b in zip(signs, signs[1:]))
        return self.counted[point, scale]

    def sign(self, point: int, scale: int) -> int:
        value = 0
        for c in self.scaled(scale):
            value = value * point + c
        return (value > 0) - (value < 0)

    def largest(self, rank: int) -> tuple[int, int]:
        """(a, scale): the root of that rank, from 1 by falling size, lies in (a, a + 1] / 2**scale; a has ROOT_BITS bits."""
        low, high, scale = 0, self.coefficients[0] and -self.coefficients[1] + 1, 0
        while low >> ROOT_BITS == 0 or high - low > 1:
            if high - low == 1:
                low, high, scale = low << 16, high << 16, scale + 16
            if self.beyond(low, scale) == rank and self.beyond(high, scale) == rank - 1:
                return self._alone(low, high, scale)
            middle = (low + high) // 2
            if self.beyond(middle, scale) >= rank:
                low = middle
            else:
                high = middle
        return low, scale

    def _alone(self, low: int, high: int, scale: int) -> tuple[int, int]:
        """The same for a root alone in (low, high]: only the polynomial's sign is needed."""
        at_high = self.sign(high, scale)
        while low >> ROOT_BITS == 0 or high - low > 1:
            if high - low == 1:
                low, high, scale = low << 16, high << 16, scale + 16
            middle = (low + high) // 2
            found = self.sign(middle, scale)
            # the root itself counts as not beyond: it is the upper end
            if found == 0 or found == at_high or (at_high == 0 and self.beyond(middle, scale) < self.beyond(low, scale)):
                high, at_high = middle, found
            else:
                low = middle
        return low, scale


def null_vectors(matrix: list[list[int]], roots: list[tuple[int, int]], steps: int = 4) -> np.ndarray:
    """Unit eigenvectors, one row for each root: inverse iteration, then corrections from residuals in exact integers."""
    size = len(matrix)
    trace = sum(matrix[i][i] for i in range(size))
    unit = np.array([[m / trace for m in row] for row in matrix])
    values = [a / (trace << scale) for a, scale in roots]
    exact = np.array(matrix, dtype=object)
    rng, found, start = np.random.default_rng(1), [], 0
    while start < len(roots):
        end = start + 1
        while end < len(roots) and values[end - 1] - values[end] < SAME:
            end += 1
        (a, scale), value = roots[start], values[start]
        shifted = unit - np.eye(size) * value
        some = np.linalg.qr(rng.standard_normal((size, end - start)))[0]
        for _ in range(steps):
            some = np.linalg.qr(np.linalg.solve(shifted + np.eye(size) * 1e-17 + np.eye(size) * np.spacing(value), some))[0]
        bordered = np.block([[shifted, some], [some.T, np.zeros((end - start, end - start))]])
        held = np.array([[int(math.ldexp(x, VECTOR_BITS)) for x in row] for row in some.T], dtype=object)
        for _ in range(steps):
            left = held.dot(exact * (1 << scale)) - held * a
            residual = np.array([[x / (trace << (scale + VECTOR_BITS)) for x in row] for row in left])
            change = np.linalg.solve(bordered, np.vstack([-residual.T, np.zeros((end - start, end - start))]))[:size].T
            held = held + np.array([[int(math.ldexp(x, VECTOR_BITS)) for x in row] for row in change], dtype=object)
        rows = np.array([[x / math.isqrt(sum(y * y for y in row)) for x in row] for row in held])
        if end - start > 1:
            rows = np.linalg.qr(rows.T)[0].T
        found += [row if row[np.abs(row).argmax()] > 0 else -row for row in rows]
        start = end
    return np.array(found).reshape(len(roots), size)


@dataclass
class Whitener:
    n: int
    sums: list[int]  # of the vectors without OFFSET, which is the same for all
    components: np.ndarray  # unit vectors, by falling eigenvalue
    eigenvalues: np.ndarray
    explained: np.ndarray

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([s % self.n for s in self.sums], dtype=np.int64)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        centred = (y - self.whole).astype(np.float64) - self.rest / self.n
        return centred @ self.components.T / np.sqrt(self.eigenvalues)

    def deviation(self, y: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - sums)^2; null where that exceeds a long."""
        near = y - self.whole
        if not len(y):
            return []
        if (self.n * (int(np.abs(near).max()) + 1)) ** 2 * y.shape[1] < 1 << 62:
            return ((self.n * near - self.rest) ** 2).sum(axis=1).tolist()
        found = ((self.n * near.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [d if d < 1 << 63 else None for d in found.tolist()]


def fit(vectors: DataFrame, size: int, most: int = 16) -> Whitener:
    """The `most` components with the largest eigenvalues (fewer where others are zero) of distinct integer vectors `y`."""
    n, sums, products = scatter(vectors, size)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]  # n^2 times the covariance
    trace = sum(matrix[i][i] for i in range(size))
    if not trace:
        return Whitener(n, sums, np.zeros((0, size)), np.zeros(0), np.zeros(0))
    roots = Roots(elementary_sums(vectors.sparkSession, matrix))
    found = [roots.largest(rank) for rank in range(1, min(most, roots.degree) + 1)]
    return Whitener(n, sums, null_vectors(matrix, found), np.array([a / (n * n << scale) for a, scale in found]),
                    np.array([a / (trace << scale) for a, scale in found]))


def identity_error(vectors: DataFrame, model: Whitener) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, summed over all distinct vectors."""
    size = len(model.components)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            if len(batch):
                w = model.whitened(np.stack(batch["y"].to_list()).astype(np.int64))
                w = np.column_stack([np.ones(len(w)), w])
                total += w.T @ w
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "value": total.ravel()})

    total = np.zeros((size + 1, size + 1))
    for r in vectors.mapInPandas(partial, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        total[r["i"], r["j"]] = r["value"]
    mean = total[0, 1:] / model.n
    return float(np.abs(total[1:, 1:] / model.n - np.outer(mean, mean) - np.eye(size)).max())


def whiten(vectors: DataFrame, most: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row for each usable row and component.

    Rows whose vector is null or holds null or non-finite entries, or entries of 2**56 and more, whose integer is no
    long, give nothing. Equal vectors are fitted once, and each of their rows is whitened. Vectors of different length are
    whitened apart. Components with eigenvalue zero cannot be scaled and give no rows, so one vector alone, or copies of
    it, give none. Work on the driver grows with the dimensions, not with the rows. Other columns are not read.
    """
    vector = F.col(vector_col)
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long"))
    rows = vectors.where(usable(vector)).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("y"))
    distinct = saved(rows.select("y").distinct(), "whitening-fit")
    sizes = [r["size"] for r in distinct.select(F.size("y").alias("size")).distinct().collect()]  # lengths, not vectors
    found = None
    for size in sorted(s for s in sizes if s):
        its = distinct.where(F.size("y") == size)
        model = fit(its, size, most)
        if not len(model.components):
            continue
        one = _whitened(rows.where(F.size("y") == size), model, identity_error(its, model))
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], WHITENED)
    return found


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whitened(rows: DataFrame, model: Whitener, error: float) -> DataFrame:
    kept = len(model.components)

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                part = batch.iloc[start:start + ROWS]
                y = np.stack(part["y"].to_list()).astype(np.int64)
                deviation = pd.array(model.deviation(y), dtype="Int64").repeat(kept)
                yield pd.DataFrame({"vec_id": part["vec_id"].astype("Int64").repeat(kept).array, "component": np.tile(np.arange(1, kept + 1, dtype=np.int32), len(y)),
                                    "n": model.n, "deviation": deviation, "whitened": model.whitened(y).ravel(),
                                    "explained": np.tile(model.explained, len(y)), "identity_error": error})

    return rows.mapInPandas(apply, WHITENED)
