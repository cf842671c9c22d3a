"""Embedding whitening through the exact characteristic polynomial.

Components become whole numbers x, so the scatter matrix of the fit list
(each distinct vector once, n of them with sums S), n * sum(x x') - S S', is
exact: it is n^2 times the covariance V, centred without rounding.

1. Scatter: tasks add up products of whole numbers (float64 products of
   20-bit limbs, exact in blocks of 4,096 rows); Spark adds their partials.
2. Polynomial: the scatter's characteristic polynomial modulo primes below
   2^31, each by Hessenberg reduction in a task of its own; the Chinese
   remainder theorem joins the residues. As the matrix is positive
   semidefinite, its coefficients are bounded by those of equal roots
   (Maclaurin), so enough primes make them exact.
3. Roots: all roots are real, so the sign changes of the polynomial shifted
   by t count the roots above t. Bisection isolates the largest ones and
   narrows them to ROOT_BITS bits; what stays together is one multiple root.
4. Components: inverse iteration on (scatter - root), in decimal arithmetic,
   one task a root; a multiple root gets an orthonormal basis.
5. Every row is projected in double precision; the covariance of the
   whitened fit list is measured against the identity.

The driver holds one dimension x dimension matrix and its polynomial, never
rows; matrix, roots and components are what is sent to the tasks.

Defined cases: rows whose vector is null or holds null or non-finite
entries, or one whose whole number is not a long, are dropped, and so are
rows whose length is not the most frequent one (of equally frequent lengths
the longest is taken); rows repeating an id or a vector are projected each,
null ids are kept; a component of zero variance cannot be scaled, so only
those of positive variance are returned (none for a single distinct vector
or empty vectors); a deviation beyond a long is null; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirp.llm.common import stored
from chirp.llm.topk_search import LONG, whole

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
LIMB = 20                  # bits of a limb; a limb product of 2^12 rows stays below 2^53
EXACT_ROWS = 4_096
ROOT_BITS = 200
DIGITS = 120               # decimal digits of the inverse iteration


def _matrix(column) -> np.ndarray:
    """A batch's vectors, all of one length, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


# --- 1. exact scatter ------------------------------------------------------

def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Parts p with y = sum(p[a] << LIMB * a), as float64; the last signed."""
    out = []
    while y.size and np.abs(y).max() >= 1 << LIMB:
        out.append((y & ((1 << LIMB) - 1)).astype(np.float64))
        y = y >> LIMB
    return out + [y.astype(np.float64)]


def products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers."""
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for s in range(0, len(y), EXACT_ROWS):
        parts = limbs(y[s:s + EXACT_ROWS])
        for a, p in enumerate(parts):
            for b, q in enumerate(parts):
                total += (p.T @ q).astype(np.int64).astype(object) << LIMB * (a + b)
    return total


def fit_sums(fit: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, sums of products) of the fit list's y = x - OFFSET, exact.
    Partial sums travel as two decimals, high and low part."""
    def partial(batches):
        n, sums, prods = 0, None, None
        for b in batches:
            if not b.num_rows:
                continue
            y = _matrix(b.column("x")) - OFFSET
            n += len(y)
            s, p = y.astype(object).sum(axis=0), products(y)
            sums, prods = (s, p) if sums is None else (sums + s, prods + p)
        if n:
            d = len(sums)
            cells = [(-1, -1, n)] + [(-1, i, int(sums[i])) for i in range(d)]
            cells += [(i, j, int(prods[i, j])) for i in range(d) for j in range(i + 1)]
            i, j, v = zip(*cells)
            whole_part = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(x >> 60) for x in v], whole_part),
                 pa.array([Decimal(x & ((1 << 60) - 1)) for x in v], whole_part)], ["i", "j", "hi", "lo"])

    rows = (fit.mapInArrow(partial, "i int, j int, hi decimal(38,0), lo decimal(38,0)")
            .groupBy("i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo")).collect())
    cells = {(r["i"], r["j"]): (int(r["hi"]) << 60) + int(r["lo"]) for r in rows}
    n = cells.get((-1, -1), 0)
    d = sum(1 for i, j in cells if i == -1 and j >= 0)
    return n, [cells[-1, i] for i in range(d)], [[cells[max(i, j), min(i, j)] for j in range(d)] for i in range(d)]


# --- 2. characteristic polynomial ------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin, exact below 3,215,031,751 with these bases."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, falling, whose product exceeds ``bound``."""
    out, product, n = [], 1, 1 << 31
    while product <= bound:
        n -= 1
        if is_prime(n):
            out.append(n)
            product *= n
    return out


def hessenberg(h: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``h`` modulo ``p``, zero below its subdiagonal."""
    for m in range(1, len(h) - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        i = m + int(below[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1:, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1:] = (h[m + 1:] - u[:, None] * h[m]) % p
        h[:, m] = (h[:, m] + (h[:, m + 1:] * u % p).sum(axis=1)) % p
    return h


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """det(t - matrix) modulo ``p``, coefficients from t^0 to t^d."""
    d = len(matrix)
    h = hessenberg(np.array([[v % p for v in row] for row in matrix], dtype=np.int64).reshape(d, d), p)
    poly = np.zeros((d + 1, d + 1), np.int64)  # row k: of the leading k x k block
    poly[0, 0] = 1
    for k in range(1, d + 1):
        weight = np.zeros(k, np.int64)
        chain = 1
        for j in range(k - 1, -1, -1):
            weight[j] = int(h[j, k - 1]) * chain % p
            if j:
                chain = chain * int(h[j, j - 1]) % p
        poly[k, 1:] = poly[k - 1, :-1]
        poly[k] = (poly[k] - (weight[:, None] * poly[:k] % p).sum(axis=0)) % p
    return poly[d].tolist()


def coefficient_bound(trace: int, d: int) -> int:
    """Above any coefficient of the polynomial of a positive semidefinite
    matrix: C(d, k) * (trace / d)^k at its largest."""
    return max(math.comb(d, k) * (trace ** k // d ** k + 1) for k in range(d + 1))


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Its exact coefficients, from t^0 up."""
    d = len(matrix)
    primes = primes_beyond(2 * coefficient_bound(sum(matrix[i][i] for i in range(d)), d))
    sent = spark.sparkContext.broadcast(matrix)

    def run(batches):
        for b in batches:
            ps = b.column("p").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array([polynomial_mod(sent.value, p) for p in ps],
                                                                                 pa.list_(pa.int64()))], ["p", "c"])

    found = spark.createDataFrame([(p,) for p in primes], "p long").repartition(len(primes), "p").mapInArrow(
        run, "p long, c array<long>").collect()
    coefficients, modulus = [0] * (d + 1), 1
    for p, residues in found:
        inverse = pow(modulus % p, -1, p)
        coefficients = [c + modulus * ((r - c) * inverse % p) for c, r in zip(coefficients, residues)]
        modulus *= p
    return [c if 2 * c < modulus else c - modulus for c in coefficients]


# --- 3. roots --------------------------------------------------------------

def roots_above(poly: list[int], num: int, shift: int) -> int:
    """Roots (all real, by multiplicity) above num / 2^shift: the sign
    changes of the polynomial moved by that much."""
    d = len(poly) - 1
    c = [v << shift * (d - i) for i, v in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += num * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def positive_at(poly: list[int], num: int, shift: int) -> int:
    """Sign of the polynomial at num / 2^shift."""
    value, d = 0, len(poly) - 1
    for i in range(d, -1, -1):
        value = value * num + (poly[i] << shift * (d - i))
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], k: int) -> list[tuple[int, int, int]]:
    """(num, shift, multiplicity) of the largest positive roots, falling,
    until ``k`` are found by multiplicity; each to ROOT_BITS bits."""
    zero = next(i for i, c in enumerate(poly) if c)
    poly = poly[zero:]  # the roots at 0 have no variance
    d = len(poly) - 1
    if d == 0 or k == 0:
        return []
    out, seen = [], 0
    stack = [(0, 1 << (max(abs(c) for c in poly).bit_length() + 1), 0, d, 0)]
    while stack and seen < k:
        lo, hi, shift, above_lo, above_hi = stack.pop()
        inside = above_lo - above_hi
        if not inside:
            continue
        if lo and (hi - lo) << ROOT_BITS <= hi or inside == 1 and lo:
            num, shift = (hi, shift) if inside > 1 else narrowed(poly, lo, hi, shift)
            out.append((num, shift, inside))
            seen += inside
            continue
        if hi - lo < 2:
            lo, hi, shift = lo << 1, hi << 1, shift + 1
        # far apart in size: halve the exponent first
        mid = 1 << (max(lo, 1).bit_length() + hi.bit_length()) // 2 if hi > 4 * max(lo, 1) else (lo + hi) // 2
        if not lo < mid < hi:
            mid = (lo + hi) // 2
        above_mid = roots_above(poly, mid, shift)
        stack.append((lo, mid, shift, above_lo, above_mid))
        stack.append((mid, hi, shift, above_mid, above_hi))  # upper half first
    return out


def narrowed(poly: list[int], lo: int, hi: int, shift: int) -> tuple[int, int]:
    """The one root in (lo, hi] / 2^shift to ROOT_BITS bits, by signs."""
    end = positive_at(poly, hi, shift)
    if end == 0:
        return hi, shift
    while (hi - lo) << ROOT_BITS > hi:
        if hi - lo < 2:
            lo, hi, shift = lo << 1, hi << 1, shift + 1
        mid = (lo + hi) // 2
        sign = positive_at(poly, mid, shift)
        if sign == 0:
            return mid, shift
        lo, hi = (lo, mid) if sign == end else (mid, hi)
    return hi, shift


# --- 4. components ---------------------------------------------------------

def factor(rows: list[list[Decimal]]) -> tuple[list[list[Decimal]], list[int]]:
    """LU factors in place with row exchanges; a zero pivot becomes tiny."""
    d = len(rows)
    order = list(range(d))
    tiny = max((abs(v) for row in rows for v in row), default=Decimal(1)).scaleb(-DIGITS) or Decimal(1)
    for j in range(d):
        best = max(range(j, d), key=lambda i: abs(rows[i][j]))
        rows[j], rows[best] = rows[best], rows[j]
        order[j], order[best] = order[best], order[j]
        if not rows[j][j]:
            rows[j][j] = tiny
        pivot, tail = rows[j][j], rows[j][j + 1:]
        for i in range(j + 1, d):
            if rows[i][j]:
                f = rows[i][j] / pivot
                rows[i][j] = f
                rows[i][j + 1:] = [a - f * b for a, b in zip(rows[i][j + 1:], tail)]
    return rows, order


def solve(lu, order, b):
    d = len(lu)
    x = [b[i] for i in order]
    for i in range(d):
        x[i] -= sum((lu[i][j] * x[j] for j in range(i)), Decimal(0))
    for i in range(d - 1, -1, -1):
        x[i] = (x[i] - sum((lu[i][j] * x[j] for j in range(i + 1, d)), Decimal(0))) / lu[i][i]
    return x


def null_vectors(matrix: list[list[int]], num: int, shift: int, count: int) -> list[list[float]]:
    """``count`` orthonormal eigenvectors for the root num / 2^shift, the
    largest entry of each positive."""
    d = len(matrix)
    found: list[list[Decimal]] = []
    with localcontext() as ctx:
        ctx.prec = DIGITS
        root = Decimal(num) / Decimal(1 << shift)
        lu, order = factor([[Decimal(v) - root if i == j else Decimal(v) for j, v in enumerate(row)]
                            for i, row in enumerate(matrix)])

        def unit(v):
            for other in found:
                dot = sum(a * b for a, b in zip(v, other))
                v = [a - dot * b for a, b in zip(v, other)]
            norm = sum(a * a for a in v).sqrt()
            top = max(v, key=abs)
            return [a / norm if top > 0 else -a / norm for a in v]

        for c in range(count):
            v = unit([Decimal((i + 1) * (2 * c + 1) * 2654435761 % (1 << 32) + 1) for i in range(d)])
            for _ in range(40):
                last, v = v, unit(solve(lu, order, v))
                if max(abs(a - b) for a, b in zip(v, last)) < Decimal(10) ** -40:
                    break
            found.append(v)
        return [[float(a) for a in v] for v in found]


def eigenvectors(spark: SparkSession, matrix: list[list[int]], roots: list[tuple[int, int, int]], k: int):
    """[(root as Decimal, unit vector)], at most ``k``, falling."""
    sent = spark.sparkContext.broadcast(matrix)
    asked, left = [], k
    for rank, (num, shift, many) in enumerate(roots):
        if left > 0:
            asked.append((rank, str(num), shift, min(many, left)))
            left -= many

    def run(batches):
        for b in batches:
            for rank, num, shift, many in zip(*(b.column(c).to_pylist() for c in ("rank", "num", "shift", "many"))):
                found = null_vectors(sent.value, int(num), shift, many)
                yield pa.RecordBatch.from_arrays([pa.array([rank] * many, pa.int32()), pa.array(range(many), pa.int32()),
                                                  pa.array(found, pa.list_(pa.float64()))], ["rank", "part", "vector"])

    rows = (spark.createDataFrame(asked, "rank int, num string, shift int, many int").repartition(len(asked), "rank")
            .mapInArrow(run, "rank int, part int, vector array<double>").collect())
    with localcontext() as ctx:
        ctx.prec = DIGITS
        return [(Decimal(roots[r["rank"]][0]) / Decimal(1 << roots[r["rank"]][1]), r["vector"])
                for r in sorted(rows, key=lambda r: (r["rank"], r["part"]))]


# --- 5. projection ---------------------------------------------------------

def centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * y - sums, exact (long, or Python's integers where too wide)."""
    bound = n * int(np.abs(y).max(initial=0)) + max((abs(s) for s in sums), default=0)
    kind = np.int64 if bound < LONG else object
    return y.astype(kind) * n - np.array(sums, dtype=kind)


def deviations(z: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; null beyond a long."""
    most = max(abs(int(z.max())), abs(int(z.min()))) if z.size else 0
    if most * most * z.shape[1] >= LONG:
        z = z.astype(object)
    return [int(v) if int(v) < LONG else None for v in (z * z).sum(axis=1)]


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitening(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
              scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained,
    identity_error), a row for each remaining vector and component."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), (whole(F.col(f"`{vector}`"), scale, offset)).alias("x"))
    kind = rows.schema["vec_id"].dataType.simpleString()
    rows = rows.filter("x is not null")
    width = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).select("d").collect()
    if width:
        rows = rows.filter(F.size("x") == width[0]["d"])
    rows = stored(rows, "whitening_rows")
    fit = stored(rows.select("x").distinct(), "whitening_fit")
    n, sums, prods = fit_sums(fit)
    d = len(sums)
    scatter = [[n * prods[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    common = math.gcd(*(v for row in scatter for v in row)) if d else 0
    found = []
    if common:
        small = [[v // common for v in row] for row in scatter]
        poly = characteristic_polynomial(spark, small)
        found = eigenvectors(spark, small, largest_roots(poly, components), components)
    trace = sum(scatter[i][i] for i in range(d))
    with localcontext() as ctx:
        ctx.prec = DIGITS
        variances = [float(root * common / (n * n)) for root, _ in found]
        explained = [float(root * common / trace) for root, _ in found]
    weights = np.array([np.array(v) / math.sqrt(e) for (_, v), e in zip(found, variances)]).reshape(len(found), d)

    def whitened(z):
        return (z / n).astype(np.float64) @ weights.T

    def squares(batches):
        total = np.zeros((len(weights), len(weights)))
        for b in batches:
            if b.num_rows:
                w = whitened(centred(_matrix(b.column("x")) - offset, n, sums))
                total += w.T @ w
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(a.ravel()) for a in (i, j, total)], ["i", "j", "v"])

    error = 0.0
    if found:
        for r in fit.mapInArrow(squares, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            error = max(error, abs(r["v"] / n - (r["i"] == r["j"])))

    def project(batches):
        k = len(found)
        for b in batches:
            if not b.num_rows or not k:
                continue
            z = centred(_matrix(b.column("x")) - offset, n, sums)
            m = len(z)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, n)), pa.array(deviations(z), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(whitened(z).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id"] + [c.split()[0] for c in OUT.split(", ")])

    return rows.mapInArrow(project, f"vec_id {kind}, {OUT}")
