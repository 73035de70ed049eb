"""Whitening by contour integration on the covariance of all vectors.

Two passes give exact sums and centred products of whole numbers.  On the covariance, whose size is
that of a vector, quadrature of complex shifted solves along a circle projects a block of vectors
onto the eigenvalues inside it; Rayleigh-Ritz extracts the components from that block, and sweeps are
repeated until they are exact.  Circles are laid from the top of the spectrum downwards.  Inertia counts
(signs of the pivots of ``T - t I``, ``T`` the covariance in tridiagonal form) say how many eigenvalues
lie in each circle and above the last cut, so a missed or a repeated one is an error and not a result.
A third pass takes the covariance of what was whitened, and the rows are written out in a fourth.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.session import stage

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
NODES = 8  # of the upper half circle; the lower half is its conjugate
IN_CIRCLE = 12  # eigenvalues that a circle is cut down to
SWEEPS = 60
RANK = 1e-12  # eigenvalues below this share of the largest have no direction
SLICE = 1 << 20  # numbers that a task works on at once


# --- The covariance: one matrix of the width of a vector -------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections."""
    a = a.copy()
    n = len(a)
    off = np.zeros(max(0, n - 1))
    for k in range(n - 1):
        x = a[k + 1 :, k].copy()
        off[k] = -np.copysign(np.linalg.norm(x), x[0])
        x[0] -= off[k]
        size = x @ x
        if size > 0:
            rest = a[k + 1 :, k + 1 :]
            p = rest @ x * (2 / size)
            p -= x * ((p @ x) / size)
            rest -= np.outer(x, p) + np.outer(p, x)
    return np.diag(a).copy(), off


def inertia(form: tuple[np.ndarray, np.ndarray], t: float) -> int:
    """Eigenvalues above ``t``: positive pivots of the tridiagonal form less ``t``."""
    diagonal, off = form
    tiny = np.finfo(float).tiny
    above, pivot = 0, 1.0
    for k, d in enumerate(diagonal.tolist()):
        pivot = d - t - (off[k - 1] ** 2 / pivot if k else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        above += pivot > 0
    return above


def _cut(form: tuple, low: float, high: float, safe: float) -> tuple[float, int] | None:
    """A place between the two with no eigenvalue near it, and the eigenvalues above it."""
    for share in (0.5, 0.45, 0.55, 0.4, 0.6, 0.33, 0.67, 0.25, 0.75, 0.15, 0.85):
        t = low + share * (high - low)
        if low + 2 * safe < t < high - 2 * safe and inertia(form, t - safe) == (n := inertia(form, t + safe)):
            return t, n
    return None


def circles(form: tuple, top: float, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues between) from a cut with at least ``wanted`` above it to the top."""
    safe, n = 1e-9 * top, len(form[0])
    low, high, above = -0.01 * top, 1.01 * top, n
    bottom, over = low, high
    while above > wanted + wanted // 4:
        place = _cut(form, bottom, over, safe)
        if place is None:
            break
        if place[1] >= wanted:
            bottom, above = place
        else:
            over = place[0]
    found, open_ = [], [(bottom, high, above)]
    while open_:
        a, b, inside = open_.pop()
        place = _cut(form, a, b, safe) if inside > IN_CIRCLE else None
        if place is None:
            found += [(a, b, inside)] if inside else []
            continue
        higher = place[1] - inertia(form, b)
        open_ += [(a, place[0], inside - higher), (place[0], b, higher)]
    return found


def in_circle(v: np.ndarray, low: float, high: float, count: int, top: float) -> np.ndarray:
    """The ``count`` eigenvectors of ``v`` with eigenvalues between ``low`` and ``high``."""
    n = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    turn = radius * np.exp(1j * np.pi * (np.arange(NODES) + 0.5) / NODES)
    block = np.random.default_rng(n + count).standard_normal((n, min(n, count + count // 2 + 4)))
    reached = False
    for _ in range(SWEEPS):
        projected = np.zeros_like(block)
        for z in turn:
            shifted = -v.astype(complex)
            shifted[np.diag_indices(n)] += centre + z
            projected += (z * np.linalg.solve(shifted, block)).real / NODES
        basis = np.linalg.qr(projected)[0]
        values, mixed = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz on the block
        block = basis @ mixed
        inside = (values > low) & (values < high)
        rest = v @ block[:, inside] - block[:, inside] * values[inside]
        if inside.sum() == count and np.abs(rest).max(initial=0) <= 1e-13 * n**0.5 * top:
            if reached:  # one more sweep than needed
                return block[:, inside]
            reached = True
    raise ArithmeticError(f"{count} eigenvalues lie between {low} and {high}, {inside.sum()} were extracted")


def components(v: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit vectors as columns.

    At most ``wanted``; directions whose eigenvalue is zero to working precision are none.
    """
    n = len(v)
    top = float(np.abs(v).sum(axis=1).max(initial=0))
    if top == 0:
        return np.zeros(0), np.zeros((n, 0))
    form = tridiagonal(v)
    laid = circles(form, top, min(wanted, n))
    parts = [in_circle(v, low, high, count, top) for low, high, count in laid]
    basis = np.linalg.qr(np.concatenate(parts, axis=1))[0]
    values, mixed = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], (basis @ mixed)[:, order]
    bottom = min(low for low, _, _ in laid)
    if (values > bottom).sum() != inertia(form, bottom):
        raise ArithmeticError("the components do not agree with the inertia of the covariance")
    keep = np.flatnonzero(values > RANK * values[0])[:wanted]
    values, vectors = values[keep], vectors[:, keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))])
    return values, vectors * sign


# --- Passes over all vectors -----------------------------------------------------------------

def _slices(part: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and whole numbers of some rows of a batch at a time."""
    x = part["x"].flatten().to_numpy().reshape(-1, width)
    step = max(1, SLICE // width)
    for row in range(0, len(x), step):
        yield row, x[row : row + step]


def _sums(rows: DataFrame, width: int) -> list[int]:
    """Exact sum of every dimension."""
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for part in parts:
            for _, x in _slices(part, width):
                low = x.min(axis=0)
                total = [t + int(s) + int(m) * len(x) for t, s, m in zip(total, (x - low).sum(axis=0), low)]
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(range(width), pa.int32()), "v": pa.array([decimal.Decimal(t) for t in total], pa.decimal128(38))})

    found = rows.select("x").mapInArrow(work, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v"))
    return [int(r["v"]) for r in found.orderBy("i").collect()]  # one number per dimension


def _moments(rows: DataFrame, width: int, work_on: Callable[[np.ndarray], np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and products over all rows of the ``size`` numbers that ``work_on`` makes of a row."""
    upper = np.triu_indices(size)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(size), np.zeros((size, size))
        for part in parts:
            for _, x in _slices(part, width):
                y = work_on(x)
                total += y.sum(axis=0)
                product += y.T @ y
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(np.concatenate([upper[0], np.arange(size)]), pa.int32()),
            "j": pa.array(np.concatenate([upper[1], np.full(size, -1)]), pa.int32()),
            "v": pa.array(np.concatenate([product[upper], total])),
        })

    # At most width * (width + 3) / 2 numbers are left after the sum, whatever the number of rows.
    found = rows.select("x").mapInArrow(work, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (found[c].to_numpy() for c in "ijv")
    total, product = np.zeros(size), np.zeros((size, size))
    total[i[j < 0]] = v[j < 0]
    i, j, v = i[j >= 0], j[j >= 0], v[j >= 0]
    product[i, j] = product[j, i] = v
    return total, product


def _deviations(x: np.ndarray, near: np.ndarray, rest: list[int], n: int) -> pa.Array:
    """Exact sum over dimensions of ``(n x - S)**2``, where ``S = n near + rest``."""
    u = x - near
    most = int(np.abs(u).max(initial=0))
    small = most * max(most, *map(abs, rest)) * x.shape[1] < 1 << 62
    u, r = (u, np.array(rest, np.int64)) if small else (u.astype(object), np.array(rest, object))
    square, cross, fixed = (u * u).sum(axis=1).tolist(), (u @ r).tolist(), sum(v * v for v in rest)
    return pa.array([decimal.Decimal(n * n * s - 2 * n * c + fixed) for s, c in zip(square, cross)], pa.decimal128(38))


def _whitened(rows: DataFrame, width: int, n: int, wanted: int) -> DataFrame:
    """The result for the ``n`` vectors of one width."""
    sums = _sums(rows, width)
    near = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # the mean to the nearest whole number
    rest = [s - n * int(m) for s, m in zip(sums, near)]
    off = np.array([r / n for r in rest])
    total, product = _moments(rows, width, lambda x: (x - near).astype(np.float64), width)
    values, vectors = components(product / n - np.outer(total / n, total / n), wanted)
    trace = float(np.trace(product) / n - (off * off).sum())
    weights, k = vectors / np.sqrt(values), len(values)
    score = lambda x: ((x - near) - off) @ weights
    total, product = _moments(rows, width, score, k)
    error = float(np.abs(product / n - np.outer(total / n, total / n) - np.eye(k)).max(initial=0))
    explained = values / trace if trace > 0 else values

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for row, x in _slices(part, width):
                again = pa.array(np.repeat(np.arange(len(x)), k))
                m = len(x) * k
                yield pa.RecordBatch.from_arrays([
                    part["id"].slice(row, len(x)).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(m, n)), _deviations(x, near, rest, n).take(again), pa.array(score(x).ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(m, error)),
                ], names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("id", "x").mapInArrow(work, f"id {rows.schema['id'].dataType.simpleString()}, {OUT}")


OUT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whole_numbers(vector: Column) -> Column:
    """``floor(64 c) + 1000000`` of every entry."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)


def finite(vector: Column) -> Column:
    """Not null, and no null or non-finite entry."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", wanted: int = COMPONENTS,
) -> DataFrame:
    """Per row and component: id, ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null, empty, or holds null or non-finite entries are dropped.  Vectors of
    different widths are fitted apart, one width after another, ``n`` being the rows of theirs.  Repeated rows
    and ids, null ids too, count and come out each.  A direction in which all vectors agree has no unit variance: its eigenvalue is zero
    to working precision and it is no component, so a single row, or equal rows, give no rows; among equal
    eigenvalues any basis of their space is taken.  ``deviation`` is a decimal of 38 digits, since n squared outgrows a
    long at a few billion rows; an entry beyond the range of a long is an error.  An empty table gives an empty result; other columns are ignored.

    What reaches the driver is bounded by the width of a vector: its sums and products, never rows.
    """
    sound = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).alias("x")).filter(finite(F.col("x")) & (F.size("x") > 0))
    rows = stage(sound.select("id", whole_numbers(F.col("x")).alias("x")), "whole")
    widths = rows.groupBy(F.size("x").alias("w")).agg(F.count("*").alias("n")).orderBy("w").collect()
    if not widths:
        kind = rows.schema["id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"id {kind}, {OUT}").withColumnRenamed("id", id_column)
    found = [_whitened(rows.filter(F.size("x") == w["w"]), w["w"], w["n"], wanted) for w in widths]
    return reduce(DataFrame.union, found).withColumnRenamed("id", id_column)
