"""Packing of token sequences by cutting-stock column generation.

Documents are cut into full sequences and one rest each.  The histogram of rest lengths is the
demand of a cutting-stock problem: a linear program over patterns (multisets of length classes that
fit a sequence), solved by the simplex method whose columns a knapsack dynamic program prices.
Its size depends on the number of length classes alone.  Rounded patterns give slots; the
documents of a class, ranked by counted offsets, take them in order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vacantia.llm import tokens
from vacantia.llm.workers import tidy
from vacantia.session import stage

LENGTH = 2048


def length_classes(length: int = LENGTH) -> tuple[np.ndarray, int]:
    """Upper bounds of the length classes, ascending, and the unit that they are multiples of."""
    unit = max(1, length // 512)
    units = length // unit
    small = units // 8
    sizes = [*range(1, small + 1), *range(small + 4, units, 4), units]
    return np.array(sorted(set(sizes)), np.int64), unit


def best_pattern(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits ``room`` and has the highest total value."""
    best, choice = np.zeros(room + 1), [-1] * (room + 1)
    use = np.flatnonzero(values > 1e-12)
    worth, size = values[use], sizes[use]
    fit = np.searchsorted(size, np.arange(room + 1), "right").tolist()
    for w in range(1, room + 1):
        best[w] = best[w - 1]
        if fit[w]:
            total = best[w - size[: fit[w]]] + worth[: fit[w]]
            k = total.argmax()
            if total[k] > best[w] + 1e-12:
                best[w], choice[w] = total[k], use[k]
    pattern, w = np.zeros(len(sizes), np.int64), room
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            pattern[choice[w]] += 1
            w -= sizes[choice[w]]
    return float(best[room]), pattern


def generate_patterns(demand: np.ndarray, sizes: np.ndarray, room: int, gap: float = 3e-3) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used in a solution of the linear program.

    The best price bounds the optimum from below (Farley), so pricing ends when the solution is within
    ``gap`` of it; every basis on the way is a valid packing.
    """
    m = len(sizes)
    basis, cost = np.diag(room // sizes).astype(float), np.ones(m)
    inverse = np.diag(1.0 / (room // sizes))
    for turn in range(1, 5 * m + 100):
        if turn % 50 == 0:
            inverse = np.linalg.inv(basis)
        level, price = np.maximum(inverse @ demand, 0), cost @ inverse
        if price.min() < -1e-9:  # a surplus of one class comes in
            column, extra = np.zeros(m), 0.0
            column[price.argmin()] = -1
        else:
            value, column = best_pattern(price, sizes, room)
            extra = 1.0
            if value <= 1 + gap:
                break
        move = inverse @ column
        up = np.flatnonzero(move > 1e-9)
        if not len(up):
            break
        out = up[np.argmin(level[up] / move[up])]
        basis[:, out], cost[out] = column, extra
        row = inverse[out] / move[out]
        inverse -= np.outer(move, row)
        inverse[out] = row
    level = np.maximum(np.linalg.solve(basis, demand.astype(float)), 0)
    real = cost > 0
    return basis[:, real].T.round().astype(np.int64), level[real]


def plan(demand: np.ndarray, sizes: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of patterns that hold every item: the linear program rounded down, the rest first-fit."""
    there = np.flatnonzero(demand)
    if not len(there):
        return []
    patterns, level = generate_patterns(demand[there], sizes[there], room)
    out, left = [], demand[there].copy()
    for pattern, x in zip(patterns, np.floor(level + 1e-6).astype(np.int64)):
        if x > 0:
            out.append((pattern, int(x)))
            left -= pattern * x
    left = np.maximum(left, 0)
    while left.any():  # what rounding left over: largest first, repeated while it fits
        pattern, space = np.zeros(len(there), np.int64), room
        for k in range(len(there) - 1, -1, -1):
            take = min(int(left[k]), space // int(sizes[there[k]]))
            pattern[k], space = take, space - take * int(sizes[there[k]])
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        out.append((pattern, times))
        left -= pattern * times
    whole = []
    for pattern, times in out:
        full = np.zeros(len(sizes), np.int64)
        full[there] = pattern
        whole.append((full, times))
    return whole


def slots(planned: list[tuple[np.ndarray, int]]) -> dict[str, np.ndarray]:
    """Per class and pattern: the first rank that it serves, items per sequence, first sequence, place in it."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in planned:
        place = 0
        for k in np.flatnonzero(pattern)[::-1]:
            rows.append((int(k), taken.get(k, 0), int(pattern[k]), sequence, place))
            taken[k] = taken.get(k, 0) + int(pattern[k]) * times
            place += int(pattern[k])
        sequence += times
    rows.sort()
    names = ("kind", "rank", "each", "sequence", "place")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def _cut(path: str, end_id: int, length: int, bounds: np.ndarray):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(len(bounds), np.int64)
        for batch in parts:
            for a, b, texts in tokens.column_runs(batch["text"]):
                ids, many = tokens.encoder(path).encode(texts, end_id)
                raw = memoryview(ids.astype("<u4").tobytes())
                pieces = -(-many // length)
                doc = np.repeat(np.arange(b - a), pieces)
                start = tokens.steps(pieces) * length
                size = np.minimum(length, many[doc] - start)
                at = (np.cumsum(many) - many)[doc] + start
                crc = [zlib.crc32(raw[4 * x : 4 * (x + n)]) for x, n in zip(at.tolist(), size.tolist())]
                kind = np.searchsorted(bounds, size)
                order = np.argsort(kind, kind="stable")  # ranks in the class, counted on over the task
                count = np.bincount(kind, minlength=len(bounds))
                rank = np.empty(len(kind), np.int64)
                rank[order] = tokens.steps(count) + np.repeat(seen, count)
                seen += count
                yield pa.record_batch({
                    "id": batch["id"].slice(a, b - a).take(pa.array(doc)), "start": pa.array(start), "length": pa.array(size),
                    "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": pa.array(many[doc]), "part": pa.array(np.full(len(doc), part)),
                    "kind": pa.array(kind), "rank": pa.array(rank),
                })
    return work


_PIECE = "id long, start long, length long, ids_crc32 long, doc_tokens long"


def _place(table: dict[str, np.ndarray]):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = int(table["rank"].max()) + (1 << 40) if len(table["rank"]) else 1
        keys = table["kind"] * width + table["rank"]
        for batch in parts:
            kind, rank = batch["kind"].to_numpy(), batch["rank"].to_numpy()
            row = np.searchsorted(keys, kind * width + rank, "right") - 1
            over = rank - table["rank"][row]
            yield batch.drop_columns(["kind", "rank"]).append_column(
                "sequence_id", pa.array(table["sequence"][row] + over // table["each"][row])
            ).append_column("place", pa.array(table["place"][row] + over % table["each"][row]))
    return work


def pack(
    docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
    length: int = LENGTH, end_id: int = tokens.END_ID,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Null text counts as empty: one piece with the end id.  Null ids stay null; repeated rows are packed
    each.  Other columns are ignored; an empty table gives an empty result.
    """
    sizes, unit = length_classes(length)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    pieces = stage(rows.mapInArrow(
        tidy(_cut(tokenizer, end_id, length, sizes * unit)), _PIECE + ", part long, kind long, rank long"), "pieces")
    counts = pieces.groupBy("part", "kind").agg(F.count("*").alias("n"))
    before = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("part", "kind", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    demand = np.zeros(len(sizes), np.int64)
    for kind, n in counts.groupBy("kind").agg(F.sum("n")).collect():  # one row per length class
        demand[kind] = n
    table = slots(plan(demand, sizes, int(sizes[-1])))
    ranked = pieces.join(shift, ["part", "kind"]).select(
        *[c.split()[0] for c in _PIECE.split(", ")], "kind", (F.col("rank") + F.col("shift")).alias("rank"))
    placed = ranked.mapInArrow(tidy(_place(table)), _PIECE + ", sequence_id long, place long")
    within = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        F.col("id").alias(id_column), "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(within), F.lit(0)).alias("offset"),
    )
