"""Vector codes from k-means with adaptive bounds (Drake and Hamerly), in whole numbers.

Vectors are cut into parts with a codebook each.  Between rounds every part keeps, in a written table, its
``b`` closest entries in order, a lower bound of the distance to each, and one outer bound for all other entries.
A round lowers the bounds by what the entries moved and takes the distance to the assigned entry: entries whose
bound lies above it cannot win; those below are verified by exact squared distances, in order of their
bounds; only if the outer bound is below too, all entries are.  Bounds are rounded to the safe side and ties are
always verified, so the codes equal those of comparing everything.  ``b`` follows how deep the lists
of all parts had to be read in the round before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vacantia.llm.whitening import finite
from vacantia.session import scratch_path, stage

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
LISTED, LEAST_LISTED = 16, 4  # entries that a list starts with, and may shrink to
READ_IN_LIST = 0.99  # share of parts whose lists should be long enough in the next round
ROWS = 4096


class Codebook:
    """The entries of one part, and exact squared distances to them."""

    def __init__(self, entries: np.ndarray, largest: int):
        """``largest``: no component of a vector or an entry exceeds it."""
        bound = 4 * entries.shape[1] * largest * largest
        if bound >= 1 << 63:
            raise OverflowError(f"squared distances of components up to {largest} do not fit a long")
        self.kind = np.float64 if bound < 1 << 53 else np.int64  # whole either way
        self.entries = entries.astype(self.kind)
        self.square = (self.entries * self.entries).sum(axis=1)

    def all(self, x: np.ndarray) -> np.ndarray:
        """Rows of ``x`` by entries."""
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ self.entries.T) + self.square

    def pairs(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        apart = x - self.entries[entry]
        return (apart * apart).sum(axis=1)


def _root(square: np.ndarray, up: bool) -> np.ndarray:
    """Distance of a squared distance, on the safe side in double precision."""
    root = np.sqrt(square.astype(np.float64))
    return np.nextafter(np.nextafter(root, np.inf if up else -np.inf), np.inf if up else -np.inf)


def _single(low: np.ndarray) -> np.ndarray:
    """Lower bounds in single precision, never above what they were."""
    return np.nextafter(low.astype(np.float32), np.float32(-np.inf))


def list_entries(book: Codebook, x: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``b`` closest entries of every row, and the bounds of all but the first, the outer one last."""
    square = book.all(x)
    order = np.argsort(square, axis=1, kind="stable")[:, : b + 1]  # ties keep the lower index
    low = _root(np.take_along_axis(square, order, 1)[:, 1:], up=False)
    if order.shape[1] <= b:  # every entry is listed
        low = np.concatenate([low, np.full((len(x), 1), np.inf)], axis=1)
    return order[:, :b].astype(np.uint8), _single(low)


def next_lists(
    book: Codebook, x: np.ndarray, ids: np.ndarray, low: np.ndarray, moved: np.ndarray, b: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of at most ``b`` entries after the entries moved, and how deep each row was read.

    A depth of 0 is decided by the bounds alone, one beyond the list by comparing all entries.
    """
    n, width = ids.shape
    low = low.astype(np.float64)
    low[:, :-1] -= moved[ids[:, 1:]]
    low[:, -1] -= moved.max(initial=0)
    low = np.nextafter(low, -np.inf)
    square = book.pairs(x, ids[:, 0])
    near = low <= _root(square, up=True)[:, None]
    everything = near[:, -1]
    depth = np.where(everything, width, (near * np.arange(1, width + 1)).max(axis=1))
    sure = np.full((n, width), np.inf)  # exact squares of what was verified
    sure[:, 0] = square
    row, at = np.nonzero((np.arange(1, width) <= depth[:, None]) & ~everything[:, None])
    sure[row, at + 1] = book.pairs(x[row], ids[row, at + 1])
    # First the nearest (ties by index), then the others by their bounds.
    exact = np.isfinite(sure)
    bound = np.concatenate([np.zeros((n, 1)), low[:, :-1]], axis=1)
    bound[exact] = _root(sure[exact], up=False)
    first = np.lexsort((ids, sure), axis=1)[:, 0]
    bound[np.arange(n), first] = -np.inf
    order = np.argsort(bound, axis=1, kind="stable")
    ids = np.take_along_axis(ids, order, 1)
    bound = np.concatenate([np.take_along_axis(bound, order, 1)[:, 1:], low[:, -1:]], axis=1)
    if b < width:
        outer = bound[:, b - 1 :].min(axis=1)
        ids, bound = ids[:, :b], bound[:, :b].copy()
        bound[:, -1] = outer
    bound = _single(bound)
    again = np.flatnonzero(everything)
    if len(again):
        ids = ids.copy()
        ids[again], bound[again] = list_entries(book, x[again], ids.shape[1])
    return ids, bound, depth


def _numbers(part: pa.RecordBatch, column: str, kind: type) -> np.ndarray:
    """Packed lists of equal length as a matrix."""
    return np.frombuffer(b"".join(part[column].to_pylist()), kind).reshape(part.num_rows, -1)


def _packed(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    raw, width = rows.tobytes(), rows.shape[1] * rows.itemsize
    return pa.array([raw[i * width : (i + 1) * width] for i in range(len(rows))], pa.binary())


def _hex(codes: np.ndarray) -> pa.Array:
    raw, width = codes.astype(np.uint8).tobytes().hex(), 2 * codes.shape[1]
    return pa.array([raw[i * width : (i + 1) * width] for i in range(len(codes))], pa.string())


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Trainer:
    """Codebooks of one width on the driver (bounded), vectors and lists in written tables."""

    def __init__(self, rows: DataFrame, width: int, entries: int, rounds: int):
        self.rows, self.rounds = rows, rounds
        self.parts, self.width = PARTS, width // PARTS
        first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").toArrow()  # at most 256 vectors
        x = np.array(first["x"].to_pylist(), np.int64).reshape(-1, width)
        self.books = [x[:, p * self.width : (p + 1) * self.width].copy() for p in range(self.parts)]
        self.entries = len(x)
        low, high = rows.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
        self.largest = max(abs(low), abs(high))
        self.kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if self.largest <= np.iinfo(k).max)
        self.listed = [min(LISTED, self.entries)] * self.parts
        self.moved: list[np.ndarray] | None = None
        self.depths: list[np.ndarray] = []

    def _work(self, last: bool):
        books, largest, kind, width, parts = self.books, self.largest, self.kind, self.width, self.parts
        listed, moved, size = self.listed, self.moved, self.entries

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            book = [Codebook(e, largest) for e in books]
            sums = np.zeros((parts, size, width + 1), np.int64)
            depths = np.zeros((parts, LISTED + 2), np.int64)
            for whole in batches:
                for row in range(0, whole.num_rows, ROWS):
                    part = whole.slice(row, ROWS)
                    if moved is None:
                        x = part["x"].flatten().to_numpy().reshape(part.num_rows, -1)
                    else:
                        x = _numbers(part, "x", kind)
                    code, error, state = [], np.zeros(len(x), np.int64), {}
                    for p in range(parts):
                        of = x[:, p * width : (p + 1) * width].astype(book[p].kind)
                        if moved is None:
                            ids, low = list_entries(book[p], of, listed[p])
                            depth = np.full(len(of), ids.shape[1])
                        else:
                            ids, low, depth = next_lists(
                                book[p], of, _numbers(part, f"ids{p}", np.uint8), _numbers(part, f"low{p}", np.float32), moved[p], listed[p])
                        code.append(ids[:, 0])
                        depths[p] += np.bincount(depth, minlength=LISTED + 2)
                        if last:
                            error += book[p].pairs(of, ids[:, 0]).astype(np.int64)
                            continue
                        state |= {f"ids{p}": _packed(ids), f"low{p}": _packed(low)}
                        sums[p, :, width] += np.bincount(ids[:, 0], minlength=size)
                        for d in range(width):  # whole numbers below 2**53
                            sums[p, :, d] += np.bincount(ids[:, 0], of[:, d], size).astype(np.int64)
                    held = {"id": part["id"], "label": part["label"]}
                    if last:
                        held |= {"code": _hex(np.stack(code, axis=1)), "error": pa.array(error)}
                    else:
                        held |= {"x": _packed(x.astype(kind))} | state
                    yield pa.RecordBatch.from_pydict(held | {"sums": pa.nulls(len(x), pa.list_(pa.int64()))})
            summary = pa.array([np.concatenate([depths.ravel(), sums.ravel()])], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, f.type) for f in schema if f.name != "sums"] + [summary], names=schema.names)

        kinds = {"id": self.rows.schema["id"].dataType, "label": self.rows.schema["label"].dataType}
        if last:
            kinds |= {"code": T.StringType(), "error": T.LongType()}
        else:
            kinds |= {"x": T.BinaryType()} | {f"{c}{p}": T.BinaryType() for p in range(parts) for c in ("ids", "low")}
        kinds |= {"sums": T.ArrayType(T.LongType())}
        declared = T.StructType([T.StructField(n, k) for n, k in kinds.items()])
        schema = to_arrow_schema(declared)
        return work, declared

    def _pass(self, rows: DataFrame, last: bool = False) -> tuple[DataFrame, str]:
        """One written pass over ``rows``; reads what its tasks summed up."""
        work, kinds = self._work(last)
        spark = rows.sparkSession
        path = scratch_path(spark, "codes")
        rows.mapInArrow(work, kinds).write.option("compression", "zstd").parquet(path)
        written = spark.read.schema(kinds).parquet(path)
        told = written.filter("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "v"))
        found = told.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").toArrow()["v"].to_numpy()  # entries x width numbers
        cut = self.parts * (LISTED + 2)
        self.depths.append(found[:cut].reshape(self.parts, -1))
        self.sums = found[cut:].reshape(self.parts, self.entries, self.width + 1)
        return written.filter("sums IS NULL").drop("sums"), path

    def _move(self) -> None:
        """Entries become the floored means of their parts; lists follow the depths that were read."""
        self.moved = []
        for p, book in enumerate(self.books):
            count = self.sums[p, :, self.width]
            new = book.copy()
            used = count > 0
            new[used] = self.sums[p, used, : self.width] // count[used, None]
            apart = (new - book).astype(np.float64)
            self.moved.append(np.sqrt((apart * apart).sum(axis=1)) * (1 + 1e-12))
            self.books[p] = new
            reach = np.cumsum(self.depths[-1][p]) / max(1, self.depths[-1][p].sum())
            if len(self.depths) > 1:  # the first pass reads everything
                deep = int(np.searchsorted(reach, READ_IN_LIST)) + 1
                self.listed[p] = min(self.listed[p], max(LEAST_LISTED, deep), self.entries)

    def run(self) -> DataFrame:
        """(id, label, code, error) of every row."""
        rows, before = self.rows, None
        for _ in range(self.rounds):
            rows, path = self._pass(rows)
            if before:
                discard(rows.sparkSession, before)  # the table after it is complete
            before = path
            self._move()
        done, _ = self._pass(rows, last=True)
        discard(rows.sparkSession, before)
        return done

    def digest(self) -> str:
        numbers = ",".join(str(v) for book in self.books for entry in book.tolist() for v in entry)
        return hashlib.sha256(numbers.encode()).hexdigest()


OUT = "code string, error long, label_error long, codebooks_sha256 string"


def encode_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """Per row: id, ``code`` (two hex digits per part), ``error``, ``label_error``, ``codebooks_sha256``.

    Components become ``floor(1024 x)``.  The codebooks start as the parts of the ``entries`` (256 at most) smallest ids,
    ties by the vector, null ids last; fewer rows give fewer entries.  Rows whose vector is null, empty, or holds null or
    non-finite components are dropped.  Vectors of different widths have codebooks of their own; a width that
    does not divide into four parts is an error, and so are squared distances beyond a long.  Repeated rows count each.
    ``label_error`` is summed over all widths, null labels together.  An empty table gives an empty result; other
    columns are ignored.

    Rounds write their lists to the shared folder and drop those before, so two tables exist at most.  What reaches
    the driver is one number per entry and component.
    """
    sound = vectors.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("x"),
    ).filter(finite(F.col("x")) & (F.size("x") > 0))
    whole = F.transform("x", lambda c: F.floor(c.cast("double") * SCALE))
    rows = stage(sound.select("id", "label", whole.alias("x")), "whole")
    widths = [r["w"] for r in rows.select(F.size("x").alias("w")).distinct().orderBy("w").collect()]
    if bad := [w for w in widths if w % PARTS]:
        raise ValueError(f"vectors of {bad} components do not divide into {PARTS} equal parts")
    if not widths:
        kind = rows.schema["id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"id {kind}, {OUT}").withColumnRenamed("id", id_column)
    done = []
    for width in widths:
        trainer = Trainer(rows.filter(F.size("x") == width), width, min(entries, ENTRIES), rounds)
        done.append(trainer.run().withColumn("codebooks_sha256", F.lit(trainer.digest())))
    coded = reduce(DataFrame.union, done)
    errors = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(errors, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(id_column), "code", "error", "label_error", "codebooks_sha256")
