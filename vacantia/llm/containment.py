"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``WINDOW`` words (a shorter item is one window); a window is the set
of its shingles of three words.  Containment asks for all shingles of a window, so the rarest of them is a
sufficient prefix:

1. one pass over the documents counts the shingles that items have; every distinct window picks its rarest;
2. a second pass finds the picked shingles in the documents, each with the words around it;
3. they are joined on the shingle.  The place of the shingle in both bounds where the window must begin, and
   the words around it how long it can be; what is left is compared word by word.

Both passes test shingles against a bitmap of bounded size, which may let others through and never
loses one: the counts, the join and the comparison of words are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from vacantia.llm.rolling import WORD_BASE, Texts, equal_spans, mix, prefix, texts_of
from vacantia.session import stage

WINDOW = 10
SHINGLE = 3
SALTS = 8
MAX_BITS = 1 << 27  # 16 MB, whatever the number of items
BITS_PER_KEY, PROBES = 32, 4
HELD = 1 << 20  # counts and bytes that a task holds before it hands them on

# Bytes of words as they are, capital letters lowered, everything else a space.
_LETTERS = np.full(256, 32, np.uint8)
for _low, _high, _to in ((0x30, 0x39, 0), (0x41, 0x5A, 32), (0x61, 0x7A, 0), (0x80, 0xFF, 0)):
    _LETTERS[_low : _high + 1] = np.arange(_low, _high + 1) + _to


class Words:
    """Words of some texts and the hashes of their shingles."""

    def __init__(self, texts: Texts):
        self.texts = Texts(texts.first, _LETTERS[texts.data], texts.offsets)
        self.start, self.end, self.first, self.hash = self.texts.word_hashes()
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.sums = prefix(self.hash, WORD_BASE)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` words of one text."""
        hashes = equal_spans(self.sums, size, WORD_BASE)
        at = np.flatnonzero(self.doc[: len(hashes)] == self.doc[size - 1 :]) if len(hashes) else np.zeros(0, np.int64)
        return at, (hashes[at] + np.uint64(size)).view(np.int64)

    def text(self, low: int, high: int) -> bytes:
        """Words ``low`` to ``high`` joined by one space."""
        return b" ".join(self.texts.data[self.start[low] : self.end[high - 1]].tobytes().split())


# --- Bitmaps ---------------------------------------------------------------------------------

class Bitmap:
    """Bits of a set of hashes; held by every task, at most ``MAX_BITS``."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def among(self, hashes: np.ndarray) -> np.ndarray:
        """Places in ``hashes`` of those that may be in the set."""
        at, value = np.arange(len(hashes)), hashes.view(np.uint64)
        for k in range(PROBES):
            bit = mix(value[at] + np.uint64(k)) & self.mask
            at = at[(self.bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        return at


def bitmap_of(keys: DataFrame) -> Bitmap:
    """The bitmap of a column ``key``, set on executors; the driver gets the bits only."""
    n = keys.count()
    bits = min(MAX_BITS, 1 << max(15, (BITS_PER_KEY * n - 1).bit_length()))

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            value = part["key"].to_numpy().view(np.uint64)
            at = np.concatenate([mix(value + np.uint64(k)) & np.uint64(bits - 1) for k in range(PROBES)])
            yield pa.RecordBatch.from_pydict({"bit": pa.array(np.unique(at).astype(np.int64) + 1)})  # from 1, as Spark counts

    set_ = keys.select("key").mapInArrow(work, "bit long")
    found = set_.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))  # 4096 bytes a bucket
    out = np.zeros(bits // 8, np.uint8)
    for r in found.collect():  # MAX_BITS at most
        piece = np.frombuffer(r["bits"], np.uint8)
        at = (r["bucket"] - 1) * len(piece)
        out[at : at + len(piece)] = piece[: len(out) - at]
    return Bitmap(out)


# --- Items -----------------------------------------------------------------------------------

def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, wid, words, size, keys) of every window of every item; ``keys`` in order of place."""
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for t in texts_of(part["text"]):
                w = Words(t)
                sized = {k: w.shingles(k) for k in range(1, SHINGLE + 1)}
                rows: dict[str, list] = {c: [] for c in ("item", "words", "size", "keys")}
                for i in np.flatnonzero(w.count):
                    n = min(window, int(w.count[i]))
                    k = min(SHINGLE, n)
                    at, key = sized[k]
                    name = part["item"][t.first + int(i)].as_py()
                    for first in range(w.first[i], w.first[i + 1] - n + 1):
                        low = np.searchsorted(at, first)
                        rows["item"].append(name)
                        rows["words"].append(w.text(first, first + n).decode("utf-8", "replace"))
                        rows["size"].append(n)
                        rows["keys"].append(key[low : low + n - k + 1].tolist())
                    if len(rows["item"]) >= 4096:
                        yield _batch(rows)
                        rows = {c: [] for c in rows}
                yield _batch(rows)

    found = items.select("item", "text").mapInArrow(work, "item string, words string, size int, keys array<long>")
    return found.select("item", F.sha2("words", 256).alias("wid"), "words", "size", "keys")


def _batch(rows: dict[str, list]) -> pa.RecordBatch:
    kinds = {"item": pa.string(), "words": pa.string(), "size": pa.int32(), "keys": pa.list_(pa.int64())}
    return pa.RecordBatch.from_pydict({c: pa.array(v, kinds[c]) for c, v in rows.items()})


# --- Documents -------------------------------------------------------------------------------

def _count_shingles(sizes: list[int], shared) -> Callable:
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def counted() -> pa.RecordBatch:
            key, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            total = np.bincount(place, np.concatenate([n for _, n in held]), len(key))
            return pa.RecordBatch.from_pydict({"key": pa.array(key), "n": pa.array(total.astype(np.int64))})

        for part in parts:
            for t in texts_of(part["text"]):
                w = Words(t)
                for k in sizes:
                    _, key = w.shingles(k)
                    key, n = np.unique(key[shared.value.among(key)], return_counts=True)
                    held.append((key, n))
                    size += len(key)
            if size > HELD:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()
    return work


def _find_shingles(sizes: list[int], window: int, shared, id_type: T.DataType) -> tuple[Callable, str]:
    """One row with ``n_words`` per document, and one per place of a picked shingle."""
    kinds = {"uid": pa.int64(), "id": to_arrow_type(id_type), "n_words": pa.int64(), "key": pa.int64(), "place": pa.int64(), "at": pa.int32(), "around": pa.string()}

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            uid = part["uid"].to_numpy()
            for t in texts_of(part["text"]):
                w = Words(t)
                n = len(w.count)
                none = {c: pa.nulls(n, kinds[c]) for c in ("key", "place", "at", "around")}
                yield pa.RecordBatch.from_pydict(
                    {"uid": pa.array(uid[t.first : t.first + n]), "id": part["id"].slice(t.first, n),
                     "n_words": pa.array(w.count.astype(np.int64))} | none)
                for k in sizes:
                    at, key = w.shingles(k)
                    found = shared.value.among(key)
                    rows: list[tuple] = []
                    held = 0
                    for first, hash_ in zip(at[found].tolist(), key[found].tolist()):
                        doc = int(w.doc[first])
                        begin, end = int(w.first[doc]), int(w.first[doc + 1])
                        low = max(begin, first - window + k)  # where a window with this shingle may begin and end
                        around = w.text(low, min(end, first + window)).decode("utf-8", "replace")
                        rows.append((int(uid[t.first + doc]), None, None, hash_, first - begin, first - low, around))
                        held += len(around)
                        if held > HELD:
                            yield _rows(rows, kinds)
                            rows, held = [], 0
                    if rows:
                        yield _rows(rows, kinds)
    return work, f"uid long, id {id_type.simpleString()}, n_words long, key long, place long, at int, around string"


def _rows(rows: list[tuple], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))


def _matches(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(uid, first, size, wid) of every window that occurs: joined on the shingle, checked word by word.

    A passage that many documents share is one hot shingle: its places are dealt over ``SALTS``
    copies of the few windows that picked it.
    """
    place = found.filter("key IS NOT NULL").withColumn("salt", F.pmod("uid", F.lit(SALTS)))
    side = windows.withColumn("salt", F.explode(F.array([F.lit(i).cast("long") for i in range(SALTS)])))
    offset, size = F.col("offset"), F.col("size")
    around = F.split("around", " ")
    fits = (offset <= F.col("at")) & (F.col("at") - offset + size <= F.size("near"))
    near = place.withColumn("near", around).drop("around", "n_words", "id")
    joined = near.join(side, ["key", "salt"]).filter(fits)
    same = F.array_join(F.slice("near", F.col("at") - offset + 1, size), " ") == F.col("words")
    return joined.filter(same).select("uid", (F.col("place") - offset).alias("first"), "size", "wid").distinct()


def contaminated_words(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """Per document: id, ``n_words``, ``n_hit``, ``spans`` (first word, word after the last) and ``items``.

    Words are runs of ASCII letters (lowered), digits and characters beyond ASCII.  A document word is hit inside
    any occurrence of ``window`` consecutive words of an item, or of the whole item if it is shorter.  Null texts
    and items without words match nothing.  Repeated documents, null ids too, come out each; items are
    told apart by id as a string, rows with one id are one item, and items without an id count together under ''.  Empty tables
    give an empty result or no hits; other columns are ignored.  A document and the documents' hits of
    one item window are never collected: one document's spans are in one task, and so are its items.
    """
    spark = docs.sparkSession
    named = items.select(F.coalesce(F.col(item_column).cast("string"), F.lit("")).alias("item"), F.col(item_text).cast("string").alias("text"))
    offered = stage(item_windows(named, window), "windows")
    windows = stage(offered.groupBy("wid").agg(
        F.first("words").alias("words"), F.first("size").alias("size"), F.first("keys").alias("keys")), "distinct")
    sizes = [r["k"] for r in windows.select(F.least("size", F.lit(SHINGLE)).alias("k")).distinct().orderBy("k").collect()]
    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    placed = windows.select("wid", F.posexplode("keys").alias("offset", "key"))
    known = spark.sparkContext.broadcast(bitmap_of(placed.select("key").distinct()))  # MAX_BITS at most
    counts = texts.select("text").mapInArrow(_count_shingles(sizes, known), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    order = F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), "key", "offset")
    rarest = placed.join(counts, "key", "left").groupBy("wid").agg(F.min(order).alias("p")).select("wid", "p.key", "p.offset")
    picked = stage(windows.drop("keys").join(rarest, "wid"), "picked")

    wanted = spark.sparkContext.broadcast(bitmap_of(picked.select("key").distinct()))
    work, kinds = _find_shingles(sizes, window, wanted, texts.schema["id"].dataType)
    found = stage(texts.mapInArrow(work, kinds), "found")
    matches = stage(_matches(found, picked), "matches")

    # Words covered: overlapping windows of a document become spans.
    in_doc = Window.partitionBy("uid").orderBy("first", "size")
    end = F.col("first") + F.col("size")
    runs = matches.select("uid", "first", "size").distinct()
    runs = runs.withColumn("reach", F.max(end).over(in_doc.rowsBetween(Window.unboundedPreceding, -1)))
    runs = runs.withColumn("run", F.sum((F.col("reach").isNull() | (F.col("reach") < F.col("first"))).cast("int")).over(in_doc))
    spans = runs.groupBy("uid", "run").agg(F.min("first").alias("first"), F.max(end).alias("last"))
    spans = spans.groupBy("uid").agg(
        F.sum(F.col("last") - F.col("first")).alias("n_hit"),
        F.array_sort(F.collect_list(F.struct("first", F.col("last").alias("last")))).alias("spans"))
    # Windows with the same items count once a document before they are opened into items.
    owners = offered.groupBy("wid").agg(F.array_sort(F.collect_set("item")).alias("items"))
    owners = owners.withColumn("group", F.sha2(F.to_json("items"), 256))
    groups = owners.groupBy("group").agg(F.first("items").alias("items"))
    in_groups = matches.select("uid", "wid").distinct().join(owners.select("wid", "group"), "wid").select("uid", "group").distinct()
    of_doc = in_groups.join(groups, "group").select("uid", F.explode("items").alias("item"))
    of_doc = of_doc.groupBy("uid").agg(F.array_sort(F.collect_set("item")).alias("items"))

    out = found.filter("n_words IS NOT NULL").select("uid", "id", "n_words").join(spans, "uid", "left").join(of_doc, "uid", "left")
    return out.select(
        F.col("id").alias(id_column), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def digest_of_items(items: Column) -> Column:
    """SHA-256 of the sorted ids joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)
