"""Near-duplicate documents by DartMinHash signatures of weighted word shingles.

Every shingle owns a Poisson process of darts over (weight, time), drawn from its hash: darts
are thrown cell by cell of the weight axis, each with a time, a place in the cell and one of
``COORDINATES`` coordinates.  A text catches the darts that land below a shingle's weight (its number
of occurrences) and keeps the earliest per coordinate, so two texts agree in a coordinate with
the probability of their weighted Jaccard similarity.  Only about ``K (ln K + 3)`` darts are
thrown per text, whatever its length.

Signatures are cut into bands.  Texts that agree in a band are first compared with a few pivots of
their bucket, round by round as long as that pays, which makes one class of most near copies.  Then
every pair of a bucket that is still in different classes is compared, small buckets pair by pair and
larger ones block against block.  Links are verified on the whole shingle sets, and classes are the
connected components of verified links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.llm import blocks as B
from vacantia.llm.components import components
from vacantia.llm.containment import bitmap_of
from vacantia.llm.rolling import WORD_BASE, Texts, equal_spans, mix, prefix, spans, texts_of
from vacantia.llm.workers import tidy
from vacantia.session import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
PIVOTS = 8  # per bucket in the rounds after the first
ROUNDS = 4  # of pivots at most; they save comparisons, and what they leave is compared completely
PAYING = 0.05  # share of a round's pairs that are links, below which no other round follows
SMALL = 16  # members of a bucket whose pairs are rows of their own
BLOCK, BLOCK_WORDS = 512, 1 << 20  # texts, and words of texts, of a block of a larger bucket
COORDINATES = BANDS * ROWS
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, 4, dtype=np.uint64) * _STEP)


def by_text(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The order by text, then value; texts are few, so their numbers are sorted digit by digit."""
    order = np.argsort(values)
    return order[np.argsort(doc[order].astype(np.int16 if n < 1 << 15 else np.int64), kind="stable")]


def shingles(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) for all distinct shingles, and the number of words per text.

    A shingle is five consecutive words; a text of one to four words is a shingle of its own.
    """
    start, _, first, hash_ = t.word_hashes()
    n = np.diff(first)
    doc = np.repeat(np.arange(len(t)), n)
    sums = prefix(hash_, WORD_BASE)
    runs = equal_spans(sums, SHINGLE, WORD_BASE)
    whole = doc[: len(runs)] == doc[SHINGLE - 1 :][: len(runs)]
    small = np.flatnonzero((n > 0) & (n < SHINGLE))
    doc = np.concatenate([doc[: len(runs)][whole], small])
    runs = np.concatenate([runs[whole], spans(sums, first[small], first[small + 1], WORD_BASE)])
    order = by_text(doc, runs, len(t))
    doc, runs = doc[order], runs[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (runs[1:] != runs[:-1])
    at = np.flatnonzero(new)
    return doc[at], runs[at], np.diff(np.append(at, len(doc))), n


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """The earliest dart of each text and coordinate, as ``n_docs`` rows of dart ids.

    Texts without elements get zeros.
    """
    out = np.zeros((n_docs, COORDINATES), np.uint64)
    total = np.bincount(doc, weight, n_docs)
    until = COORDINATES * (np.log(COORDINATES) + 3.0) / np.maximum(total, 1)
    todo = np.flatnonzero(total > 0)
    while len(todo):  # a text that lacks a coordinate is thrown at again, for twice the time
        wanted = np.zeros(n_docs, bool)
        wanted[todo] = True
        use = wanted[doc]
        found = _throw(doc[use], element[use], weight[use], until)
        place = found[0] * COORDINATES + found[1]
        order = np.argsort((place << 36) | (found[2] / until[found[0]] * (1 << 35)).astype(np.int64))  # place, then time
        place, dart = place[order], found[3][order]
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1]
        place, dart = place[first], dart[first]
        full = np.bincount(place // COORDINATES, minlength=n_docs) == COORDINATES
        done = full[place // COORDINATES]
        out.ravel()[place[done]] = dart[done]
        todo = todo[~full[todo]]
        until[todo] *= 2
    return out


def _throw(doc, element, weight, until):
    """All darts (text, coordinate, time, id) below the elements' weights, up to each text's time."""
    cells = np.floor(np.log2(weight + 1e-9 if weight.dtype.kind == "f" else weight)).astype(np.int64) + 1
    cells = np.maximum(cells, 1)  # cell c covers weights from 2**c - 1 to 2**(c+1) - 1
    cell = B_steps(cells)
    doc, element, weight = (np.repeat(v, cells) for v in (doc, element, weight))
    width = 2.0**cell
    key = mix(element ^ mix(cell.astype(np.uint64) + _SEEDS[0]))
    time, limit, turn, caught = np.zeros(len(doc)), until[doc], 0, []
    while len(doc):
        turn += 1
        dart = mix(key + np.uint64(turn * int(_STEP) & (1 << 64) - 1))
        time = time - np.log(_unit(dart)) / width
        live = time <= limit
        if not live.all():
            doc, weight, cell, width, key, time, limit, dart = (
                v[live] for v in (doc, weight, cell, width, key, time, limit, dart)
            )
        below = width - 1 + width * _unit(mix(dart ^ _SEEDS[1])) < weight
        coordinate = (mix(dart ^ _SEEDS[2]) % np.uint64(COORDINATES)).astype(np.int64)
        caught.append((doc[below], coordinate[below], time[below], dart[below]))
    return tuple(np.concatenate(v) for v in zip(*caught))


def B_steps(many: np.ndarray) -> np.ndarray:
    """0 .. many[0]-1, 0 .. many[1]-1, ..."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _digests(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each text's word sequence."""
    _, _, first, hash_ = t.word_hashes()
    one = spans(prefix(hash_, WORD_BASE), first[:-1], first[1:], WORD_BASE)
    two = spans(prefix(mix(hash_ ^ _SEEDS[0]), WORD_BASE), first[:-1], first[1:], WORD_BASE)
    return one.view(np.int64), two.view(np.int64)


def _describe(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for t in texts_of(part["text"]):
            doc, element, weight, n = shingles(t)
            sign = signatures(doc, element, weight, len(t))
            bands = mix(sign[:, ::ROWS])
            for r in range(1, ROWS):
                bands = mix(bands * _STEP + sign[:, r::ROWS])
            one, two = _digests(t)
            flat = pa.array(bands.view(np.int64).ravel())
            yield pa.record_batch({
                **{c: part[c].slice(t.first, len(t)) for c in ("uid", "key", "print")},
                "d1": pa.array(one), "d2": pa.array(two), "n_words": pa.array(n.astype(np.int64)),
                "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(t) + 1, dtype=np.int32) * BANDS), flat),
            })


def _sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle set of each wanted text, occurrences of a shingle told apart."""
    for part in parts:
        want1, want2 = part["d1"].to_numpy(), part["d2"].to_numpy()
        for t in texts_of(part["text"]):
            one, two = _digests(t)
            mine = (one == want1[t.first : t.first + len(t)]) & (two == want2[t.first : t.first + len(t)])
            doc, element, weight, _ = shingles(t)
            each = mix(np.repeat(element, weight) + B_steps(weight).astype(np.uint64) * _STEP)
            doc = np.repeat(doc, weight)
            order = by_text(doc, each, len(t))
            each = each[order].tobytes()
            cut = np.searchsorted(doc[order], np.arange(len(t) + 1)) * 8
            rows = np.flatnonzero(mine)
            yield pa.record_batch({
                "uid": part["uid"].take(pa.array(t.first + rows)),
                "items": pa.array([each[cut[i] : cut[i + 1]] for i in rows], pa.binary()),
            })


def _verified(threshold: float):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ok = []
            for x, y in zip(part["x"], part["y"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if min(len(x), len(y)) < threshold * max(len(x), len(y)):
                    ok.append(False)
                    continue
                both = B.among(x, y).sum()
                ok.append(bool(both >= threshold * (len(x) + len(y) - both) - 1e-9))
            yield part.select(["a", "b"]).append_column("ok", pa.array(ok, pa.bool_()))
    return work


def _crossed(threshold: float):
    """Links that join all texts of two blocks (or of one with itself) which are linked, at most one per text.

    Every pair is compared, except those that the links found so far have in one class.
    """
    def work(part: pa.Table) -> pa.Table:
        uid, root, block = (part[c].to_numpy() for c in ("uid", "root", "block"))
        items = [np.frombuffer(v.as_buffer(), np.uint64) for v in part["items"]]
        size = np.array([len(v) for v in items])
        label = np.unique(root, return_inverse=True)[1]
        left, right = (np.flatnonzero(block == part[c][0].as_py()) for c in ("one", "two"))
        held = np.concatenate([items[j] for j in right]) if len(right) else np.zeros(0, np.uint64)
        order = np.argsort(held, kind="stable")
        owner = np.repeat(right, size[right])[order]
        known, start = np.unique(held[order], return_index=True)
        many = np.diff(np.append(start, len(held)))
        links = []
        for i in left:
            other = right[label[right] != label[i]]
            other = other[np.minimum(size[other], size[i]) >= threshold * np.maximum(size[other], size[i]) - 1e-9]
            if not len(other):
                continue
            at = np.searchsorted(known, items[i][B.among(items[i], known)])
            steps = np.repeat(start[at], many[at]) + B_steps(many[at])
            both = np.bincount(owner[steps], minlength=len(uid))[other]
            other = other[both >= threshold * (size[i] + size[other] - both) - 1e-9]
            met, first = np.unique(label[other], return_index=True)
            links += [(uid[i], uid[j]) for j in other[first]]
            label[np.isin(label, met)] = label[i]
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return work


def _alike_in_size(one: str, two: str, threshold: float) -> Column:
    """False only where the numbers of words alone keep a pair below the threshold (a text has four shingles less than words)."""
    low, high = F.least(one, two), F.greatest(one, two)
    return (low < 5) | (low >= threshold * high)


def _by_pairs(member: DataFrame, sets: DataFrame, tested: DataFrame | None, threshold: float) -> DataFrame:
    """(a, b, ok) for all pairs of different classes in small buckets that have not been tested."""
    mine = member.filter(F.col("n") <= SMALL).select("band", "value", "uid", "root", "n_words")
    other = mine.select("band", "value", F.col("uid").alias("b"), F.col("root").alias("to"), F.col("n_words").alias("m_words"))
    pairs = mine.join(other, ["band", "value"]).filter("uid < b AND root <> to").filter(_alike_in_size("n_words", "m_words", threshold)).select(F.col("uid").alias("a"), "b").distinct()
    return _tested(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), sets, threshold)


def _by_blocks(member: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between different classes in buckets that are not small.

    The largest class of a bucket and its other members are cut into blocks of their own, and only
    blocks of the largest class do not meet each other.
    """
    large = member.filter(F.col("n") > SMALL)
    classes = large.groupBy("band", "value", "root").agg(F.count("*").alias("m"), F.sum("n_words").alias("w"))
    cuts = classes.groupBy("band", "value").agg(
        F.max(F.struct("m", "w", "root")).alias("main"), F.sum("m").alias("m"), F.sum("w").alias("w"), F.count("*").alias("classes"),
    ).filter("classes > 1")  # else one class already
    parts = lambda m, w: F.greatest(F.ceil(m / BLOCK), F.ceil(w / BLOCK_WORDS))
    cuts = cuts.select(
        "band", "value", F.col("main.root").alias("main"), (parts(F.col("m"), F.col("w")) == 1).alias("whole"),
        parts(F.col("main.m"), F.col("main.w")).alias("mains"),
        parts(F.col("m") - F.col("main.m"), F.col("w") - F.col("main.w")).alias("rests"))
    zero, mains, last = F.lit(0).cast("long"), F.col("mains"), F.col("mains") + F.col("rests") - 1
    main, spot = F.col("root") == F.col("main"), F.xxhash64("uid")
    placed = large.join(cuts, ["band", "value"]).select(
        "band", "value", "uid", "root",
        F.when(F.col("whole"), zero).when(main, F.pmod(spot, mains)).otherwise(mains + F.pmod(spot, F.col("rests"))).alias("block"),
        F.explode(F.when(F.col("whole"), F.array(zero)).when(main, F.sequence(mains, last)).otherwise(F.sequence(zero, last))).alias("meets"))
    placed = placed.select(
        "band", "value", "uid", "root", "block", F.least("block", "meets").alias("one"), F.greatest("block", "meets").alias("two"))
    return placed.join(sets, "uid").groupBy("band", "value", "one", "two").applyInArrow(_crossed(threshold), "a long, b long")


def _tested(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, ok) for pairs of texts, on whole shingle sets."""
    pairs = stage(pairs, "pairs")
    of = sets.join(pairs.select(F.col("a").alias("uid")).union(pairs.select("b")).distinct(), "uid", "left_semi")
    both = pairs.join(of.select(F.col("uid").alias("a"), F.col("items").alias("x")), "a")
    both = both.join(of.select(F.col("uid").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")
    return stage(both.mapInArrow(tidy(_verified(threshold)), "a long, b long, ok boolean"), "checked")


def _pivots(member: DataFrame, turn: int) -> DataFrame:
    """The members of all buckets that are pivots of round ``turn``, each in one round at most.

    The first round takes the bucket's ``head``; the others take about ``PIVOTS`` by a number that stands for
    the rank in one hash order.  The band is not in the hash: buckets of different bands that
    hold the same texts then ask for the same pairs, which are tested once.
    """
    rank = F.shiftrightunsigned(F.xxhash64("uid"), 11) * F.lit(2.0**-53) * F.col("n")
    if not turn:
        return member.filter("uid = head")
    return member.filter((F.col("uid") != F.col("head")) & (rank >= (turn - 1) * PIVOTS) & (rank < turn * PIVOTS))


def _classes(bucket: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(id, root) of the texts that are linked with a text of one of their buckets."""
    tested = links = None
    member = bucket.withColumn("root", F.col("uid"))
    for turn in range(ROUNDS):
        use = member.filter(F.col("n") > BLOCK) if turn else member
        pivot = _pivots(use, turn).select("band", "value", F.struct("uid", "root", "n_words").alias("p"))
        fits = _alike_in_size("n_words", "p.n_words", threshold)  # before any set is moved
        pairs = use.join(pivot, ["band", "value"]).filter("root <> p.root").filter(fits).select(
            F.least("p.uid", "uid").alias("a"), F.greatest("p.uid", "uid").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        checked = _tested(pairs, sets, threshold)
        number, good = checked.agg(F.count("*"), F.count_if("ok")).first()
        if number:
            tested = checked.select("a", "b") if tested is None else tested.union(checked.select("a", "b"))
        if good:
            found = checked.filter("ok").select("a", "b")
            links = found if links is None else links.union(found)
            member = _rooted(bucket, components(links))
        if good <= PAYING * number:
            break
    rest = _by_pairs(member, sets, tested, threshold).filter("ok").select("a", "b").union(
        stage(_by_blocks(member, sets, threshold), "links"))
    return components(rest if links is None else links.union(rest))


def _rooted(bucket: DataFrame, classes: DataFrame) -> DataFrame:
    named = classes.withColumnRenamed("id", "uid")
    return stage(bucket.join(named, "uid", "left").withColumn("root", F.coalesce("root", "uid")), "members")


def _may_be(known):
    """Whether a number may be in a broadcast bitmap; only the numbers go to Python."""
    @F.pandas_udf("boolean")
    def test(spot: pd.Series) -> pd.Series:
        found = np.zeros(len(spot), bool)
        found[known.value.among(spot.to_numpy())] = True
        return pd.Series(found)
    return test


def _texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(uid, d1, d2, text) of the wanted rows, met by id and print, so that rows of one id (or none) do not all meet.

    A bitmap of what is wanted (16 MB at most) keeps the other texts from being moved; it never loses one,
    and the join removes what it lets through.  The join is by shuffle at any size: with a broadcast a task would test
    texts and make their sets at once and hold two Python workers.
    """
    spot = F.xxhash64("key", "print")
    known = rows.sparkSession.sparkContext.broadcast(bitmap_of(wanted.select(spot.alias("key")).distinct()))
    rows = rows.select("key", "print", "text").filter(_may_be(known)(spot))
    named = wanted.select(F.col("key").alias("want"), F.col("print").alias("mark"), "uid", "d1", "d2")
    same = F.col("key").eqNullSafe(F.col("want")) & (F.col("print") == F.col("mark"))
    return rows.join(named.hint("merge"), same).select("uid", "d1", "d2", "text")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY,
    with_print: bool = False,
) -> DataFrame:
    """One row per document: id, ``class_id`` (smallest id of its class), ``class_size``, ``kept``.

    Two texts are linked when the weighted Jaccard similarity of their five-word shingles is
    ``similarity`` or more; a class is a connected set.  One row of each class is kept: the one
    with the smallest id, nulls last, and one of them if the id is repeated.

    Texts without a word (null, empty, only spaces) link with nothing and are kept.  Repeated rows
    are copies of each other.  A null id stays null and is never a class id unless all ids of the
    class are null.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).cast("long").alias("key"),
        F.col(text_column).cast("string").cast("binary").alias("text"), print_of(text_column).alias("print"),
    )
    told = stage(rows.mapInArrow(
        tidy(_describe), "uid long, key long, print long, d1 long, d2 long, n_words long, bands array<long>"), "signatures")
    lowest = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "uid"))
    copies = stage(told.filter("n_words > 0").groupBy("d1", "d2").agg(
        lowest.alias("low"), F.count("*").alias("copies"),
    ).select("d1", "d2", "low.key", "low.uid", "copies"), "copies")
    single = told.join(copies.select("uid"), "uid", "left_semi")
    banded = single.select("uid", "n_words", F.posexplode("bands").alias("band", "value"))
    crowded = banded.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("uid").alias("head")).filter("n > 1")
    bucket = stage(banded.join(crowded, ["band", "value"]), "buckets")
    classes = None
    if not bucket.isEmpty():
        wanted = stage(single.join(bucket.select("uid").distinct(), "uid", "left_semi").select("uid", "key", "print", "d1", "d2"), "wanted")
        sets = stage(
            _texts_of(rows, wanted).mapInArrow(tidy(_sets), "uid long, items binary").dropDuplicates(["uid"]), "sets")
        classes = _classes(bucket, sets, similarity)
    if classes is None:
        classes = spark.createDataFrame([], "id long, root long")
    grouped = copies.join(classes.withColumnRenamed("id", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    heads = grouped.groupBy("root").agg(lowest.alias("low"), F.sum("copies").alias("class_size"))
    named = stage(grouped.join(heads, "root").select(
        "d1", "d2", F.col("low.key").alias("class_id"), F.col("low.uid").alias("head"), "class_size"), "classes")
    return told.drop("bands").join(named, ["d1", "d2"], "left").select(
        F.col("key").alias(id_column),
        F.when(F.col("head").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        (F.coalesce("head", "uid") == F.col("uid")).alias("kept"),
        "n_words", *["print"] * with_print,
    )


def print_of(text_column: str) -> Column:
    """Tells rows of one id but other texts apart."""
    return F.xxhash64(F.col(text_column).cast("string"))


def keep_one(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`near_duplicates` keeps: one of each class."""
    found = near_duplicates(docs, id_column, text_column, similarity, with_print=True).filter("kept")
    found = found.select(F.col(id_column).alias("dart_id"), F.col("print").alias("dart_print"))
    key, mark = F.col(id_column).cast("long"), print_of(text_column)
    rows = docs.select(*docs.columns, key.alias("dart_key"), mark.alias("dart_mark"))
    met = rows.join(found, F.col("dart_key").eqNullSafe(F.col("dart_id")) & (F.col("dart_mark") == F.col("dart_print")), "left_semi")
    # Repeated rows agree in both: the first by a digest of all columns stays.  Texts without a word are classes of their own.
    wordless = F.length(F.translate(F.coalesce(F.col(text_column).cast("string"), F.lit("")), " \t\n\x0b\f\r", "")) == 0
    turn = F.row_number().over(Window.partitionBy("dart_key", "dart_mark").orderBy(F.xxhash64(*docs.columns), *docs.columns))
    first = met.filter(~wordless).withColumn("dart_turn", turn).filter("dart_turn = 1").select(*docs.columns)
    return first.unionByName(docs.filter(wordless))
