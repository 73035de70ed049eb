"""Token ids of whole texts, and a column file format of bit planes.

A chunk is a run of at most ``CHUNK_IDS`` ids of one ascending part of the documents.  Its ids are
transposed into bit planes (or byte planes); every plane is compressed with zstandard.  A chunk
index holds where each chunk begins in the whole sequence and the documents it
touches.  Chunks and index are Parquet tables, so any store that Spark writes will do and a lost
executor's attempt leaves nothing behind.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vacantia.llm import blocks as B
from vacantia.llm.dart import B_steps as steps
from vacantia.llm.workers import tidy
from vacantia.session import stage

CHUNK_IDS = 1 << 16
CACHE_WORDS = 1 << 18
CACHE_CHARS = 1 << 23
END_ID = 1
JOINED = 256  # pieces of one call of the library
# Below U+0130 characters are composed and their small letters are single and undisputed.
PLAIN = "".join(c for c in map(chr, range(0x130)) if c.isprintable() or c == "\n")
ODD = re.compile(f"[^{re.escape(PLAIN)}]|<[|]")
PLAIN_BYTES = PLAIN.encode("latin-1", "ignore")


def piece_pattern(path: str) -> regex.Pattern | None:
    """The pattern by which a tokenizer file cuts texts into pieces that are encoded one by one; None for files of other kinds.

    Known are files that compose, lower and merge spaces, keep the matches of one pattern that never holds a
    space, map bytes, and mark the last token of a piece.
    """
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    steps_ = (kind.get("normalizer") or {}).get("normalizers") or []
    cuts = (kind.get("pre_tokenizer") or {}).get("pretokenizers") or []
    normal = [s.get("type") for s in steps_] == ["NFC", "Replace", "Lowercase"] and steps_[1].get("content") == " "
    if not (kind.get("model") or {}).get("end_of_word_suffix"):
        return None
    if not normal or [c.get("type") for c in cuts] != ["Split", "ByteLevel"]:
        return None
    split, bytes_ = cuts
    kept = split.get("behavior") == "Removed" and split.get("invert") is True
    pattern = split.get("pattern", {}).get("Regex")
    if not kept or bytes_.get("add_prefix_space") or bytes_.get("use_regex") or not pattern:
        return None
    spaceless = not regex.search(pattern, " ") and " " not in "".join(regex.findall(pattern, "a b 1 2 . , 's  'd"))
    return regex.compile(pattern) if spaceless else None


def plain_pattern(pattern: regex.Pattern) -> Callable[[str], list[str]]:
    """``pattern.findall`` for plain texts: classes of letters, digits and other characters as lists, which are searched faster."""
    text = pattern.pattern
    for kind in (r"[^\s\p{L}\p{N}]", r"[\p{L}]", r"[\p{N}]"):
        text = text.replace(kind, "[" + re.escape("".join(c for c in PLAIN if regex.fullmatch(kind, c))) + "]")
    return pattern.findall if r"\p{" in text or r"\s" in text else re.compile(text).findall


class Encoder:
    """Encodes texts piece by piece where the tokenizer file cuts at spaces; else whole texts.

    Stretches of plain characters are cut by the file's own pattern and their pieces numbered; the library sees each new
    piece once, and every word with another character or a special token as a whole.  A store that is full forgets
    all but the pieces seen most, which changes no result.
    """

    class _Numbers(dict):
        def __missing__(self, piece):
            number = self[piece] = len(self)
            self.fresh.append(piece)
            return number

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        pattern = piece_pattern(path)
        self.cut = pattern and plain_pattern(pattern)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that end a piece
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        for token, number in vocabulary.items():
            self.last[number] = bool(suffix) and token.endswith(suffix)
        self._clear()

    def _clear(self) -> None:
        self.number, self.chars = self._Numbers(), 0
        self.number.fresh = []
        self.first, self.many = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self.seen = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Empty the store but for the pieces that were seen most, at most half of what it holds."""
        pieces = list(self.number)
        often = np.flatnonzero(self.seen > 1)
        keep = np.sort(often[np.argsort(-self.seen[often], kind="stable")[: CACHE_WORDS // 2]])
        if sum(len(pieces[i]) for i in keep.tolist()) > CACHE_CHARS // 2:
            keep = keep[:0]
        first, many, flat, seen = self.first[keep], self.many[keep], self.flat, self.seen[keep]
        self._clear()
        self.number.update((pieces[i], n) for n, i in enumerate(keep.tolist()))
        self.chars = sum(map(len, self.number))
        self.flat = flat[np.repeat(first, many) + steps(many)]
        self.first, self.many, self.seen = np.cumsum(many) - many, many, seen // 2

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces_of(self, text: str) -> list[str]:
        """The pieces of a text in order; an unusual word is one entry that begins with a space."""
        try:  # a quick look at the whole text
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            raw = b"<|"
        if b"<|" not in raw and not raw.translate(None, PLAIN_BYTES):
            return self.cut(text.lower())
        odd = ODD.search(text)
        text = text.replace("\n", " ")
        out, at = [], 0
        while odd:
            begin = max(at, text.rfind(" ", at, odd.start()) + 1)
            end = text.find(" ", odd.end())
            end = len(text) if end < 0 else end
            out += self.cut(text[at:begin].lower())
            out.append(" " + text[begin:end])
            at, odd = end, ODD.search(text, end)
        return out + self.cut(text[at:].lower())

    def _learn(self, fresh: list[str]) -> None:
        """Add the ids of new pieces, many at a time: joined by spaces each stays a piece of its own."""
        plain = np.array([piece[0] != " " for piece in fresh])
        news = [piece for piece in fresh if piece[0] != " "]
        runs = [news[i : i + JOINED] for i in range(0, len(news), JOINED)]
        ids = np.array([x for own in self._library([" ".join(r) for r in runs]) for x in own], np.uint32)
        end = np.flatnonzero(self.last[ids]) + 1
        if len(end) != len(news):
            raise ValueError("the tokenizer does not end every piece with its mark")
        odd = self._library([piece[1:] for piece in fresh if piece[0] == " "])
        many, first = np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64)
        many[plain] = np.diff(end, prepend=0)
        first[plain] = len(self.flat) + end - many[plain]
        many[~plain] = sizes = np.fromiter(map(len, odd), np.int64, len(odd))
        first[~plain] = len(self.flat) + len(ids) + np.cumsum(sizes) - sizes
        self.first, self.many = np.concatenate([self.first, first]), np.concatenate([self.many, many])
        self.flat = np.concatenate([self.flat, ids, np.array([x for own in odd for x in own], np.uint32)])
        self.chars += sum(map(len, fresh))

    def encode(self, texts: list[str | None], end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has; null counts as empty."""
        if self.cut is None:
            ids_ = self._library([t or "" for t in texts])
            many = np.fromiter(map(len, ids_), np.int64, len(ids_))
            ids = np.fromiter((x for e in ids_ for x in e), np.uint32, int(many.sum()))
            cut = np.concatenate([[0], np.cumsum(many)])
            return (ids, many) if end_id is None else (np.insert(ids, cut[1:], end_id), many + 1)
        if len(self.number) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self._forget()
        found, pieces = [], np.zeros(len(texts), np.int64)
        look = self.number.__getitem__
        for i, text in enumerate(texts):
            if text:
                own = self._pieces_of(text)
                pieces[i] = len(own)
                found.append(np.fromiter(map(look, own), np.int64, len(own)))
        if self.number.fresh:
            self._learn(self.number.fresh)
            self.number.fresh.clear()
        found = np.concatenate(found) if found else np.zeros(0, np.int64)
        self.seen = np.bincount(found, minlength=len(self.number)) + np.pad(self.seen, (0, len(self.number) - len(self.seen)))
        many = self.many[found]
        ids = self.flat[np.repeat(self.first[found], many) + steps(many)]
        cut = np.concatenate([[0], np.cumsum(many)])[np.concatenate([[0], np.cumsum(pieces)])]
        if end_id is None:
            return ids, np.diff(cut)
        return np.insert(ids, cut[1:], end_id), np.diff(cut) + 1


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker and file."""
    return Encoder(path)


def text_runs(texts: list[str | None], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def column_runs(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, list[str | None]]]:
    """Ranges of a text column of about ``limit`` bytes with their texts, so that a batch is never one list of Python texts."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(column):
        before = int(ends[first - 1]) if first else 0
        end = min(len(column), int(np.searchsorted(ends, before + limit, "right")) + 1)
        yield first, end, column.slice(first, end - first).to_pylist()
        first = end


# --- Planes -------------------------------------------------------------------------------


def to_planes(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first, each compressed; leading zero planes are left out."""
    press = zstandard.ZstdCompressor(level=3).compress
    top = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        table = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        return [press(table[i].tobytes()) for i in range(-(-top // 8))]
    return [press(np.packbits((ids >> np.uint32(i)).astype(np.uint8) & 1, bitorder="little").tobytes()) for i in range(top)]


def from_planes(planes: list[bytes], n: int, kind: str = "bit") -> np.ndarray:
    """The ids that :func:`to_planes` was given."""
    ids = np.zeros(n, np.uint32)
    open_ = zstandard.ZstdDecompressor().decompress
    for i, plane in enumerate(planes):
        raw = np.frombuffer(open_(plane), np.uint8)
        if kind == "byte":
            ids |= raw.astype(np.uint32) << np.uint32(8 * i)
        else:
            ids |= np.unpackbits(raw, count=n, bitorder="little").astype(np.uint32) << np.uint32(i)
    return ids


_CHUNK = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("kind", pa.string()),
    ("planes", pa.list_(pa.binary())), ("docs", pa.list_(pa.int64())), ("doc_first", pa.list_(pa.int64())),
    ("doc_ids", pa.list_(pa.int64())),
])
_CHUNK_SQL = (
    "part int, chunk long, first long, n_ids long, kind string, planes array<binary>, docs array<long>, "
    "doc_first array<long>, doc_ids array<long>"
)


def _write(path: str, end_id: int, size: int, kind: str):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        chunk, first = 0, 0  # of the ids that are held
        ids: list[np.ndarray] = []
        held, docs = 0, []  # docs: (id, first id in the part, ids)

        def cut(n: int) -> pa.RecordBatch:
            nonlocal ids, held, chunk, first, docs
            flat = np.concatenate(ids)
            row = {
                "part": part, "chunk": chunk, "first": first, "n_ids": n, "kind": kind, "planes": to_planes(flat[:n], kind),
            }
            touch = [d for d in docs if d[1] < first + n]
            row |= {k: [d[i] for d in touch] for i, k in enumerate(("docs", "doc_first", "doc_ids"))}
            ids, held, chunk, first = [flat[n:]], held - n, chunk + 1, first + n
            docs = [d for d in docs if d[1] + d[2] > first]
            return pa.RecordBatch.from_pylist([row], _CHUNK)

        for batch in parts:
            names = batch["id"].to_pylist()
            for a, b, texts in column_runs(batch["text"]):
                flat, many = encoder(path).encode(texts, end_id)
                at = first + held + np.cumsum(many) - many
                docs += zip(names[a:b], at.tolist(), many.tolist())
                ids.append(flat)
                held += len(flat)
                while held >= size:
                    yield cut(size)
        if held:
            yield cut(held)
    return work


def write_planes(
    docs: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
    end_id: int = END_ID, chunk_ids: int = CHUNK_IDS, kind: str = "bit",
) -> None:
    """Write the ids of all texts in ascending id order as ``path/chunks`` and ``path/index``.

    Null text counts as empty and has only the end id.  A null id comes first; rows of one id follow
    each other in text order.  Other columns are ignored; an empty table gives empty files.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    parts = B.block_count(docs, F.col(text_column).cast("string"))
    # A hot id (or null) is spread over partitions by its texts; rows of one id and text are equal.
    chunks = rows.repartitionByRange(parts, "id", "text").sortWithinPartitions("id", "text")
    chunks.mapInArrow(tidy(_write(tokenizer, end_id, chunk_ids, kind)), _CHUNK_SQL).write.option(
        "compression", "none").parquet(f"{path}/chunks")
    index = spark.read.schema(_CHUNK_SQL).parquet(f"{path}/chunks").select("part", "chunk", "first", "n_ids", "docs")
    base = index.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "base", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")
    index.join(base, "part").select(
        "part", "chunk", (F.col("base") + F.col("first")).alias("start"), "n_ids", F.col("docs")[0].alias("first_doc"), "base",
    ).write.parquet(f"{path}/index")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_CHUNK_SQL).parquet(f"{path}/chunks")


def _pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document that a chunk touches: the part of its ids there, as a checksum."""
    for batch in parts:
        rows = []
        for row in batch.to_pylist():
            raw = memoryview(from_planes(row["planes"], row["n_ids"], row["kind"]).astype("<u4").tobytes())
            for doc, first, n in zip(row["docs"], row["doc_first"], row["doc_ids"]):
                a, b = max(first, row["first"]), min(first + n, row["first"] + row["n_ids"])
                crc = zlib.crc32(raw[4 * (a - row["first"]) : 4 * (b - row["first"])])
                rows.append((row["part"], doc, first, n, a, b - a, crc))
        yield from B.batches(
            rows, part=pa.int32(), id=pa.int64(), first=pa.int64(), n=pa.int64(), at=pa.int64(), many=pa.int64(), crc=pa.int64())


def joined_crc(one: int, two: int, n_bytes: int) -> int:
    """The checksum of two byte strings in a row, from theirs and the length of the second."""
    zero, left, shifted, plain = b"\0" * (1 << 18), n_bytes, one, 0
    while left > 0:
        step = zero[: min(left, len(zero))]
        shifted, plain, left = zlib.crc32(step, shifted), zlib.crc32(step, plain), left - len(step)
    return two ^ shifted ^ plain


def _whole_crc(parts: pa.Table) -> pa.Table:
    """The checksum of a document that several chunks hold, from its pieces."""
    parts, crc = parts.sort_by("at"), 0
    for one, many in zip(parts["crc"].to_pylist(), parts["many"].to_pylist()):
        crc = joined_crc(crc, one, 4 * many)
    return parts.slice(0, 1).select(["part", "id", "first", "n"]).append_column("crc", pa.array([crc], pa.int64()))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, computed from the files."""
    index = spark.read.parquet(f"{path}/index").select("part", "base").distinct()
    pieces = stage(read_chunks(spark, path).mapInArrow(
        tidy(_pieces), "part int, id long, first long, n long, at long, many long, crc long"), "pieces")
    whole = pieces.filter("many = n").select("part", "id", "first", "n", "crc")
    cut = pieces.filter("many < n").groupBy("part", "first").applyInArrow(
        _whole_crc, "part int, id long, first long, n long, crc long")
    return whole.union(cut).join(index, "part").select(
        "id", (F.col("base") + F.col("first")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
