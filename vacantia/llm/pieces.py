"""SentencePiece encoding and decoding by suffix-array matching.

Segments of a batch (a word with the space marks before it) that are new to the worker are put into
one text with a suffix array.  Every piece of the vocabulary finds its range of occurrences there by
binary search; the occurrences, sorted by position, are the edges over which the segments are relaxed:
the edge with the best score that joins two neighbouring tokens is taken until none is left, as
byte-pair models ask.  Characters without a piece fall back to bytes.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vacantia.llm.dart import B_steps as steps
from vacantia.llm.tokens import text_runs

MARK = "▁"
CACHE_SEGMENTS = 1 << 19
BATCH_CHARS = 1 << 21
ROW_CHARS = 48  # longer segments are relaxed one by one


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def character_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` sorted by the ``depth`` characters from there on; the end sorts first."""
    n = len(text)
    shifted = [np.concatenate([text[j:] + 1, np.zeros(min(j, n), np.int64)]) for j in range(3)]
    key, h = (shifted[0] << 42) | (shifted[1] << 21) | shifted[2], 3
    while True:
        order = np.argsort(key)
        new = np.ones(n, bool)
        new[1:] = key[order][1:] != key[order][:-1]
        if h >= depth or new.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        key = rank * (n + 2) + np.concatenate([rank[h:], np.zeros(min(h, n), np.int64)])
        h *= 2


def occurrence_ranges(text: np.ndarray, order: np.ndarray, pieces: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of ``order`` whose suffixes begin with each piece; the range narrows one character at a time."""
    n = len(text)
    low, high = np.zeros(len(pieces), np.int64), np.full(len(pieces), n)
    for depth in range(pieces.shape[1]):
        use = np.flatnonzero((size > depth) & (low < high))
        if not len(use):
            break
        wanted = pieces[use, depth]
        for right in (False, True):
            a, b = low[use].copy(), high[use].copy()
            while True:
                open_ = a < b
                if not open_.any():
                    break
                mid = (a + b) // 2
                place = order[np.minimum(mid, n - 1)] + depth
                there = np.where(place < n, text[np.minimum(place, n - 1)], -1)
                up = open_ & ((there <= wanted) if right else (there < wanted))
                a = np.where(up, mid + 1, a)
                b = np.where(open_ & ~up, mid, b)
            if right:
                high[use] = a
            else:
                first = a
        low[use] = first
    return low, high


class Pieces:
    """A byte-pair SentencePiece model with byte fallback and no text normalisation but space marks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        text = [model.id_to_piece(i) for i in plain]
        self.id = np.array(plain, np.int64)
        self.score = np.array([model.get_score(i) for i in plain], np.float32)
        self.size = np.array([len(t) for t in text], np.int64)
        self.longest = int(self.size.max())
        self.table = np.full((len(text), self.longest), -1, np.int64)
        for i, t in enumerate(text):
            self.table[i, : len(t)] = codes(t)
        byte = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        self.byte_id = np.array([byte[b] for b in range(256)], np.int64)
        out = {i: t.replace(MARK, " ").encode() for i, t in zip(plain, text)} | {i: bytes([b]) for b, i in byte.items()}
        spelled = [out.get(i, b"") for i in ids]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_size = np.array([len(s) for s in spelled], np.int64)
        self.spelled_first = np.cumsum(self.spelled_size) - self.spelled_size
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.first, self.many = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the piece from each position on with each length."""
        order = character_suffixes(text, self.longest)
        low, high = occurrence_ranges(text, order, self.table, self.size)
        many = high - low
        piece = np.repeat(np.arange(len(low)), many)
        place = order[np.repeat(low, many) + steps(many)]
        by_place = np.argsort(place)
        piece, place = piece[by_place], place[by_place]
        score = np.full((len(text), self.longest + 1), -np.inf, np.float32)
        name = np.full((len(text), self.longest + 1), -1, np.int32)
        score[place, self.size[piece]], name[place, self.size[piece]] = self.score[piece], self.id[piece]
        return score, name

    def _relax_rows(self, score: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ends of segments of one batch, all of them one step at a time."""
        width = int(size.max())
        row = np.arange(len(start))
        ends = np.minimum(np.arange(1, width + 1), size[:, None])  # end of token j in its segment

        def pair(r: np.ndarray, j: np.ndarray) -> np.ndarray:
            """Score of joining tokens j and j + 1."""
            out = np.full(len(r), -np.inf, np.float32)
            ok = (j >= 0) & (j + 1 < width)
            ok[ok] = ends[r[ok], j[ok]] < size[r[ok]]
            r, j = r[ok], j[ok]
            begin = np.where(j > 0, ends[r, np.maximum(j - 1, 0)], 0)
            length = ends[r, j + 1] - begin
            fits = length <= self.longest
            found = np.full(len(r), -np.inf, np.float32)
            found[fits] = score[start[r[fits]] + begin[fits], length[fits]]
            out[ok] = found
            return out

        best = np.stack([pair(row, np.full(len(row), j)) for j in range(width)], axis=1)
        live = row
        while len(live):
            j = best[live].argmax(axis=1)
            can = best[live, j] > -np.inf
            live, j = live[can], j[can]
            if not len(live):
                break
            shift = np.minimum(np.arange(width) + (np.arange(width) >= j[:, None]), width - 1)
            ends[live] = np.take_along_axis(ends[live], shift, axis=1)
            moved = np.minimum(np.arange(width) + (np.arange(width) > j[:, None]), width - 1)
            best[live] = np.take_along_axis(best[live], moved, axis=1)
            best[live, width - 1] = -np.inf
            best[live, j] = pair(live, j)
            left = j > 0
            best[live[left], j[left] - 1] = pair(live[left], j[left] - 1)
        first = np.concatenate([np.zeros((len(row), 1), np.int64), ends[:, :-1]], axis=1)
        real = first < ends
        return (start[:, None] + first)[real], (ends - first)[real]

    def _relax_one(self, score: np.ndarray, start: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long segment, with a queue of the joins that are possible."""
        after, before = list(range(1, size + 2)), list(range(-1, size))
        alive = [True] * size + [False]
        queue: list = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < size:
                length = after[j] - i
                if length <= self.longest and score[start + i, length] > -np.inf:
                    heapq.heappush(queue, (-float(score[start + i, length]), i, j, after[j]))

        for i in range(size - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, end = heapq.heappop(queue)
            if not (alive[i] and alive[j] and after[i] == j and after[j] == end):
                continue
            alive[j] = False
            after[i] = end
            if end < size:
                before[end] = i
                offer(i, end)
            offer(before[i], i)
        place = np.flatnonzero(alive[:size])
        return start + place, np.array([after[i] for i in place]) - place

    def _learn(self, fresh: list[str]) -> None:
        text = codes("".join(fresh))
        size = np.array([len(s) for s in fresh], np.int64)
        start = np.cumsum(size) - size
        score, name = self.edges(text)
        places, lengths = [], []
        short = np.flatnonzero(size <= ROW_CHARS)
        for low, high in ((0, 8), (8, 16), (16, ROW_CHARS)):
            use = short[(size[short] > low) & (size[short] <= high)]
            if len(use):
                place, length = self._relax_rows(score, start[use], size[use])
                places.append(place)
                lengths.append(length)
        for i in np.flatnonzero(size > ROW_CHARS):
            place, length = self._relax_one(score, int(start[i]), int(size[i]))
            places.append(place)
            lengths.append(length)
        place, length = np.concatenate(places), np.concatenate(lengths)
        order = np.argsort(place)
        place, length = place[order], length[order]
        ids = name[place, length].astype(np.int64)
        lost = np.flatnonzero(ids < 0)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in text[place[lost]].tolist()]
        many = np.ones(len(ids), np.int64)
        many[lost] = [len(b) for b in raw]
        flat = np.repeat(ids, many)
        flat[np.repeat(ids < 0, many)] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        at = np.concatenate([[0], np.cumsum(many)])[np.searchsorted(place, np.append(start, len(text)))]
        self.first = np.concatenate([self.first, len(self.flat) + at[:-1]])
        self.many = np.concatenate([self.many, np.diff(at)])
        self.flat = np.concatenate([self.flat, flat.astype(np.uint32)])

    @staticmethod
    def segments(text: str) -> list[str]:
        """The text with its space marks, cut before every run of marks."""
        out, marks = [], 1  # one mark is put before the text
        for word in text.replace(MARK, " ").split(" "):
            if word:
                out.append(MARK * marks + word)
                marks = 1
            else:
                marks += 1
        if marks > 1:
            out.append(MARK * (marks - 1))
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has; null counts as empty."""
        if len(self.known) > CACHE_SEGMENTS:
            self._clear()
        found, number, fresh, known = [], np.zeros(len(texts), np.int64), [], self.known
        for i, text in enumerate(texts):
            if text:
                own = self.segments(text)
                number[i] = len(own)
                for segment in own:
                    k = known.get(segment)
                    if k is None:
                        k = known[segment] = len(known)
                        fresh.append(segment)
                    found.append(k)
        if fresh:
            self._learn(fresh)
        found = np.array(found, np.int64)
        many = self.many[found]
        ids = self.flat[np.repeat(self.first[found], many) + steps(many)]
        cut = np.concatenate([[0], np.cumsum(many)])[np.concatenate([[0], np.cumsum(number)])]
        return ids, np.diff(cut)

    def decode(self, ids: np.ndarray, many: np.ndarray) -> list[bytes]:
        """UTF-8 text of each run of ``many`` ids, without the mark that encoding put before it."""
        size = self.spelled_size[ids]
        raw = self.spelled[np.repeat(self.spelled_first[ids], size) + steps(size)].tobytes()
        cut = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(many)])]
        return [raw[a + (raw[a : a + 1] == b" ") : b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


@lru_cache(maxsize=2)
def model(path: str) -> Pieces:
    """One per Python worker and file."""
    return Pieces(path)


def _encode(path: str, with_ids: bool):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part["text"].to_pylist()
            for a, b in text_runs(texts, BATCH_CHARS):
                ids, many = model(path).encode(texts[a:b])
                raw = memoryview(ids.astype("<u4").tobytes())
                cut = (4 * np.concatenate([[0], np.cumsum(many)])).tolist()
                back = model(path).decode(ids, many)
                out = {
                    "id": part["id"].slice(a, b - a), "n_pieces": pa.array(many),
                    "ids_crc32": pa.array([zlib.crc32(raw[x:y]) for x, y in zip(cut, cut[1:])], pa.int64()),
                    "round_trip": pa.array([x == (t or "").replace(MARK, " ").encode("utf-8", "surrogatepass") for x, t in zip(back, texts[a:b])]),
                }
                if with_ids:
                    out["pieces"] = pa.ListArray.from_arrays(pa.array(np.array(cut, np.int32) // 4), pa.array(ids.astype(np.int64)))
                yield pa.record_batch(out)
    return work


def encode_pieces(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Per row: id, ``n_pieces``, ``ids_crc32`` (little-endian unsigned 32-bit), ``round_trip``, and ``pieces`` if asked.

    ``round_trip`` says that decoding gives the text back, a literal mark read as a space.  Null and empty
    texts have no pieces.  Null ids and repeated rows are kept; other columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = f"id {rows.dtypes[0][1]}, n_pieces long, ids_crc32 long, round_trip boolean" + ", pieces array<long>" * with_ids
    return rows.mapInArrow(_encode(path, with_ids), schema).withColumnRenamed("id", id_column)


def decode_pieces(encoded: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "pieces") -> DataFrame:
    """Per row: id and ``text``; null ids of pieces give null text."""
    rows = encoded.select(F.col(id_column).alias("id"), F.col(ids_column).cast("array<long>").alias("pieces"))

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part["pieces"].to_pylist()
            ids = np.array([i for x in lists for i in x or ()], np.int64)
            back = model(path).decode(ids, np.array([len(x or ()) for x in lists], np.int64))
            text = [None if x is None else b.decode("utf-8", "replace") for x, b in zip(lists, back)]
            yield pa.record_batch({"id": part["id"], "text": pa.array(text, pa.string())})

    return rows.mapInArrow(work, f"id {rows.dtypes[0][1]}, text string").withColumnRenamed("id", id_column)
