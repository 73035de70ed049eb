"""Repeated byte strings by suffix arrays.

Every 200-byte window belongs to its least run of ``SEED`` bytes, which equal windows share.  Stretches
of windows whose seed occurs once can hold no repeat and stay where they are; all other stretches go
to the shard of their seed, equal stretches once with their number.  A shard builds the suffix array of
its stretches by Larsson-Sadakane refinement, takes common prefixes of neighbours by Kasai's
method, and reports windows that occur twice or more.  A seed of very many blocks is dealt to several
sub-shards, each with a suffix array of its own; their sorted windows are merged by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vacantia.llm import blocks as B
from vacantia.llm.rolling import BASE, CODES, Texts, equal_spans, mix, prefix, texts_of, window_min
from vacantia.session import stage

LENGTH = 200
SEED = 40
BLOCKS_PER_SHARD = 64  # of one seed; more blocks are dealt to sub-shards
SHARDS_PER_BLOCK = 4  # a suffix array takes some tens of bytes per byte, so shards are smaller than blocks


# --- Suffix array -------------------------------------------------------------------------


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number, zeros beyond the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(data)]
    return out


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``data`` sorted by at least the ``depth`` bytes from there on, and where groups of equal ones begin.

    Larsson-Sadakane: the rank of a place is the start of its group; each round doubles the depth that
    is sorted by ranking the places of unsorted groups by the rank that lies one depth further on.
    """
    n = len(data)
    key = eight_bytes(data)
    order = np.argsort(key, kind="stable")
    cut = np.ones(n, bool)
    cut[1:] = key[order][1:] != key[order][:-1]
    if n:  # zero padding equals zero bytes: places near the end are told apart by their length
        short = np.flatnonzero(order > n - 8)
        cut[short] = True
        cut[np.minimum(short + 1, n - 1)] = True
    first = np.flatnonzero(cut)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    h = 8
    while h < depth:
        size = np.diff(np.append(first, n))
        group = np.flatnonzero(size > 1)
        if not len(group):
            break
        many = size[group]
        at = np.repeat(first[group], many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        place = order[at]
        further = np.where(place + h < n, rank[np.minimum(place + h, n - 1)] + 1, 0)
        which = np.repeat(np.arange(len(group)), many)
        sort = np.lexsort((further, which))
        place, further, which = place[sort], further[sort], which[sort]
        order[at] = place
        new = np.ones(len(at), bool)
        new[1:] = (which[1:] != which[:-1]) | (further[1:] != further[:-1])
        cut[at] = new
        starts = at[new]
        rank[place] = np.repeat(starts, np.diff(np.append(np.flatnonzero(new), len(at))))
        first = np.flatnonzero(cut)
        h *= 2
    return order, cut


def common_prefixes(data: np.ndarray, order: np.ndarray, cut: np.ndarray, most: int, lane: int = 256) -> np.ndarray:
    """For every rank the bytes that its suffix shares with the one before, ``most`` at the most.

    Kasai: along the text the common prefix falls by one at most per place.  The text is cut into
    lanes that walk side by side, each keeping its own count.  Places that do not begin a group share
    ``most`` bytes with the one before; since groups are not sorted further, the count starts anew behind them.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    tied = np.empty(n, bool)
    tied[order] = ~cut
    key = np.concatenate([eight_bytes(data), np.zeros(most + 8, np.uint64)])
    out = np.zeros(n, np.int64)
    starts = np.arange(0, n, lane)
    height = np.zeros(len(starts), np.int64)
    for step in range(min(lane, n)):
        place = starts[starts + step < n] + step
        height = height[: len(place)]
        other = before[place]
        limit = np.where(other < 0, 0, np.minimum(most, n - np.maximum(place, other)))
        height = np.where(tied[place], limit, np.minimum(height, limit))
        live = np.flatnonzero(height < limit)
        while len(live):
            h = height[live]
            differ = key[place[live] + h] ^ key[other[live] + h]
            same = np.full(len(live), 8)
            for k in range(8):
                same -= differ >= np.uint64(1 << (8 * k))
            height[live] = np.minimum(h + same, limit[live])
            live = live[(same == 8) & (height[live] < limit[live])]
        out[place] = height
        height = np.where(tied[place], 0, np.maximum(height - 1, 0))
    return out[order]


# --- Seeds and stretches ------------------------------------------------------------------


class Windows:
    """Least seed of every window of some texts, by the window's start."""

    def __init__(self, t: Texts, length: int):
        self.doc_end = np.repeat(t.offsets[1:], np.diff(t.offsets))
        self.sums = prefix(CODES[t.data], BASE)
        self.seeds = equal_spans(self.sums, SEED, BASE)
        n = max(0, len(t.data) - length + 1)
        self.least = window_min(self.seeds, length - SEED + 1)[:n]
        self.whole = np.arange(n) + length <= self.doc_end[:n]


def _offer_seeds(shards: int, length: int):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        reach = length - SEED
        for part in parts:
            block = part["block"].to_numpy()
            for t in texts_of(part["text"]):
                w = Windows(t, length)
                top = np.zeros(len(w.seeds) + reach, np.uint64)
                top[reach : reach + len(w.least)] = np.where(w.whole, w.least, 0)
                most = ~window_min(~top, reach + 1)[: len(w.seeds)]
                at = np.flatnonzero((w.seeds == most) & (most > 0))
                of = block[t.first + np.searchsorted(t.offsets, at, "right") - 1]
                for b in np.unique(of):
                    held.setdefault(int(b), []).append(w.seeds[at[of == b]])
        for b, found in held.items():
            yield from B.offers(B.offer(np.concatenate(found), b, shards))
    return work


_STRETCH = {
    "shard": pa.int64(), "sub": pa.int64(), "spread": pa.int64(), "block": pa.int64(), "seed": pa.int64(),
    "stretch": pa.binary(), "uids": pa.binary(), "starts": pa.binary(),
}
_STRETCH_SQL = "shard long, sub long, spread long, block long, seed long, stretch binary, uids binary, starts binary"


def _stretches(shards: int, length: int, per_shard: int):
    """Runs of windows with one recurring seed, equal runs of a block together."""
    def work(docs: pa.Table, known: pa.Table) -> pa.Table:
        wanted, having = B.numbers(known["hashes"]), B.numbers(known["having"], np.int64)
        order = np.argsort(wanted)
        wanted, having = wanted[order], having[order]
        uid, found = docs["uid"].to_numpy(), {}
        for t in texts_of(docs["text"]) if len(wanted) else ():
            w = Windows(t, length)
            at = np.flatnonzero(w.whole & B.among(w.least, wanted))
            if not len(at):
                continue
            new = np.ones(len(at), bool)
            doc = np.searchsorted(t.offsets, at, "right") - 1
            new[1:] = (np.diff(at) > 1) | (w.least[at][1:] != w.least[at][:-1]) | (np.diff(doc) != 0)
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(at)) - 1
            raw = t.data.tobytes()
            owner = uid[t.first + doc[head]]
            for seed, a, b, u, s in zip(
                w.least[at[head]].tolist(), at[head].tolist(), (at[tail] + length).tolist(), owner.tolist(),
                (at[head] - t.offsets[doc[head]]).tolist(),
            ):
                found.setdefault((seed, raw[a:b]), []).append((u, s))
        block = docs["block"][0].as_py() if docs.num_rows else 0
        keys = list(found)
        seed = np.array([k[0] for k in keys], np.uint64)
        spread = -(-having[np.searchsorted(wanted, seed)] // per_shard) if len(keys) else np.zeros(0, np.int64)
        pairs = [np.array(v, np.int64) for v in found.values()]
        return pa.table({
            "shard": (seed % np.uint64(shards)).astype(np.int64), "sub": block % np.maximum(spread, 1), "spread": spread,
            "block": np.full(len(keys), block), "seed": seed.view(np.int64), "stretch": pa.array([k[1] for k in keys], pa.binary()),
            "uids": pa.array([p[:, 0].tobytes() for p in pairs], pa.binary()),
            "starts": pa.array([p[:, 1].tobytes() for p in pairs], pa.binary()),
        }, schema=pa.schema(_STRETCH))
    return work


class Stretches:
    """The distinct stretches of a (sub-)shard with their number, as one text."""

    def __init__(self, part: pa.Table, length: int):
        part = part.combine_chunks()
        self.length = length
        known: dict[tuple[int, bytes], int] = {}
        seeds = part["seed"].to_numpy()
        self.row = np.array([known.setdefault(k, len(known)) for k in zip(seeds.tolist(), part["stretch"].to_pylist())], np.int64)
        self.many = B.sizes(part["uids"])
        self.block, self.uid = part["block"].to_numpy(), B.numbers(part["uids"], np.int64)
        self.start = B.numbers(part["starts"], np.int64)
        self.count = np.bincount(self.row, self.many, len(known)).astype(np.int64)
        self.text = [k[1] for k in known]
        self.seed = np.array([k[0] for k in known], np.int64)
        spread = np.zeros(len(known), np.int64)
        spread[self.row] = part["spread"].to_numpy()
        self.spread = spread

    def intervals(self, which: np.ndarray, at: np.ndarray) -> pa.Table:
        """Covered ranges of all occurrences, per block, for the repeated windows ``at`` of stretch ``which`` (sorted)."""
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(which) != 0) | (np.diff(at) > self.length)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(at)) - 1 if len(at) else head
        of, low, high = which[head], at[head], at[tail] + self.length if len(at) else at
        first = np.searchsorted(of, np.arange(len(self.text)))
        number = np.searchsorted(of, np.arange(len(self.text)), "right") - first
        row = np.repeat(self.row, self.many)  # one entry per occurrence
        block = np.repeat(self.block, self.many)
        times = number[row]
        occurrence = np.repeat(np.arange(len(row)), times)
        span = np.repeat(first[row], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        start = self.start[occurrence]
        return B.table(
            list(B.pieces(block[occurrence], self.uid[occurrence], low[span] + start, high[span] + start)),
            block=pa.int64(), uids=pa.binary(), lows=pa.binary(), highs=pa.binary(),
        )

    def joined(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The used stretches as one text, the stretch of each byte, and the byte's place in it."""
        data = np.frombuffer(b"".join(self.text[i] for i in use), np.uint8)
        size = np.array([len(self.text[i]) for i in use], np.int64)
        which = np.repeat(use, size)
        place = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
        return data, which, place

    def all_windows(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(self.text[i]) - self.length + 1 for i in use], np.int64)
        return np.repeat(use, size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """(stretch, place) of windows that occur twice or more here, in order."""
        _, kind, kinds = np.unique(self.seed, return_inverse=True, return_counts=True)
        copies = (kinds[kind] == 1) & (self.count > 1)  # no other stretch of the seed, and equal to each other
        parts = [self.all_windows(np.flatnonzero(copies))]
        rest = np.flatnonzero(~copies)
        if len(rest):
            data, which, place = self.joined(rest)
            order, cut = suffix_array(data, self.length)
            shared = common_prefixes(data, order, cut, self.length)
            group = np.cumsum(shared < self.length)
            size = np.array([len(x) for x in self.text], np.int64)
            window = place + self.length <= size[which]
            sorted_window = window[order]
            total = np.bincount(group[sorted_window], self.count[which[order[sorted_window]]], group[-1] + 1)
            again = np.sort(order[sorted_window & (total[group] > 1)])
            parts.append((which[again], place[again]))
        which, at = (np.concatenate(v) for v in zip(*parts))
        order = np.lexsort((at, which))
        return which[order], at[order]

    def fingerprints(self, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(stretch, place, two hashes) of every window of the used stretches."""
        data, which, place = self.joined(use)
        size = np.array([len(x) for x in self.text], np.int64)
        n = max(0, len(data) - self.length + 1)
        one = equal_spans(prefix(CODES[data], BASE), self.length, BASE)[:n]
        two = equal_spans(prefix(mix(CODES)[data], BASE), self.length, BASE)[:n]
        ok = place[:n] + self.length <= size[which[:n]]
        return which[:n][ok], place[:n][ok], one[ok], two[ok]


def _within(length: int):
    def work(part: pa.Table) -> pa.Table:
        s = Stretches(part, length)
        return s.intervals(*s.repeated())
    return work


def _list_windows(shards: int, length: int):
    """Sorted windows of the seeds that are dealt to several sub-shards."""
    def work(key: tuple, part: pa.Table) -> pa.Table:
        s = Stretches(part, length)
        _, _, one, two = s.fingerprints(np.arange(len(s.text)))
        both = np.unique(np.stack([one, two], axis=1), axis=0)
        where = (both[:, 0] % np.uint64(shards)).astype(np.int64)
        rows = [(int(key[0].as_py()), int(key[1].as_py()), w, a, b) for w, a, b in B.pieces(where, both[:, 0].copy(), both[:, 1].copy())]
        return B.table(rows, shard=pa.int64(), sub=pa.int64(), range=pa.int64(), ones=pa.binary(), twos=pa.binary())
    return work


def _merge(part: pa.Table) -> pa.Table:
    """Windows of each sub-shard's list that another one's list holds too, found by binary search."""
    part = part.combine_chunks()
    many = B.sizes(part["ones"])
    owner = np.repeat(np.arange(part.num_rows), many)
    one, two = B.numbers(part["ones"]), B.numbers(part["twos"])
    key = np.ascontiguousarray(np.stack([one, two], axis=1)).view([("a", np.uint64), ("b", np.uint64)]).ravel()
    order = np.argsort(key, order=("a", "b"), kind="stable")
    sorted_ = key[order]
    new = np.ones(len(key), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    first = np.flatnonzero(new)
    number = np.diff(np.append(first, len(key)))
    both = sorted_[first][number > 1]  # held by two sub-shards or more
    low = np.searchsorted(both["a"], one, "left")
    hit = np.zeros(len(key), bool)
    while True:  # lists are short behind the first hash: nearly always one entry
        inside = low < len(both)
        inside[inside] = both["a"][low[inside]] == one[inside]
        hit[inside] |= both["b"][low[inside]] == two[inside]
        if not (inside & ~hit).any():
            break
        low = np.where(inside & ~hit, low + 1, len(both))
    rows = [
        (int(part["shard"][i].as_py()), int(part["sub"][i].as_py()), a, b)
        for i, a, b in B.pieces(owner[hit], one[hit], two[hit])
    ]
    return B.table(rows, shard=pa.int64(), sub=pa.int64(), ones=pa.binary(), twos=pa.binary())


def _across(length: int):
    def work(part: pa.Table, found: pa.Table) -> pa.Table:
        s = Stretches(part, length)
        known = set(zip(B.numbers(found["ones"]).tolist(), B.numbers(found["twos"]).tolist()))
        which, at, one, two = s.fingerprints(np.arange(len(s.text)))
        near = np.isin(one, B.numbers(found["ones"]))
        hit = near.copy()
        hit[near] = [k in known for k in zip(one[near].tolist(), two[near].tolist())]
        return s.intervals(which[hit], at[hit])
    return work


def _remove(carry: Sequence[str], with_rest: bool):
    def work(docs: pa.Table, found: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        uid = docs["uid"].to_numpy()
        order = np.argsort(uid)
        place = order[np.searchsorted(uid[order], B.numbers(found["uids"], np.int64))] if len(uid) else order
        low, high = B.numbers(found["lows"], np.int64), B.numbers(found["highs"], np.int64)
        by_doc = np.argsort(place, kind="stable")
        place, low, high = place[by_doc], low[by_doc], high[by_doc]
        n_bytes, n_removed, n_spans, digest, kept = [], [], [], [], []
        for t in texts_of(docs["text"]):
            mine = slice(*np.searchsorted(place, [t.first, t.first + len(t)]))
            edge = np.zeros(len(t.data) + 1, np.int64)
            base = t.offsets[place[mine] - t.first]
            np.add.at(edge, base + low[mine], 1)
            np.add.at(edge, base + high[mine], -1)
            gone = np.cumsum(edge[:-1]) > 0
            start = gone.copy()
            start[1:] &= ~gone[:-1]
            inner = t.offsets[:-1][np.diff(t.offsets) > 0]
            start[inner] = gone[inner]  # a run never goes on into the next text
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[t.offsets])
            n_bytes += np.diff(t.offsets).tolist()
            n_removed += total(gone).tolist()
            n_spans += total(start).tolist()
            rest, ends = t.data[~gone].tobytes(), np.concatenate([[0], np.cumsum(~gone)])[t.offsets]
            texts = [rest[a:b] for a, b in zip(ends[:-1], ends[1:])]
            digest += [hashlib.sha256(x).hexdigest() for x in texts]
            kept += texts if with_rest else ()
        out = {c: docs[c] for c in carry}
        out |= {n: pa.array(v, pa.int64()) for n, v in (("n_bytes", n_bytes), ("n_removed", n_removed), ("n_spans", n_spans))}
        out["kept_sha256"] = pa.array(digest, pa.string())
        if with_rest:
            out["kept_bytes"] = pa.array(kept, pa.binary())
        return pa.table(out)
    return work


def remove_repeated_bytes(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH,
    with_rest: bool = False, blocks: int | None = None, per_shard: int = BLOCKS_PER_SHARD,
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (and ``kept_bytes``).

    Every byte covered by a ``length``-byte string that also starts anywhere else is removed, in the same
    text or another.  Texts are UTF-8 bytes; null counts as empty.  Each row is a text of its own, so
    repeated rows are copies of each other and of ``length`` bytes or more nothing of them is left.  Null ids are
    kept as they are.  Other columns are ignored; an empty table gives an empty result.
    """
    text = F.col(text_column).cast("string")
    n = blocks or B.block_count(docs, text)
    held = B.in_blocks(docs, [F.col(id_column).alias("id"), F.coalesce(text.cast("binary"), F.lit(b"")).alias("text")], n)
    seeds = stage(B.shared_hashes(held.select("block", "text").mapInArrow(_offer_seeds(n, length), B.OFFER)), "seeds")
    found = stage(B.meet(held.select("block", "uid", "text"), seeds, _stretches(n * SHARDS_PER_BLOCK, length, per_shard), _STRETCH_SQL), "stretches")
    spans = "block long, uids binary, lows binary, highs binary"
    near = stage(found.groupBy("shard", "sub").applyInArrow(_within(length), spans), "near")
    dealt = found.filter("spread > 1")
    lists = dealt.groupBy("shard", "sub").applyInArrow(
        _list_windows(n, length), "shard long, sub long, range long, ones binary, twos binary")
    both = lists.groupBy("range").applyInArrow(_merge, "shard long, sub long, ones binary, twos binary")
    far = stage(dealt.groupBy("shard", "sub").cogroup(both.groupBy("shard", "sub")).applyInArrow(_across(length), spans), "far")
    kinds = dict(held.dtypes)
    schema = f"id {kinds['id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_rest
    out = B.meet(held, near.union(far), _remove(["id"], with_rest), schema)
    return out.withColumnRenamed("id", id_column)
