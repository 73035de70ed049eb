"""Substring de-duplication by repeated-phrase automata.

A word is covered when it lies in a window of ``WINDOW`` consecutive words whose sequence
also starts in a document with a smaller id.  Equal windows share the same least run of
``SEED`` words, so:

1. every block offers the least runs of its windows; those that recur are found per shard;
2. windows around a recurring run are compared over all blocks: the smallest document with a
   window owns it, and the owner's block cuts the recurring passages from its texts, confirmed
   word by word, for the blocks that need them;
3. each block compiles the passages it needs into Aho-Corasick automata (one per block, so
   their size is bounded by the block) and streams all its documents through them; every hit
   of a run is extended to both sides in the passage, and 13 equal words or more are covered.

Nothing is sampled or capped.  Words are compared by 64-bit hashes of their bytes, windows by two such hashes of their
words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vacantia.llm import blocks as B
from vacantia.llm.rolling import (
    BASE, WORD_BASE, Texts, equal_spans, mix, prefix, spans, texts_of, window_min,
)
from vacantia.session import stage

WINDOW = 13
SEED = 6
SIDE = WINDOW - SEED
LETTERS, DIGITS = 4, 32  # a million words; beyond that numbers repeat, and hits are checked anyway
_NO_DOC = -(1 << 63)


class Words:
    """The words of some texts: hashes, seeds, least seed of each window, and window hashes."""

    def __init__(self, texts: Texts):
        self.texts = texts
        self.start, self.end, self.first, self.hash = texts.word_hashes()
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        sums = prefix(self.hash, WORD_BASE)
        self.seeds = equal_spans(sums, SEED, WORD_BASE)
        self.least = window_min(self.seeds, SIDE + 1)[: max(0, len(self.hash) - WINDOW + 1)]
        self.windows = equal_spans(sums, WINDOW, WORD_BASE)
        n = len(self.least)
        self.whole = self.doc[:n] == self.doc[WINDOW - 1 :][:n]

    def seconds(self, at: np.ndarray) -> np.ndarray:
        """A second hash of the windows at ``at``, independent of ``windows``."""
        return spans(prefix(mix(self.hash), BASE), at, at + WINDOW, BASE)


def _offer_seeds(shards: int):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for part in parts:
            block = part["block"].to_numpy()
            for t in texts_of(part["text"]):
                w = Words(t)
                doc, least = w.doc[: len(w.least)][w.whole], w.least[w.whole]
                new = np.ones(len(least), bool)
                order = np.lexsort((least, doc))
                doc, least = doc[order], least[order]
                new[1:] = (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])
                doc, least = doc[new], least[new]
                of = block[t.first + doc]
                for b in np.unique(of):
                    held.setdefault(int(b), []).append(least[of == b])
        for b, found in held.items():
            yield from B.offers(B.offer(np.concatenate(found), b, shards))
    return work


def _keys(part: pa.Table) -> np.ndarray:
    return part["key"].to_numpy()


def _differ(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Where a run of equal windows begins."""
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return new


def _claim_windows(shards: int):
    """Windows around recurring seeds of a block: their two hashes, and the smallest document."""
    def work(docs: pa.Table, known: pa.Table) -> pa.Table:
        wanted = np.unique(B.numbers(known["hashes"]))
        hashes, twos, keys, key = [], [], [], _keys(docs)
        if len(wanted):
            for t in texts_of(docs["text"]):
                w = Words(t)
                at = np.flatnonzero(w.whole & B.among(w.least, wanted))
                hashes.append(w.windows[at])
                twos.append(w.seconds(at))
                keys.append(key[t.first + w.doc[at]])
        hash_, two, key = (
            np.concatenate(v) if v else np.zeros(0, k) for v, k in ((hashes, np.uint64), (twos, np.uint64), (keys, np.int64)))
        order = np.lexsort((key, two, hash_))
        hash_, two, key = hash_[order], two[order], key[order]
        new = _differ(hash_, two)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(hash_)) - 1 if len(at) else at
        hash_, two, several, key = hash_[at], two[at], key[last] > key[at], key[at]
        block = docs["block"][0].as_py() if docs.num_rows else 0
        shard = (hash_ % np.uint64(shards)).astype(np.int64)
        return B.table(
            [(s, block, *lists) for s, *lists in B.pieces(shard, hash_, two, key, several)],
            shard=pa.int64(), block=pa.int64(), hashes=pa.binary(), twos=pa.binary(), keys=pa.binary(), several=pa.binary(),
        )
    return work


def _owners(part: pa.Table) -> pa.Table:
    """For each recurring window: its smallest document, that one's block, and who needs it."""
    hash_, two = B.numbers(part["hashes"]), B.numbers(part["twos"])
    key = B.numbers(part["keys"], np.int64)
    several = B.numbers(part["several"], np.bool_)
    block = np.repeat(part["block"].to_numpy(), B.sizes(part["hashes"]))
    order = np.lexsort((key, two, hash_))
    hash_, two, key, several, block = hash_[order], two[order], key[order], several[order], block[order]
    new = _differ(hash_, two)
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    need = np.flatnonzero((key > key[first]) | several)
    own = first[need]
    return B.table(
        list(B.pieces(block[own], hash_[need], two[need], key[own], block[need])),
        block=pa.int64(), hashes=pa.binary(), twos=pa.binary(), keys=pa.binary(), targets=pa.binary(),
    )


def _cut_passages(docs: pa.Table, tasks: pa.Table) -> pa.Table:
    """The owner's words of the windows that each other block needs, in runs."""
    hash_, two = B.numbers(tasks["hashes"]), B.numbers(tasks["twos"])
    owner, target = (B.numbers(tasks[c], np.int64) for c in ("keys", "targets"))
    order = np.argsort(hash_, kind="stable")
    hash_, two, owner, target = hash_[order], two[order], owner[order], target[order]
    key, rows = _keys(docs), []
    for t in texts_of(docs["text"]) if len(hash_) else ():
        w = Words(t)
        at = np.flatnonzero(w.whole & B.among(w.windows[: len(w.least)], hash_))
        low = np.searchsorted(hash_, w.windows[at], "left")
        many = np.searchsorted(hash_, w.windows[at], "right") - low
        second = np.repeat(w.seconds(at), many)
        at, step = np.repeat(at, many), _steps(many)
        task = np.repeat(low, many) + step
        mine = (owner[task] == key[t.first + w.doc[at]]) & (two[task] == second)
        at, task = at[mine], task[mine]
        _, one = np.unique(task * len(t) + w.doc[at], return_index=True)
        at, task = at[one], task[one]
        order = np.lexsort((at, target[task]))
        at, task = at[order], task[order]
        if not len(at):
            continue
        cut = np.ones(len(at), bool)
        cut[1:] = (np.diff(target[task]) != 0) | (np.diff(at) > WINDOW) | (np.diff(w.doc[at]) != 0)
        head = np.flatnonzero(cut)
        tail = np.append(head[1:], len(at)) - 1
        raw = t.data.tobytes()
        rows += zip(
            target[task[head]].tolist(), owner[task[head]].tolist(),
            (raw[a:b] for a, b in zip(w.start[at[head]], w.end[at[tail] + WINDOW - 1])),
        )
    return B.table(rows, block=pa.int64(), owner=pa.int64(), passage=pa.binary())


def _steps(many: np.ndarray) -> np.ndarray:
    """0, 1, .. many[0]-1, 0, 1, .. many[1]-1, ..."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _sides(hash_: np.ndarray, doc: np.ndarray, at: np.ndarray, none: int) -> np.ndarray:
    """Words to the left and right of the seeds at ``at``; ``none`` where the text ends."""
    out = np.full((len(at), 2 * SIDE), none, np.uint64)
    for i in range(SIDE):
        for column, place in ((i, at - 1 - i), (SIDE + i, at + SEED + i)):
            ok = (place >= 0) & (place < len(hash_))
            ok[ok] = doc[place[ok]] == doc[at[ok]]
            out[ok, column] = hash_[place[ok]]
    return out


class Automaton:
    """Seeds of passages as an Aho-Corasick automaton, with the words around each seed."""

    def __init__(self, passages: pa.Table):
        passages = passages.combine_chunks()
        owner = passages["owner"].to_numpy()
        seeds, sides, owners, words, spelled = [], [], [], [], []
        for t in texts_of(passages["passage"]):
            w = Words(t)
            top = np.zeros(len(w.seeds) + SIDE, np.uint64)
            top[SIDE : SIDE + len(w.least)] = np.where(w.whole, w.least, 0)
            most = ~window_min(~top, SIDE + 1)[: len(w.seeds)]
            at = np.flatnonzero((w.seeds == most) & (most > 0))
            at = at[w.doc[at] == w.doc[at + SEED - 1]]
            seeds.append(w.seeds[at])
            sides.append(_sides(w.hash, w.doc, at, 0))
            owners.append(owner[t.first + w.doc[at]])
            spelled.append(w.hash[at[:, None] + np.arange(SEED)])
            words.append(np.unique(w.hash))
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        seed = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        side = np.concatenate(sides) if sides else np.zeros((0, 2 * SIDE), np.uint64)
        own = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        # equal surroundings count once, with their smallest owner
        order = np.lexsort((own, *side.T, seed))
        seed, side, own = seed[order], side[order], own[order]
        spelled = np.concatenate(spelled)[order] if spelled else np.zeros((0, SEED), np.uint64)
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (side[1:] != side[:-1]).any(axis=1)
        seed, self.side, self.own, spelled = seed[new], side[new], own[new], spelled[new]
        new = np.ones(len(seed), bool)
        new[1:] = seed[1:] != seed[:-1]
        self.low = np.flatnonzero(new)
        self.many = np.diff(np.append(self.low, len(seed)))
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        text, width = self.letters(spelled[self.low].ravel()), SEED * LETTERS
        for i in range(len(self.low)):
            self.machine.add_word(text[i * width : (i + 1) * width], i)
        if len(self.low):
            self.machine.make_automaton()

    def letters(self, hashes: np.ndarray) -> str:
        """``LETTERS`` characters per word: the digits of its number in the vocabulary.

        Each digit place has characters of its own, so a match begins with a word, and no state
        has more than ``DIGITS`` ways on, which the automaton searches one by one.
        """
        if not len(self.vocabulary):
            return ""
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == hashes
        out = np.ones((len(hashes), LETTERS), "<u4")
        for k in range(LETTERS):
            out[known, k] = 2 + k * DIGITS + place[known] % DIGITS
            place = place // DIGITS
        return out.tobytes().decode("utf-32-le")

    def covered(self, w: Words, key: np.ndarray) -> np.ndarray:
        """Which words of the texts lie in a window of a passage with a smaller owner."""
        n = len(w.hash)
        edge = np.zeros(n + 1, np.int64)
        hits = list(self.machine.iter(self.letters(w.hash))) if len(self.low) and n else []
        if hits:
            hit = np.array(hits, np.int64)
            at, seed = (hit[:, 0] + 1) // LETTERS - SEED, hit[:, 1]
            one = w.doc[at] == w.doc[at + SEED - 1]
            at, seed = at[one], seed[one]
            for a in range(0, len(at), 1 << 15):
                p, s = at[a : a + (1 << 15)], seed[a : a + (1 << 15)]
                many = self.many[s]
                around = np.repeat(self.low[s], many) + _steps(many)
                place = np.repeat(p, many)
                smaller = self.own[around] < key[w.doc[place]]
                around, place = around[smaller], place[smaller]
                same = _sides(w.hash, w.doc, place, 1) == self.side[around]
                left = np.cumprod(same[:, :SIDE], axis=1).sum(axis=1)
                right = np.cumprod(same[:, SIDE:], axis=1).sum(axis=1)
                ok = left + right >= SIDE
                edge += np.bincount((place - left)[ok], minlength=n + 1)
                edge -= np.bincount((place + SEED + right)[ok], minlength=n + 1)
        return np.cumsum(edge[:n]) > 0


def kept_text(w: Words, keep: np.ndarray) -> list[bytes]:
    """Per text the kept words joined by one space."""
    data = w.texts.data.copy()
    start, end, doc = w.start[keep], w.end[keep], w.doc[keep]
    edge = np.zeros(len(data) + 1, np.int32)
    edge[start] += 1
    edge[end] -= 1
    mask = np.cumsum(edge[:-1]) > 0
    joint = start[1:][doc[1:] == doc[:-1]] - 1
    mask[joint] = True
    data[joint] = 32
    total = np.concatenate([[0], np.cumsum(mask)])[w.texts.offsets]
    out = data[mask].tobytes()
    return [out[a:b] for a, b in zip(total[:-1], total[1:])]


def _scan(carry: Sequence[str], with_text: bool):
    def work(docs: pa.Table, passages: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        automaton, key = Automaton(passages), _keys(docs)
        n_words, n_removed, digest, kept = [], [], [], []
        for t in texts_of(docs["text"]):
            w = Words(t)
            gone = automaton.covered(w, key[t.first : t.first + len(t)])
            n_words += np.diff(w.first).tolist()
            n_removed += np.bincount(w.doc[gone], minlength=len(t)).tolist()
            texts = kept_text(w, ~gone)
            digest += [hashlib.sha256(x).hexdigest() for x in texts]
            kept += texts if with_text else ()
        out = {c: docs[c] for c in carry}
        out |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
        out["kept_sha256"] = pa.array(digest, pa.string())
        if with_text:
            out["kept_text"] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.table(out)
    return work


def remove_repeated_phrases(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    carry: Sequence[str] = (), with_text: bool = True, blocks: int | None = None,
) -> DataFrame:
    """Documents without the passages that a document with a smaller id has.

    Returns, per row of ``docs``: the id, the columns in ``carry``, ``n_words``, ``n_removed``,
    ``kept_sha256`` and, if ``with_text``, ``kept_text`` (kept words joined by one space).

    Null text counts as empty: no words.  A null id counts as smaller than every number.  Rows with
    the same id are one document as to windows, so repeated rows remove nothing from each other;
    each still gives a row.  Other columns are ignored, whatever their names; an empty table
    gives an empty result.
    """
    id_, text = F.col(id_column), F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    n = blocks or B.block_count(docs, text)
    carried = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    held = B.in_blocks(docs, [
        F.coalesce(id_.cast("long"), F.lit(_NO_DOC)).alias("key"), id_.alias("id"),
        text.cast("binary").alias("text"), *carried,
    ], n)
    docs_only = held.select("block", "key", "text")
    seeds = stage(B.shared_hashes(docs_only.select("block", "text").mapInArrow(_offer_seeds(n), B.OFFER)), "seeds")
    claims = B.meet(
        docs_only, seeds, _claim_windows(n), "shard long, block long, hashes binary, twos binary, keys binary, several binary"
    )
    owners = stage(claims.groupBy("shard").applyInArrow(
        _owners, "block long, hashes binary, twos binary, keys binary, targets binary"), "owners")
    passages = stage(B.meet(docs_only, owners, _cut_passages, "block long, owner long, passage binary"), "passages")
    kinds = dict(held.dtypes)
    names = ["id", *(f"carry_{i}" for i in range(len(carry)))]
    schema = ", ".join([f"{c} {kinds[c]}" for c in names] + ["n_words long", "n_removed long", "kept_sha256 string"]
                       + ["kept_text string"] * with_text)
    out = B.meet(held.drop("uid"), passages, _scan(names, with_text), schema)
    return out.withColumnsRenamed({"id": id_column} | {f"carry_{i}": c for i, c in enumerate(carry)})
