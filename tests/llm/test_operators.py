"""Each operator on a small table with nulls, empty and long texts, ties, repeats and clashing columns,
against brute force where SQL has no form."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from tokenizers import Tokenizer

pytest.importorskip("vacantia.llm")
public_tokenizers = pytest.importorskip("public_tokenizers")

from vacantia.llm import (  # noqa: E402
    blocks, components, dart, hosts, nnpu, packing, phrases, pieces, pivots, revisits, rolling, suffixes, tokens,
)
from vacantia.session import scratch_path  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0d]+")
BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{rng.integers(0, 4000)}é" for _ in range(n))


LONG = prose(1, 4000)
SHARED = prose(2, 60)
TEXTS = {
    1: LONG, 2: prose(3, 40) + "\n" + SHARED + " " + prose(4, 30), 3: SHARED, 4: "", 5: None, 6: " \n\t ", 7: "a b c",
    8: "a b c", 9: "ab " * 300, 10: LONG.replace("w1", "v1", 3), 11: prose(5, 80) + " " + SHARED, 12: "x" * 5000,
    13: "one\none\ntwo # * $\n\n" + prose(6, 55), 14: SHARED, 15: "'s <|endoftext|> ▁▁ ａ́ \x1c \x85 ✓ 한국어 🙂 İ",
}
ROWS = [(k, v) for k, v in TEXTS.items()] + [(3, SHARED), (None, prose(7, 70)), (None, SHARED)]


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns are named like the results of the operators and their helpers."""
    rows = [(k, v, k or 0, "x", 0.5, True, "h" if k is None or k % 3 else None) for k, v in ROWS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, n_words long, block string, score double, kept boolean, source string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("doc_id = -1")


def collected(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_window_hashes_agree_with_slices():
    data = np.frombuffer(b"abcabcabcd" * 7, np.uint8)
    sums = rolling.prefix(rolling.CODES[data], rolling.BASE)
    hashes = rolling.equal_spans(sums, 5, rolling.BASE).tolist()
    raw = data.tobytes()
    same = {raw[i : i + 5]: h for i, h in enumerate(hashes)}
    assert all(same[raw[i : i + 5]] == h for i, h in enumerate(hashes)) and len(set(same.values())) == len(same)
    values = np.random.default_rng(0).integers(0, 99, 50).astype(np.uint64)
    assert rolling.window_min(values, 7).tolist() == [min(values[i : i + 7]) for i in range(44)]


def test_phrases_against_brute_force(docs, empty):
    low = lambda k: -(1 << 63) if k is None else k
    first: dict = {}
    words = [(k, WORD.findall(t or "")) for k, t in ROWS]
    for k, w in words:
        for i in range(len(w) - 12):
            x = tuple(w[i : i + 13])
            first[x] = min(first.get(x, low(k)), low(k))
    want = []
    for k, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < low(k):
                gone[i : i + 13] = [True] * 13
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((k, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    out = phrases.remove_repeated_phrases(docs)
    assert collected(out, "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text") == sorted(want, key=repr)
    assert phrases.remove_repeated_phrases(empty, carry=["source"]).collect() == []


def test_phrases_when_window_hashes_collide(monkeypatch):
    """Seven hashes for all windows: the second hash alone tells them apart."""
    plain = phrases.equal_spans
    monkeypatch.setattr(phrases, "equal_spans", lambda sums, size, base: (
        plain(sums, size, base) % np.uint64(7) if size == phrases.WINDOW else plain(sums, size, base)))
    draw = random.Random(3)
    passages = [" ".join(f"p{i}x{draw.randint(0, 999)}" for _ in range(20)) for i in range(12)]
    rows = [" ".join([prose(100 + k, 15), *draw.sample(passages, 3), prose(500 + k, 15)]) for k in range(30)]
    first: dict = {}
    for k, w in enumerate(map(WORD.findall, rows)):
        for i in range(len(w) - 12):
            first.setdefault(tuple(w[i : i + 13]), k)
    want = []
    for k, w in enumerate(map(WORD.findall, rows)):
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < k for j in range(i, i + 13)}
        want.append(len(gone))
    docs = pa.table({
        "block": pa.array([0] * len(rows), pa.int64()), "key": pa.array(range(len(rows)), pa.int64()),
        "text": pa.array([r.encode() for r in rows], pa.binary())})
    seeds = np.concatenate([phrases.Words(t).least for t in rolling.texts_of(docs["text"])])
    claims = phrases._claim_windows(3)(docs, pa.table({"hashes": pa.array([seeds.tobytes()], pa.binary())}))
    owners = pa.concat_tables([phrases._owners(claims.filter(pc.equal(claims["shard"], i))) for i in range(3)])
    out = phrases._scan(["key"], False)(docs, phrases._cut_passages(docs, owners))
    assert sum(want) > 500 and out["n_removed"].to_pylist() == want


@pytest.mark.parametrize("per_shard", [64, 1])
def test_suffixes_against_brute_force(docs, empty, per_shard):
    raw = [(k, (t or "").encode()) for k, t in ROWS]
    count = Counter(b[i : i + 200] for _, b in raw for i in range(len(b) - 199))
    want = []
    for k, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if count[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = int((gone[:-1] & ~np.append(False, gone[:-2])[: len(b)]).sum()) if len(b) else 0
        rest = bytes(c for c, g in zip(b, gone) if not g)
        want.append((k, len(b), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()))
    out = suffixes.remove_repeated_bytes(docs, per_shard=per_shard)
    assert collected(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    if per_shard == 1:
        assert suffixes.remove_repeated_bytes(empty).collect() == []


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(0)
    for n in (1, 7, 90, 700):
        data = rng.integers(97, 100, n).astype(np.uint8)
        data[n // 2 : n // 2 + n // 3] = data[: n // 3]
        raw = data.tobytes()
        order, cut = suffixes.suffix_array(data, 40)
        at = [raw[i : i + 40] for i in order]
        assert at == sorted(at) and sorted(order) == list(range(n))
        shared = suffixes.common_prefixes(data, order, cut, 40, lane=64)
        for i in range(1, n):
            same = next((k for k, (x, y) in enumerate(zip(at[i - 1], at[i])) if x != y), min(len(at[i - 1]), len(at[i])))
            assert shared[i] == same


def weighted_classes(rows, threshold=0.8):
    """Class of each row by all pairs; rows without words are alone."""
    sets = []
    for _, t in rows:
        w = WORD.findall(t or "")
        sets.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and sum((a & b).values()) >= threshold * sum((a | b).values()):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return root


def test_near_duplicates_against_all_pairs(docs, empty):
    root = weighted_classes(ROWS)
    ids = {r: [k for (k, _), x in zip(ROWS, root) if x == r] for r in set(root)}
    least = {r: min((k for k in v if k is not None), default=None) for r, v in ids.items()}
    out = dart.near_duplicates(docs)
    assert collected(out, "doc_id", "class_id", "class_size") == sorted(
        [(k, least[r], len(ids[r])) for (k, _), r in zip(ROWS, root)], key=repr)
    assert out.filter("kept").count() == len(ids)
    kept = dart.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(ids)
    assert dart.near_duplicates(empty).collect() == [] and dart.keep_one(empty).collect() == []


def changed(base: list, rng, n: int) -> str:
    """``base`` with ``n`` words, no two of them near each other, replaced by new ones."""
    words = list(base)
    for at in rng.choice(len(base) // 6, n, replace=False) * 6 + 2:
        words[at] = f"n{rng.integers(1 << 40)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [512, 40])
def test_near_duplicates_in_mixed_buckets(spark, monkeypatch, block):
    monkeypatch.setattr(dart, "BLOCK", block)
    rng = np.random.default_rng(0)
    hub, form = prose(20, 200).split(), prose(21, 200).split()
    rows = [changed(hub, rng, 4) for _ in range(250)]  # each near the base, none near another
    rows.insert(130, " ".join(hub))
    unlike = [changed(form, rng, 6) for _ in range(250)]  # one template, none near another
    rows += unlike + [changed(unlike[i].split(), rng, 1) for i in range(100, 130)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, rows)]
    root = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            if 9 * len(x & sets[j]) >= 4 * (len(x) + len(sets[j])):  # 0.8 of the union
                old, new = sorted((root[i], root[j]))
                root = [old if r == new else r for r in root]
    out = dart.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").coalesce(2))
    assert collected(out, "doc_id", "class_id") == sorted(enumerate(root), key=repr)


def test_pivots_are_used_once(spark):
    rows = [(band, uid, 60, 0) for band in (0, 1) for uid in range(60)]
    member = spark.createDataFrame(rows, "band int, uid long, n long, head long")
    used = [(r["band"], r["uid"]) for turn in range(9) for r in dart._pivots(member, turn).collect()]
    assert sorted(used) == [(band, uid) for band, uid, _, _ in rows]


def test_wanted_texts_of_one_id_do_not_all_meet(spark):
    rows = spark.createDataFrame([(i, None, i, i, i, b"x") for i in range(40)], "uid long, key long, print long, d1 long, d2 long, text binary")
    assert collected(dart._texts_of(rows, rows.drop("text")), "uid", "d1") == sorted(((i, i) for i in range(40)), key=repr)


def test_texts_that_are_not_wanted_are_not_moved(spark):
    text = prose(1, 3000).encode()
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else i, i, i, i, text) for i in range(400)], "uid long, key long, print long, d1 long, d2 long, text binary")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = dart._texts_of(rows, rows.filter("uid < 20").drop("text"))
        assert sorted(r["uid"] for r in found.collect()) == list(range(20))
        plan = found._jdf.queryExecution().executedPlan().finalPhysicalPlan()
        moved = []

        def walk(node):
            if node.nodeName() == "Exchange":
                moved.append(node.metrics().apply("dataSize").value())
            for k in range(node.children().size()):
                walk(node.children().apply(k))
            if "QueryStage" in node.nodeName():
                walk(node.plan())

        walk(plan)
        assert moved and max(moved) < 100 * len(text)  # of 400 texts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    one = rng.integers(1, 9, 300)
    two = np.where(rng.random(300) < 0.3, rng.integers(1, 9, 300), one)
    element = rolling.mix(np.arange(300, dtype=np.uint64))
    sign = dart.signatures(np.repeat([0, 1], 300), np.tile(element, 2), np.concatenate([one, two]), 3)
    true = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert abs((sign[0] == sign[1]).mean() - true) < 0.15 and not sign[2].any() and sign[:2].all()


@pytest.mark.parametrize("per_task", [1_000_000, 20])
def test_components(spark, monkeypatch, per_task):
    monkeypatch.setattr(components, "LINKS_PER_TASK", per_task)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)] + [(200, 201 + i) for i in range(40)]
    out = {r["id"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({out[i] for i in range(61)}) == len({out[100], out[101]}) == len({out[200 + i] for i in range(41)}) == 1
    assert len(set(out.values())) == 3


def encoded():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    return [(k, t.encode(x or "", add_special_tokens=False).ids + [1]) for k, x in ROWS]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_planes_round_trip(spark, docs, empty, kind):
    ids = np.random.default_rng(0).integers(0, 70_000, 1001).astype(np.uint32)
    assert (tokens.from_planes(tokens.to_planes(ids, kind), len(ids), kind) == ids).all()
    path = scratch_path(spark, "planes")
    tokens.write_planes(docs, path, BPE, chunk_ids=128, kind=kind)
    order = sorted(encoded(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = collected(tokens.read_documents(spark, path), "id", "n_tokens", "ids_crc32")
    assert got == sorted([(k, len(x), crc(x)) for k, x in order], key=repr)
    starts = {r["id"]: r["start"] for r in tokens.read_documents(spark, path).collect()}
    at = 0
    for k, x in order:
        if k not in (None, 3):  # repeated ids have several starts
            assert starts[k] == at
        at += len(x)
    path = scratch_path(spark, "planes")
    tokens.write_planes(empty, path, BPE)
    assert tokens.read_documents(spark, path).collect() == []


def test_packing_holds_every_id_once(docs, empty):
    ids = encoded()
    rows = packing.pack(docs, BPE, length=256).collect()
    need = Counter((k, crc(x[a : a + 256]), a, len(x[a : a + 256]), len(x)) for k, x in ids for a in range(0, len(x), 256))
    assert Counter((r["doc_id"], r["ids_crc32"], r["start"], r["length"], r["doc_tokens"]) for r in rows) == need
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 256
    assert packing.pack(empty, BPE).collect() == []


def test_patterns_fill_sequences():
    sizes, unit = packing.length_classes(256)
    lengths = np.random.default_rng(0).integers(1, 200, 3000)
    demand = np.bincount(np.searchsorted(sizes * unit, lengths), minlength=len(sizes))
    planned = packing.plan(demand, sizes, int(sizes[-1]))
    assert (sum(p * n for p, n in planned) >= demand).all()
    assert all((p * sizes).sum() <= sizes[-1] for p, _ in planned)
    assert lengths.sum() / (256 * sum(n for _, n in planned)) > 0.93
    assert packing.plan(np.zeros_like(demand), sizes, int(sizes[-1])) == []


def test_host_rules_against_brute_force(docs, empty):
    want = []
    for k, t in ROWS:
        t = t or ""
        w = WORD.findall(t)
        grams = list(zip(w, w[1:], w[2:]))
        count = Counter(grams)
        again = {j for i, g in enumerate(grams) if count[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        bad = len(w) < 50 or 100 * len(again) > 50 * len(w)
        want.append((k, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), bad))
    out = hosts.judge_hosts(docs)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert collected(out, *names) == sorted(want, key=repr)
    assert out.filter("kept = base_failed").count() == 0
    assert hosts.judge_hosts(empty).collect() == []


def planted_hosts(spark):
    """Good hosts, one with many texts of few words, one full of symbols, a tiny bad one, and rows without a host."""
    rows, clean = [], prose(1, 60)
    for h in range(12):
        rows += [(f"good{h}", prose(h * 100 + i, 60) if i % 10 else "few words") for i in range(60)]
    rows += [("short", prose(5000 + i, 60) if i % 3 == 0 else "few words") for i in range(90)]
    rows += [("marks", prose(6000 + i, 60) + " #" * (20 if i % 4 else 0)) for i in range(80)]
    rows += [("tiny", "few words"), ("tiny", clean), (None, clean), (None, "few"), (None, None)]
    return spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string").repartition(3), rows


def test_host_verdict_against_brute_force(spark):
    table, rows = planted_hosts(spark)
    rules = {
        "words": lambda t, w: len(w) < 50, "symbols": lambda t, w: 10 * len(re.findall(r"[#*$%&|<>]", t)) > len(w), "repeats": lambda t, w: False,
        "lines": lambda t, w: False}
    want = {}
    for name, rule in rules.items():
        of: dict = {}
        for h, t in rows:
            if h is not None:
                of.setdefault(h, []).append(rule(t or "", WORD.findall(t or "")))
        rate = np.array([np.mean(v) for v in of.values()])
        docs = np.array([len(v) for v in of.values()])
        failed = np.array([sum(v) for v in of.values()])
        mean, total = failed.sum() / docs.sum(), docs.sum()
        noise = mean * (1 - mean)
        between = rate.var(ddof=1) - noise * (1 / docs).mean()
        weight = noise / between - 1 if noise > between > 0 else total
        post = (failed + mean * weight) / (docs + weight)
        low = post - hosts.CERTAIN * np.sqrt(post * (1 - post) / (docs + weight + 1))
        for h, x in zip(of, low):
            want.setdefault(h, set()).update({name} if x > mean + hosts.MARGIN else set())
    assert want["short"] == {"words"} and want["marks"] == {"symbols"} and want["tiny"] == set()
    out = hosts.judge_hosts(table).collect()
    assert len(out) == len(rows)
    for r in out:
        h, t = rows[r["doc_id"]]
        assert set(r["host_rules"]) == want.get(h, set()), h
        assert r["kept"] == (not r["base_failed"] and not want.get(h))
    kept = {rows[r["doc_id"]][0] for r in out if r["kept"]}
    assert "tiny" in kept and None in kept and "short" not in kept and "good3" in kept


def test_host_prior_shrinks_small_hosts(spark):
    rows = [("big", i < 100) for i in range(1000)] + [("odd", i < 450) for i in range(500)] + [("tiny", True)]
    df = spark.createDataFrame(rows, "host string, bad boolean")
    rate = {r["host"]: r["rate_x"] for r in hosts.host_rates(df, rules={"x": "bad"}).collect()}
    assert abs(rate["big"] - 0.1) < 0.02 and rate["odd"] > 0.85 and 0.3 < rate["tiny"] < 1


def test_one_id_on_many_rows_sends_one_text_to_the_fit(spark, monkeypatch):
    rows = [(5, prose(i, 30)) for i in range(3000)] + [(i, prose(i, 30)) for i in range(100, 200)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(100, 200)] + [(5, 1)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(nnpu, "fit", lambda p, u, prior: seen.append((len(p), len(u))) or (np.zeros(0, np.uint64), np.zeros(0), 0.0))
    nnpu.train(table, marks)
    assert seen[0][0] <= 35 and seen[0][1] <= 101


def test_words_of_a_long_text_are_bounded_in_the_fit(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(nnpu, "MAX_WORDS", 7)
    letters = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    part = pa.record_batch({"positive": pa.array([True, False, False]), "text": pa.array([" ".join(letters(i) for i in range(100)), "a b", ""])})
    words = [np.frombuffer(v.as_buffer(), np.uint64) for b in nnpu._features(iter([part])) for v in b["words"]]
    assert [len(w) for w in words] == [7, 2, 0] and all((np.diff(w) > 0).all() for w in words[:1])


def test_repeated_rows_keep_one_by_all_columns(spark):
    text = prose(3, 40)
    rows = [(1, text, c) for c in ("b", "a", "c")] + [(None, "", c) for c in ("x", "y")] + [(None, None, "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, two = ({(r["doc_id"], r["lang"]) for r in dart.keep_one(table.repartition(n)).collect()} for n in (1, 3))
    assert one == two and len([r for r in one if r[0] == 1]) == 1 and {r for r in one if r[0] is None} == {(None, "x"), (None, "y"), (None, "z")}


def test_toxicity_learns_and_keeps_folds(spark, docs, empty):
    rng = np.random.default_rng(0)
    rows, labels = [(None, None), (5000, ""), (5000, "")], [(9999, 1), (None, 1), (1, None)]
    for i in range(1200):
        toxic = i % 8 == 0
        text = prose(i, 60) + (" nasty, VILE foul" if toxic else "")
        rows.append((i, text))
        if rng.random() < 0.5:
            labels.append((i, int(toxic)))
    table = spark.createDataFrame([(k, t, 1, 0.0) for k, t in rows], "doc_id long, text string, toxic int, score double")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = nnpu.score_toxicity(table, marks).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    right = [(r["predicted"] == 1) == (r["doc_id"] % 8 == 0) for r in out if r["doc_id"] is not None and r["doc_id"] < 1200]
    assert np.mean(right) > 0.98
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert nnpu.score_toxicity(empty, marks).collect() == []
    assert nnpu.score_toxicity(docs, marks.filter("doc_id < 0"), carry=("source",)).count() == len(ROWS)


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(60, 8))
    near = base[rng.integers(0, 60, 90)] + rng.normal(size=(90, 8)) * 0.08
    vectors = [*base.tolist(), *near.tolist(), base[0].tolist(), (base[1] * 1e200).tolist()]
    odd = [None, [0.0] * 8, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [None] + [1.0] * 7, [1.0, 2.0], []]
    rows = [(i, v, 1) for i, v in enumerate(vectors)] + [(1000 + i, v, 2) for i, v in enumerate(odd)]
    rows += [(5, vectors[5], 3), (None, vectors[6], 4)]
    out = pivots.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links long").repartition(3))
    good = [(k, np.array(v) / np.abs(v).max()) for k, v, _ in rows if v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)]
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    root = np.arange(len(good))
    for _ in range(len(good)):
        root = np.array([min(root[i], *root[link[i]]) if link[i].any() else root[i] for i in range(len(good))])
    ids = {r: min(k for (k, _), x in zip(good, root) if x == r and k is not None) for r in set(root)}
    want = [(k, int(n), ids[r], k == ids[r]) for (k, _), n, r in zip(good, link.sum(axis=1), root)]
    want += [(1000 + i, 0, 1000 + i, True) for i in range(len(odd))]
    assert collected(out, "vec_id", "n_links", "component_id", "kept") == sorted(want, key=repr)
    assert pivots.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_vectors_of_every_width_are_linked(spark):
    rows = [(i, v) for i, v in enumerate([[1.0, 2.0, 3.0]] * 3 + [[1.0, 2.0], [2.0, 4.0], [1.0, 2.0], [-1.0, 1.0], [5.0]])]
    out = pivots.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert collected(out, "vec_id", "n_links", "component_id") == [
        (0, 2, 0), (1, 2, 0), (2, 2, 0), (3, 2, 3), (4, 2, 3), (5, 2, 3), (6, 0, 6), (7, 0, 7)]


def test_pieces_equal_the_library(docs, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = [(k, model.encode(t or "")) for k, t in ROWS]
    out = pieces.encode_pieces(docs, PIECE, with_ids=True)
    assert collected(out, "doc_id", "pieces", "ids_crc32") == sorted([(k, x, crc(x)) for k, x in want], key=repr)
    assert out.filter("NOT round_trip").count() == 0
    back = collected(pieces.decode_pieces(out, PIECE), "doc_id", "text")
    assert back == sorted([(k, (t or "").replace("▁", " ")) for k, t in ROWS], key=repr)
    assert pieces.encode_pieces(empty, PIECE).collect() == []


def test_revisits(spark):
    def record(id_, url, at, kind, etag=None, modified=None, digest=None, headers=None):
        return (id_, url, at, kind, etag, modified, digest, headers, "missing")

    rows = [
        record(1, "http://www.A.com/x/?b=2&a=1&utm_s=q#f", 10, "response", '"e"', "m", "d", {"etag": '"e"', "content-length": "9"}),
        record(2, "https://a.com:443/x?a=1&b=2", 10, "revisit", '"e"'),  # not earlier
        record(3, "https://a.com/x?a=1&b=2", 500_000, "revisit", 'W/"e"', headers={"date": "t", "content-length": "0"}),
        record(4, "a.com/x?a=1&b=2", 20, "revisit", '"other"', "m", "d"),
        record(5, "a.com/x?a=1&b=2", 20, "revisit", None, "m", "z"),
        record(6, "a.com/x?a=1&b=2", 20, "revisit"),
        record(7, None, 20, "revisit", '"e"'), record(8, "a.com/x?a=1&b=2", None, "revisit", '"e"'),
        record(9, "b.com", 20, "revisit", None, None, "d"), record(10, "b.com", 5, "response", digest="d"),
        record(11, "b.com", 5, "response", digest="d"),
    ]
    schema = (
        "record_id long, url string, captured long, kind string, etag string, last_modified string, digest string, "
        "headers map<string,string>, status string"
    )
    for seconds in (86_400, 3):
        out = {r["record_id"]: r for r in revisits.resolve_revisits(spark.createDataFrame(rows, schema), seconds).collect()}
        assert {k: (r["status"], r["response_id"]) for k, r in out.items()} == {
            2: ("missing", None), 3: ("resolved", 1), 4: ("mismatch", 1), 5: ("resolved", 1), 6: ("mismatch", 1),
            7: ("missing", None), 8: ("missing", None), 9: ("resolved", 11),
        }
        assert out[3]["headers"] == {"etag": '"e"', "content-length": "9", "date": "t"} and out[9]["headers"] == {}
    assert revisits.resolve_revisits(spark.createDataFrame([], schema)).collect() == []


def test_blocks_share_hashes():
    offered = blocks.table(
        blocks.offer(np.array([1, 2, 2, 5], np.uint64), 0, 2) + blocks.offer(np.array([1, 7], np.uint64), 3, 2), **blocks._OFFER)
    out = {}
    for part in (offered.filter(blocks.pa.compute.equal(offered["shard"], s)) for s in (0, 1)):
        for row in blocks._shared(part).to_pylist():
            out.setdefault(row["block"], []).extend(np.frombuffer(row["hashes"], np.uint64).tolist())
    assert out == {0: [2, 1], 3: [1]}


def test_encoder_equals_library_on_odd_characters():
    """Pieces, unusual words and special tokens against whole texts in the library, also when the store forgets."""
    library, own, draw = Tokenizer.from_file(BPE), tokens.Encoder(BPE), random.Random(7)
    letters = [*"abcXYZ's'tre019.,|<>-_ \n\t\r\x00\x1c\x7f\x85\xa0\xad²½ªµßÀ×Āİı"]
    letters += ["́", " ", "　", "中", "é", "Σς", "\U0001f600", "<|endoftext|>", "<|", "|>", "'LL"]
    for turn in range(60):
        texts = ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(50)] + [None, ""]
        ids, many = own.encode(texts)
        cut = np.cumsum(many)
        for text, a, b in zip(texts, cut - many, cut):
            assert ids[a:b].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 1]
        if turn % 20 == 10:
            own._forget()
