"""Whitening, vector codes and decontamination against brute force, on rows with nulls, ties, repeats and other widths."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

pytest.importorskip("vacantia.llm")

from pyspark.sql import functions as F  # noqa: E402

from vacantia.llm import codes, containment, whitening  # noqa: E402

BAD = [None, [], [1.0, None] * 4, [float("nan")] * 8, [float("inf")] + [0.0] * 7]


def vectors(spark, rows):
    """Extra columns are named like results and helpers of the operators."""
    data = [(k, v, g, 1, "c", 2.5) for k, v, g in rows]
    kinds = "vec_id long, embedding array<float>, label int, component int, code string, error double"
    return spark.createDataFrame(data, kinds).repartition(3)


def some_vectors(n: int, width: int, seed: int = 0, tight: bool = False):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, width)) * (0.01 if tight else 0.2) + rng.integers(0, 5, (n, 1)) * 0.3
    return [(int(k), [float(np.float32(c)) for c in r], int(k) % 4 or None) for k, r in zip(rng.permutation(n), rows)]


# --- Whitening -------------------------------------------------------------------------------

def test_components_are_those_of_dense_matrices():
    rng = np.random.default_rng(3)
    spectra = {
        "flat": np.ones(24), "falling": 1 / np.arange(1, 91.0) ** 3, "steps": np.repeat([5.0, 3.0, 3.0 - 1e-7, 1.0, 0.0], 12),
        "close": 1 + 1e-6 * np.arange(50), "one": np.array([2.0]), "low rank": np.r_[np.ones(3), np.zeros(37)],
    }
    for name, e in spectra.items():
        q = np.linalg.qr(rng.standard_normal((len(e), len(e))))[0]
        v = (q * e) @ q.T
        v = (v + v.T) / 2
        values, basis = whitening.components(v, 32)
        want = np.sort(e)[::-1][:32]
        want = want[want > 1e-9]
        assert len(values) == len(want) and np.allclose(values, want, rtol=1e-9, atol=0), name
        assert np.abs(basis.T @ basis - np.eye(len(values))).max() < 1e-12 and np.abs(v @ basis - basis * values).max() < 1e-12, name
    assert whitening.components(np.zeros((5, 5)))[1].shape == (5, 0)


def test_inertia_counts_the_eigenvalues_above():
    rng = np.random.default_rng(4)
    v = rng.standard_normal((30, 30))
    v = v + v.T
    values, form = np.linalg.eigvalsh(v), whitening.tridiagonal(v)
    for t in np.linspace(values[0] - 1, values[-1] + 1, 57):
        assert whitening.inertia(form, t) == (values > t).sum()


def test_a_missed_eigenvalue_is_an_error():
    v = np.diag([4.0, 3.0, 2.0, 1.0])
    with pytest.raises(ArithmeticError):
        whitening.in_circle(v, 1.5, 3.5, 3, 4.0)  # two lie there


@pytest.mark.parametrize("width", [5, 40])
def test_whitening_against_brute_force(spark, width):
    good = some_vectors(120, width) + [(7, [0.25] * width, None), (7, [0.25] * width, None), (None, [0.5] * width, 1)]
    got = whitening.whiten(vectors(spark, good + [(900 + i, v, 1) for i, v in enumerate(BAD)])).collect()
    x = np.floor(64 * np.array([v for _, v, _ in good], np.float64)).astype(np.int64) + 1000000
    n, s = len(x), x.sum(axis=0)
    e, u = np.linalg.eigh(np.cov(x.T, bias=True))
    e, u = e[::-1], u[:, ::-1]
    k = min(32, width)
    want = ((x - s / n) @ u[:, :k]) / np.sqrt(e[:k])
    assert len(got) == n * k and {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    for c in range(k):
        of = [r for r in got if r["component"] == c + 1]
        assert abs(of[0]["explained"] - e[c] / e.sum()) < 1e-9
        key = lambda t: (repr(t[0]), t[1])
        mine = sorted(((r["vec_id"], int(r["deviation"]), r["whitened"]) for r in of), key=key)
        dev = ((n * x - s) ** 2).sum(axis=1)
        theirs = sorted(((g[0], int(d), w) for g, d, w in zip(good, dev, want[:, c])), key=key)
        assert [m[:2] for m in mine] == [t[:2] for t in theirs]
        a, b = np.array([m[2] for m in mine]), np.array([t[2] for t in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_whitening_of_few_equal_and_mixed_rows(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, v, 1) for v in BAD])).count() == 0
    assert whitening.whiten(vectors(spark, [(i, [1.0, 2.0], 1) for i in range(4)])).count() == 0  # no direction varies
    two = [(1, [0.0, 1.0], 1), (2, [1.0, 1.0], 1)]
    wide = [(k, v, g) for k, v, g in some_vectors(9, 6)]
    got = whitening.whiten(vectors(spark, two + wide))
    assert {(r["vec_id"], r["n"]) for r in got.filter("n = 2").collect()} == {(1, 2), (2, 2)}
    assert sorted(abs(r["whitened"]) for r in got.filter("n = 2").collect()) == [1.0, 1.0]
    assert got.filter("n = 9").count() == 9 * 6


def test_deviations_beyond_a_long_are_exact():
    x = np.array([[3_000_000_000, -5], [7, 9]], np.int64)
    near, n = np.array([1_500_000_000, 2], np.int64), 10**12
    rest = [n // 3, -n // 7]
    s = [n * int(m) + r for m, r in zip(near, rest)]
    want = [sum((n * int(c) - t) ** 2 for c, t in zip(row, s)) for row in x]
    if max(want) < 10**38:
        assert [int(v) for v in whitening._deviations(x, near, rest, n).to_pylist()] == want
    small = np.array([[12, 3], [1, 2]], np.int64)
    near = np.array([4, 2], np.int64)
    s = [n * int(m) + r for m, r in zip(near, rest)]
    want = [sum((n * int(c) - t) ** 2 for c, t in zip(row, s)) for row in small]
    assert [int(v) for v in whitening._deviations(small, near, rest, n).to_pylist()] == want


# --- Vector codes ----------------------------------------------------------------------------

def plain_codes(rows, entries=256, rounds=4):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(1024 * np.array([r[1] for r in order], np.float64)).astype(np.int64)
    parts = np.split(x, 4, axis=1)
    books = [p[:entries].copy() for p in parts]

    def nearest(p, book):
        d = ((p[:, None, :] - book[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for p, book in zip(parts, books):
            code, _ = nearest(p, book)
            for e in np.unique(code):
                book[e] = p[code == e].sum(axis=0) // (code == e).sum()
    found = [nearest(p, b) for p, b in zip(parts, books)]
    error = sum(d for _, d in found)
    label: dict = {}
    for r, d in zip(order, error.tolist()):
        label[r[2]] = label.get(r[2], 0) + d
    seal = hashlib.sha256(",".join(str(c) for b in books for e in b.tolist() for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{found[p][0][i]:02x}" for p in range(4)), int(error[i]), label[r[2]], seal)
                   for i, r in enumerate(order)), key=repr)


@pytest.mark.parametrize("n,width,tight,entries", [(700, 16, False, 256), (700, 8, True, 60), (40, 8, False, 256), (3, 4, False, 2)])
def test_codes_against_brute_force(spark, n, width, tight, entries):
    good = some_vectors(n, width, n, tight)
    good += [(good[0][0], good[1][1], None), (None, good[2][1], 3), (good[0][0], good[0][1], 1)]  # repeated and null ids
    good += [(5000 + i, good[0][1], 2) for i in range(n // 3)]  # a third of all rows are equal
    rows = good + [(9000 + i, v, 1) for i, v in enumerate(BAD)]
    got = codes.encode_vectors(vectors(spark, rows), entries=entries)
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == plain_codes(good, entries)


def test_codes_of_large_components_and_of_none(spark):
    big = [(k, [float(np.float32(c * 3e4)) for c in v], g) for k, v, g in some_vectors(300, 8, 5)]  # beyond exact doubles
    got = codes.encode_vectors(vectors(spark, big))
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got.collect()), key=repr) == [r[:3] for r in plain_codes(big)]
    assert codes.encode_vectors(vectors(spark, [])).count() == 0
    with pytest.raises(ValueError):
        codes.encode_vectors(vectors(spark, [(1, [1.0] * 6, 1)]))
    with pytest.raises(Exception, match="do not fit a long"):
        codes.encode_vectors(vectors(spark, [(1, [3e9] * 8, 1), (2, [0.0] * 8, 1)])).collect()


def test_bounds_hold_while_entries_move():
    """No listed or outer bound exceeds the distance it bounds, and the first entry is the nearest."""
    rng = np.random.default_rng(8)
    x = rng.integers(-500, 500, (400, 6)).astype(float)
    entries = rng.integers(-500, 500, (64, 6))
    ids, low = codes.list_entries(codes.Codebook(entries, 2000), x, 16)
    skipped = 0
    for b in (16, 9, 9, 4):
        new = entries + rng.integers(-12, 13, entries.shape)
        moved = np.sqrt(((new - entries) ** 2).sum(axis=1)) * (1 + 1e-12)
        entries = new
        book = codes.Codebook(entries, 2000)
        ids, low, depth = codes.next_lists(book, x, ids, low, moved, b)
        true = np.sqrt(book.all(x))
        assert (ids[:, 0] == book.all(x).argmin(axis=1)).all() and ids.shape == low.shape == (400, b)
        assert (low[:, :-1] <= np.take_along_axis(true, ids[:, 1:].astype(int), 1)).all()
        rest = true.copy()
        np.put_along_axis(rest, ids.astype(int), np.inf, 1)
        assert (low[:, -1] <= rest.min(axis=1)).all() and (np.diff(low[:, :-1], axis=1) >= 0).all()
        skipped += (depth < b).sum()
    assert skipped > 0


# --- Decontamination -------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_hits(docs, items, window=10):
    grams: dict = {}
    for k, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add("" if k is None else str(k))
    out = []
    for k, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if (own := grams.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= own
        seal = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((k, len(w), len(hit), len(found), seal))
    return sorted(out, key=repr)


def prose(seed, n, size=400):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{rng.integers(0, size)}" for _ in range(n))


def found_hits(spark, docs, items):
    d = spark.createDataFrame([(k, t, 1, "x", []) for k, t in docs], "doc_id long, text string, uid int, item string, spans array<int>")
    b = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, key int")
    got = containment.contaminated_words(d.repartition(3), b.repartition(2))
    out = got.withColumn("seal", containment.digest_of_items(F.col("items")))
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), r["seal"]) for r in out.collect()]
    assert all(r["n_hit"] == sum(s["last"] - s["first"] for s in r["spans"]) for r in got.collect())
    return sorted(rows, key=repr)


def test_hits_against_brute_force(spark):
    passage, other, few = prose(1, 40), prose(2, 25), prose(3, 10)
    items = [(1, passage), (2, other.upper()), (3, few), (3, "Zürich ab-cd 7"), (None, "lone"), (5, None), (6, " ,;! "), (7, "of the"),
             (8, passage), (9, " ".join(passage.split()[5:25])), (10, "same same same same same same same same same same same")]
    docs = [
        (1, None), (2, ""), (3, passage), (3, passage), (None, "x " + other.replace(" ", ", ") + " y"), (4, few[: few.rfind(" ")]),
        (5, "zÜrich AB CD\n7"), (6, "zürich ab.cd 7"), (7, "it is of, the LONE end"), (8, prose(9, 3000, 60)), (9, "same " * 40),
        (10, prose(4, 200) + " " + " ".join(passage.split()[3:14]) + " " + prose(5, 50)), (11, " ".join(passage.split()[:9])),
        (12, passage + " " + passage + " " + other), (13, "\x00 \x7f`@[/" * 50), (14, "y" * 30000 + " " + few),
    ]
    assert found_hits(spark, docs, items) == plain_hits(docs, items)


def test_a_passage_of_a_third_of_all_documents(spark):
    passage = prose(1, 30)
    docs = [(i, (prose(100 + i, 20) + " " + passage + " tail") if i % 3 == 0 else prose(100 + i, 25, 50)) for i in range(150)]
    items = [(i, prose(1000 + i, 12, 50)) for i in range(40)] + [(99, passage)]
    assert found_hits(spark, docs, items) == plain_hits(docs, items)


def test_no_items_or_no_documents(spark):
    docs = [(1, "a b c"), (2, None)]
    assert found_hits(spark, docs, []) == plain_hits(docs, [])
    assert found_hits(spark, docs, [(1, None), (2, "...")]) == plain_hits(docs, [])
    assert found_hits(spark, [], [(1, "a b c")]) == []


def test_a_full_bitmap_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(containment, "MAX_BITS", 1 << 15)
    docs = [(i, prose(i, 60, 3000)) for i in range(40)]
    items = [(i, prose(i, 60, 3000)) for i in range(0, 300, 7)]
    assert found_hits(spark, docs, items) == plain_hits(docs, items)
    keys = spark.createDataFrame([(int(v),) for v in np.random.default_rng(0).integers(-(1 << 62), 1 << 62, 40000)], "key long")
    bits = containment.bitmap_of(keys)
    assert len(bits.bits) == 1 << 12 and len(bits.among(np.array([r[0] for r in keys.collect()]))) == 40000
