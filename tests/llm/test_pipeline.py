"""Every stage of the document pipeline against a plain version, on real rows with nulls, empty texts and repeats."""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("vacantia.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from test_operators import BPE, WORD, weighted_classes  # noqa: E402
from vacantia.llm import nnpu  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]


def base_fails(text):
    w = WORD.findall(text or "")
    runs = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if runs[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(w) < 50 or 100 * len(again) > 50 * len(w)


def without_repeats(rows):
    low = lambda k: -(1 << 63) if k is None else k
    words = [WORD.findall(r[1] or "") for r in rows]
    first: dict = {}
    for r, w in zip(rows, words):
        for i in range(len(w) - 12):
            x = tuple(w[i : i + 13])
            first[x] = min(first.get(x, low(r[0])), low(r[0]))
    out = []
    for r, w in zip(rows, words):
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < low(r[0]) for j in range(i, i + 13)}
        out.append((r[0], " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def test_every_stage(spark, tmp_path):
    stored = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = next(t for _, t, *_ in rows_of(stored) if not base_fails(t))
    planted = [
        (None, clean + " tail of a text without an id", "en", "src0", 1), (900001, None, "en", None, 0), (900002, "", None, "src1", 0),
        (900003, clean, "en", "src2", 5), (900003, clean, "en", "src2", 5), (900004, clean, "fr", "other", 6),
    ]
    docs = stored.unionByName(spark.createDataFrame(planted, stored.schema)).repartition(3)
    work = dict(corpus_pipeline.STAGES)
    assert list(work) == ["toxicity", "quality_rules", "near_dedup", "substring_dedup", "packing"]

    def run(name, df):
        path = str(tmp_path / name)
        work[name](spark, df, SF_DIR).write.parquet(path)
        return spark.read.parquet(path)

    kept = run("toxicity", docs)
    marks = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    toxic = Counter((r["doc_id"]) for r in nnpu.score_toxicity(docs, marks).filter("predicted = 1").collect())
    assert kept.columns == docs.columns and Counter(r[0] for r in rows_of(kept)) == Counter(r[0] for r in rows_of(docs)) - toxic

    good = run("quality_rules", kept)
    assert Counter(rows_of(good)) == Counter(r for r in rows_of(kept) if not base_fails(r[1]))  # no host stands out here

    one = run("near_dedup", good)
    before = rows_of(good)
    root = weighted_classes([(r[0], r[1]) for r in before])
    least: dict = {}
    for r, c in zip(before, root):
        least[c] = min(least.get(c, (True, 0)), (r[0] is None, r[0] or 0))
    assert Counter((r[0] is None, r[0] or 0) for r in rows_of(one)) == Counter(least.values())
    assert set(rows_of(one)) <= set(before)

    rest = run("substring_dedup", one)
    assert Counter((r[0], r[1]) for r in rows_of(rest)) == Counter(without_repeats(rows_of(one)))
    assert all(r[4] == len(r[1]) for r in rows_of(rest)) and rest.columns == docs.columns

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE)
    ids = {(r[0], r[1]): [*tokenizer.encode(r[1], add_special_tokens=False).ids, 1] for r in rows_of(rest)}
    pieces = run("packing", rest).collect()
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    assert sum(r["length"] for r in pieces) == sum(map(len, ids.values()))
    by_doc = {k: v for (k, _), v in ids.items()}
    for r in pieces:
        own = by_doc[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == crc(own[r["start"] : r["start"] + r["length"]])
    spot: dict = {}
    for r in pieces:
        spot.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in spot.values():
        own.sort()
        assert [a for a, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))] and sum(n for _, n in own) <= 2048


def test_run_is_the_stages_one_after_another(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    assert not re.search("Python|Arrow", out._jdf.queryExecution().executedPlan().toString())  # read from the last table
