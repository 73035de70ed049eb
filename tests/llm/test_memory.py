"""What Python workers hold during a task and after it."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from vacantia.llm import dart, nnpu, rolling, tokens, workers


def test_a_batch_becomes_python_texts_a_run_at_a_time():
    texts = ["ab", None, "", "é" * 7, "x" * 50, "y", None, "zz" * 5]
    for column in (pa.array(texts), pa.array(["cut off", *texts]).slice(1)):
        runs = list(tokens.column_runs(column, 12))
        assert [t for *_, own in runs for t in own] == texts
        assert [(a, b) for a, b, _ in runs] == list(zip([0, *(b for _, b, _ in runs)], (b for _, b, _ in runs)))
        assert all(sum(len((t or "").encode()) for t in own[:-1]) <= 12 for *_, own in runs)
        assert len(runs) > 2
    assert list(tokens.column_runs(pa.array([], pa.string()))) == []


def test_a_worker_gives_back_what_a_task_used():
    def work(parts):
        for part in parts:
            rolling.powers(rolling.BASE, 1 << 18)
            yield part

    rolling.powers(rolling.BASE, 1 << 18)
    assert list(workers.tidy(work)(iter([1, 2]))) == [1, 2]
    assert rolling._powers.cache_info().currsize == 0

    def fails(parts):
        rolling.powers(rolling.BASE, 1 << 18)
        raise ValueError("no")
        yield

    with pytest.raises(ValueError):
        list(workers.tidy(fails)(iter([])))
    assert rolling._powers.cache_info().currsize == 0


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_a_kept_text_is_sent_once_and_scored_alike(spark):
    rows = [(1, "kind words for all", "a"), (2, "vile rude words", "b"), (3, None, "c"), (4, "", "d"), (4, "", "d"), (None, "über rude", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(2, 1), (1, 0)], "doc_id long, toxic int")
    kept = nnpu.score_toxicity(docs, labels, carry=("source",), with_text=True)
    plain = nnpu.score_toxicity(docs, labels, carry=("source",))
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=str) == sorted(rows, key=str)
    assert order(kept.drop("text")) == order(plain)
    sent = re.search(r"MapInArrow \w+\(([^)]*)\)", _plan(kept))[1]
    assert [c.split("#")[0].strip() for c in sent.split(",")] == ["id", "carry_0", "keep_text"]
    words, weights = np.unique(nnpu.words_of(next(rolling.texts_of(pa.array(["rude vile"]))))[1]), np.array([1.0, 2.0])
    batch = pa.record_batch({"text": pa.array(["rude", None, "vile words", ""])})
    one = next(nnpu._scores(words, weights, 0.1)(iter([batch])))
    two = next(nnpu._scores(words, weights, 0.1, "keep_text")(iter([batch.rename_columns(["keep_text"])])))
    assert one["score"].equals(two["score"]) and len(set(one["score"].to_pylist())) == 3


def test_wanted_texts_are_not_tested_and_taken_apart_by_one_task(spark):
    rows = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (2, 20, "b"), (None, 30, "c")], "key long, print long, text string")
    wanted = spark.createDataFrame([(7, 2, 20, 1, 1), (8, None, 30, 2, 2)], "uid long, key long, print long, d1 long, d2 long")
    found = dart._texts_of(rows, wanted)
    assert sorted(tuple(r) for r in found.collect()) == [(7, 1, 1, "b"), (7, 1, 1, "b"), (8, 2, 2, "c")]
    assert "BroadcastHashJoin" not in _plan(found)
