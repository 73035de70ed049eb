"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positive class; text at large, taken without its labels, is a mixture
with the class prior as its share of toxic text.  A linear model over the words of a text is trained in
numpy on the class-prior-corrected risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

so that toxic texts among the unlabelled ones aren't held against the model.  Only the fit uses a
bounded sample (``MAX_POSITIVE``, ``MAX_UNLABELLED`` texts of ``MAX_WORDS`` words); the prior comes from all usable labels and every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm.rolling import BASE, CODES, mix, prefix, spans, texts_of
from vacantia.llm.workers import tidy
from vacantia.operators.rows import keep_first

MAX_POSITIVE, MAX_UNLABELLED = 6_000, 18_000
MAX_WORDS = 1024  # distinct words of a text that the fit sees, chosen by their hashes
THRESHOLD = 0.3

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words_of(t) -> tuple[np.ndarray, np.ndarray]:
    """(text, word) for the distinct words of some texts: runs of letters, ASCII in lower case."""
    solid = _LETTER[t.data]
    edge = np.zeros(len(t.data) + 1, bool)
    edge[t.offsets] = True
    before, after = np.append(False, solid), np.append(solid, False)
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    word = spans(prefix(CODES[_LOWER[t.data]], BASE), start, end, BASE)
    doc = np.searchsorted(t.offsets, start, "right") - 1
    order = np.lexsort((word, doc))
    doc, word = doc[order], word[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])
    return doc[new], word[new]


def _features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for t in texts_of(part["text"]):
            doc, word = words_of(t)
            order = np.lexsort((mix(word), doc))
            first = np.searchsorted(doc, doc)
            use = np.sort(order[np.arange(len(doc)) - first < MAX_WORDS])
            doc, word = doc[use], word[use]
            raw, cut = word.tobytes(), 8 * np.searchsorted(doc, np.arange(len(t) + 1))
            yield pa.record_batch({
                "positive": part["positive"].slice(t.first, len(t)),
                "words": pa.array([raw[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            })


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 300,
        rate: float = 0.1, penalty: float = 2e-4, least: int = 5, clear: float = 4.0) -> tuple[np.ndarray, np.ndarray, float]:
    """(words, weights, bias) of the model, from the distinct words of each text.

    Words in fewer than ``least`` texts, or whose shares among positive and unlabelled texts differ by
    fewer than ``clear`` standard errors, get no weight.
    """
    n_p, n_u = len(positive), len(unlabelled)
    odds = float(np.log(prior / (1 - prior)))
    if not n_p or not n_u:
        return np.zeros(0, np.uint64), np.zeros(0), odds
    texts = positive + unlabelled
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    words, column = np.unique(np.concatenate(texts), return_inverse=True)
    in_p = np.bincount(column[doc < n_p], minlength=len(words))
    in_u = np.bincount(column[doc >= n_p], minlength=len(words))
    share = (in_p + in_u) / (n_p + n_u)
    error = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u)) + 1e-12
    use = (in_p + in_u >= least) & (np.abs(in_p / n_p - in_u / n_u) > clear * error)
    if not use.any():
        return np.zeros(0, np.uint64), np.zeros(0), odds
    keep = use[column]
    doc, column, words = doc[keep], (np.cumsum(use) - 1)[column[keep]], words[use]
    weight, bias = np.zeros(len(words)), odds
    moment, speed = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    pos = np.arange(len(texts)) < n_p
    for step in range(1, steps + 1):
        z = bias + np.bincount(doc, weight[column], len(texts))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        negative = np.logaddexp(0, z)  # loss of calling a text clean, for the logistic loss
        rest = negative[~pos].mean() - prior * negative[pos].mean()
        clean = np.where(pos, -prior * p / n_p, p / n_u)
        # a negative estimate means overfitting: the step undoes it instead of going on
        push = np.where(pos, prior * (p - 1) / n_p, 0) + clean if rest >= 0 else -clean
        grad = np.append(np.bincount(column, push[doc], len(words)) + penalty * weight, push.sum())
        moment, speed = 0.9 * moment + 0.1 * grad, 0.999 * speed + 0.001 * grad**2
        move = rate * (moment / (1 - 0.9**step)) / (np.sqrt(speed / (1 - 0.999**step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - move[-1]
    # Undone steps move the bias; the mean score of text at large has to be the prior.
    z = np.bincount(doc, weight[column], len(texts))[n_p:]
    low, high = -40.0, 40.0
    for _ in range(60):
        bias = (low + high) / 2
        low, high = (bias, high) if (1 / (1 + np.exp(-np.clip(z + bias, -30, 30)))).mean() < prior else (low, bias)
    return words, weight, float(bias)


def _scores(words: np.ndarray, weights: np.ndarray, bias: float, text: str = "text"):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            z = np.zeros(part.num_rows)
            for t in texts_of(part[text]):
                doc, word = words_of(t)
                if len(words):
                    at = np.minimum(np.searchsorted(words, word), len(words) - 1)
                    z[t.first : t.first + len(t)] = np.bincount(doc, np.where(words[at] == word, weights[at], 0), len(t))
            score = 1 / (1 + np.exp(-np.clip(z + bias, -30, 30)))
            kept = part.drop_columns(["text"]) if text == "text" else part
            yield kept.append_column("score", pa.array(score))
    return work


def fold(id_column: Column, folds: int = 4) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(folds))


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", held_out: int = 2,
) -> tuple[np.ndarray, np.ndarray, float]:
    """The model from rows outside the held-out fold.

    One text of each id is used (the first by a digest of the text), with at most ``MAX_WORDS`` of its words.
    Positives are texts labelled 1, at most ``MAX_POSITIVE`` of them, chosen by a hash of the id; the
    unlabelled ones are drawn from all texts of the training folds, at most ``MAX_UNLABELLED``, so that they hold
    toxic texts in proportion to the prior, as the risk assumes.
    """
    usable = F.coalesce(fold(F.col("id")) != held_out, F.lit(False))
    known = labels.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("label"))
    known = known.filter(usable & F.col("label").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
    n, n_pos = known.agg(F.count("*"), F.sum(F.when(F.col("label") == 1, 1).otherwise(0))).first()
    prior = min(max((n_pos or 0) / n, 0.001), 0.9) if n else 0.05
    by_hash = F.xxhash64("id")
    p = known.filter("label = 1").orderBy(by_hash, "id").limit(MAX_POSITIVE).select("id", F.lit(True).alias("positive"))
    ids = docs.select(F.col(id_column).cast("long").alias("id")).filter(usable).distinct()
    u = ids.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(MAX_UNLABELLED).select("id", F.lit(False).alias("positive"))
    chosen = p.union(u)  # bounded by the two limits above
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").cast("binary").alias("text"))
    one = keep_first(texts.join(F.broadcast(chosen), "id"), ["id", "positive"], [F.xxhash64("text"), F.col("text")])
    sample = one.select("positive", "text").mapInArrow(tidy(_features), "positive boolean, words binary").toArrow()
    positive = sample["positive"].to_numpy()
    words = [np.frombuffer(v.as_buffer(), np.uint64) for v in sample["words"]]
    return fit([w for w, k in zip(words, positive) if k], [w for w, k in zip(words, positive) if not k], prior)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", held_out: int = 2, carry: tuple[str, ...] = (), with_text: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``score`` (0 to 1) and ``predicted`` (score >= 0.3).

    Null and empty texts get the score of a text without words.  A null id is in no fold: not held out and
    not learned from.  Several labels of one id count as toxic if one does; labels without a document
    count for the prior only.  Repeated rows get equal scores.  With no positive label at all the score is the prior.
    """
    model = train(docs, labels, id_column, text_column, label_column, held_out)
    names = [f"carry_{i}" for i in range(len(carry))] + ["keep_text"] * with_text
    rows = docs.select(
        F.col(id_column).alias("id"), *[F.col(c).alias(n) for c, n in zip([*carry, text_column], names)],
        F.col(text_column).cast("string").cast("binary").alias("text"),
    )
    kinds = dict(rows.dtypes)
    scored = "text"
    if kinds.get("keep_text") == "string":  # the text that is kept is scored, so that no text is sent twice
        rows, scored = rows.drop("text"), "keep_text"
    schema = ", ".join([f"{c} {kinds[c]}" for c in ["id", *names]] + ["score double"])
    out = rows.mapInArrow(tidy(_scores(*model, scored)), schema)
    return out.select(
        F.col("id").alias(id_column), *[F.col(n).alias(c) for c, n in zip([*carry, text_column], names)],
        F.coalesce(fold(F.col("id")) == held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
