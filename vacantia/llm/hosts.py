"""Quality rules judged per host: DataFrame functions only.

Base counts are computed per text inside its row.  Failures of every rule are summed per host, the rates of
each rule are shrunk with a beta prior fitted to all hosts by moments, and a host is rejected when its rate
lies above the common one by more than a margin with high posterior probability.  The verdict is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.session import stage

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A host is rejected when the posterior of a rate lies above common rate + MARGIN by more than CERTAIN standard deviations.
MARGIN = 0.2
CERTAIN = 3.0
RULES = {
    "words": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
    "lines": "20 * n_dup_lines > n_words",
}


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def base_rules(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` and the base counts of every text (null: none)."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\f\r", "")) > 0)
    rows = docs.select(*keep, text.alias("_text"), words(text).alias("_words"))
    rows = rows.select(
        *[c for c in rows.columns if not c.startswith("_")], "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.when(F.instr("_text", "\n") == 0, F.lit(0)).otherwise(
            F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    )
    # Hash and place of every three-word window share one number (the place is the remainder by the
    # number of words), so sorting plain numbers makes equal windows neighbours; words decide.
    word, n = F.col("_words"), F.size("_words").cast("long")

    def pack(i: Column) -> Column:
        hash_ = F.shiftright(F.xxhash64(word[i], word[i + 1], word[i + 2]), 2)
        return hash_ - F.pmod(hash_, n) + i

    packed = F.when(n >= 4, F.array_sort(F.transform(F.sequence(F.lit(0), F.size(word) - 3), pack)))
    rows = rows.withColumn("_packed", packed)
    sorted_ = F.col("_packed")

    def twin(a: Column, b: Column) -> Column:
        i, j = F.pmod(a, n).cast("int"), F.pmod(b, n).cast("int")
        same = (b - a < n) & (a - i == b - j)
        for k in range(3):
            same = same & (word[i + k] == word[j + k])
        return F.when(same, F.struct(i.alias("a"), j.alias("b")))

    rest = F.slice(sorted_, 2, F.size(sorted_))
    twins = F.filter(F.zip_with(F.slice(sorted_, 1, F.size(rest)), rest, twin), lambda x: x.isNotNull())
    rows = rows.withColumn("_twins", F.when(sorted_.isNotNull(), twins))
    places = F.array_sort(F.array_distinct(F.concat(F.col("_twins.a"), F.col("_twins.b"))))
    rows = rows.withColumn("_places", F.when(F.size("_twins") > 0, places))
    at = F.col("_places")
    covered = F.aggregate(
        F.zip_with(at, F.slice(at, 2, F.size(at)), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))),
        F.lit(0).cast("long"), lambda total, x: total + x,
    )
    rows = rows.withColumn("n_repeat_words", F.when(at.isNull(), F.lit(0).cast("long")).otherwise(covered))
    return rows.drop("_words", "_packed", "_twins", "_places").withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


def host_rates(judged: DataFrame, host: str = "host", rules: dict[str, str] = RULES) -> DataFrame:
    """Documents of every host and, per rule, ``failed``, shrunk ``rate``, the spread of its posterior and the ``common`` rate.

    The beta prior of a rule is fitted by the moments of the hosts' rates; if these do not vary more than
    chance explains (or there is one host only) the prior weighs as much as all documents together, so
    every host gets the common rate.
    """
    hosts = judged.groupBy(host).agg(
        F.count("*").alias("docs"), *[F.count_if(F.expr(rule)).alias(f"failed_{name}") for name, rule in rules.items()])
    wanted = [F.sum("docs"), F.avg(1 / F.col("docs"))]
    for name in rules:
        failed = F.col(f"failed_{name}")
        wanted += [F.sum(failed) / F.sum("docs"), F.var_samp(failed / F.col("docs"))]
    total, inverse, *moments = hosts.agg(*wanted).first()
    columns = []
    for i, name in enumerate(rules):
        mean, spread = (v or 0.0 for v in moments[2 * i : 2 * i + 2])
        noise = mean * (1 - mean)
        between = spread - noise * (inverse or 0.0)
        weight = noise / between - 1 if noise > between > 0 else float(total or 1)
        rate = (F.col(f"failed_{name}") + F.lit(mean * weight)) / (F.col("docs") + F.lit(weight))
        columns += [
            F.col(f"failed_{name}"), rate.alias(f"rate_{name}"),
            F.sqrt(rate * (1 - rate) / (F.col("docs") + F.lit(weight + 1))).alias(f"spread_{name}"), F.lit(mean).alias(f"common_{name}"),
        ]
    return hosts.select(host, "docs", *columns)


def judge_hosts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source",
    margin: float = MARGIN, certain: float = CERTAIN, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Every row of ``docs`` with the base counts, ``base_failed``, ``host_rules`` and ``kept``.

    ``host_rules`` are the rules for which the document's host is rejected: few words, repeated words, symbols, repeated
    lines.  A document is kept if it passes the base rules and its host is rejected for none.  A small host is pulled to the common rate and
    has a wide posterior, so it is not rejected for a few documents.  Null text has no words and fails.  Documents without a
    host are judged by the base rules alone and count for no host.  Repeated rows count each.  An empty table gives an empty result.
    """
    keep = [F.col(id_column).alias("id"), F.col(host_column).cast("string").alias("host")]
    keep += [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    judged = stage(base_rules(docs, F.col(text_column), keep), "judged")
    rates = host_rates(judged.filter("host IS NOT NULL"))
    over = lambda r: F.col(f"rate_{r}") - certain * F.col(f"spread_{r}") > F.col(f"common_{r}") + margin
    rejected = F.filter(F.array(*[F.when(over(r), F.lit(r)) for r in RULES]), lambda r: r.isNotNull())
    out = judged.join(rates.select("host", rejected.alias("host_rules")), "host", "left")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    none = F.array().cast("array<string>")
    return out.select(
        F.col("id").alias(id_column), *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)], *counts,
        F.coalesce("host_rules", none).alias("host_rules"),
        (~F.col("base_failed") & (F.size(F.coalesce("host_rules", none)) == 0)).alias("kept"),
    )
