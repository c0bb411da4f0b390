"""Language by letters: how likely each language makes a text's runs of three letters.

A table of weights is counted in one aggregate over texts of known language. Runs are numbered by their letters and share BUCKETS
weights a language, so that the table has a fixed size and a look-up is a place in an array. Weights are whole numbers (thousandths
of natural logarithms), so that sums don't hang on their order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.functions.text import col, once
from supportlens.sources.sinks import staged

BUCKETS = 8192
#: A language has to be so many times as likely as the next one, in natural logarithms; else the text is undetermined.
MARGIN = 1.0
_UNIT = 1000


def letter_runs(text: Column | str) -> Column:
    """Bucket of each run of three letters of the text in lower case; all that is no letter counts as one blank. None if it has no letters."""
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(col(text)), r"[^\p{L}]+", " "), F.lit(" "))
    letters = F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), F.ascii)
    return F.when(F.rlike(col(text), F.lit(r"\p{L}")), once(letters, _triples)).otherwise(F.array().cast("array<int>"))


def _triples(letters: Column) -> Column:
    after = lambda i: F.slice(letters, F.lit(i + 1), F.greatest(F.size(letters) - i, F.lit(0)))
    triples = F.zip_with(F.zip_with(letters, after(1), lambda a, b: a * 31 + b), after(2), lambda ab, c: (ab * 31 + c) % BUCKETS)
    # The last two letters have no third one: their places come out null.
    return F.array_compact(triples)


def language_table(df: DataFrame, text: Column | str, lang: Column | str) -> DataFrame:
    """lang, bucket, weight: a row for each language and bucket that its texts hold, and one with bucket -1 for all others. Rows without
    a language are left out. The result has at most BUCKETS + 1 rows a language, whatever the number of texts."""
    runs = df.select(col(lang).alias("lang"), F.explode(letter_runs(text)).alias("bucket")).where("lang is not null")
    # Staged: the runs are counted once for the table and its totals.
    counts = staged(runs.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n")), "language-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    every = counts.union(totals.select("lang", F.lit(-1), F.lit(0).cast("bigint"))).join(totals, "lang")
    weight = F.round(_UNIT * F.log((F.col("n") + 1) / (F.col("total") + BUCKETS))).cast("int")
    return every.select("lang", F.col("bucket").cast("int").alias("bucket"), weight.alias("weight"))


def language_weights(table: DataFrame, most: int = 200) -> dict[str, list[int]]:
    """The stored table as arrays by language. ValueError beyond `most` languages."""
    rows = table.limit(most * (BUCKETS + 1) + 1).collect()
    names = sorted({r["lang"] for r in rows})
    if len(names) > most or len(rows) > most * (BUCKETS + 1):
        raise ValueError(f"more than {most} languages")
    other = {r["lang"]: r["weight"] for r in rows if r["bucket"] == -1}
    weights = {lang: [other[lang]] * BUCKETS for lang in names}
    for r in rows:
        if r["bucket"] >= 0:
            weights[r["lang"]][r["bucket"]] = r["weight"]
    return weights


def _array(numbers: Sequence[int]) -> Column:
    """A constant array, without an expression for each of its numbers."""
    return F.expr(f"cast(split('{','.join(map(str, numbers))}', ',') as array<int>)")


def language_by_letters(df: DataFrame, text: Column | str, weights: Mapping[str, Sequence[int]], margin: float = MARGIN) -> DataFrame:
    """Adds language and confidence: the most likely language (of equally likely ones the first by name) and its posterior, all languages
    alike beforehand. 'und' with the same confidence where it isn't e ** margin times as likely as the next one; with 0 if the text is
    null or has no letters. Sums stay within the row."""
    names = sorted(weights)
    runs = df.withColumn("_runs", F.coalesce(letter_runs(text), F.array().cast("array<int>")))
    scored = runs.select(*df.columns, (F.size("_runs") == 0).alias("_none"), F.array(*[_total(weights[lang]) for lang in names]).alias("_sums"))
    sums, best = F.col("_sums"), F.array_max("_sums")
    share = F.lit(1.0) / F.aggregate(sums, F.lit(0.0), lambda s, x: s + F.exp((x - best) / F.lit(float(_UNIT))))
    place = F.array_position(sums, best).cast("int")
    next_ = F.array_max(F.concat(F.slice(sums, F.lit(1), place - 1), F.slice(sums, place + 1, F.lit(len(names)))))
    sure = F.coalesce(best - next_ >= margin * _UNIT, F.lit(True))
    language = F.when(F.col("_none") | ~sure, "und").otherwise(F.element_at(F.array(*map(F.lit, names)), place))
    result = F.struct(language.alias("language"), F.when(F.col("_none"), 0.0).otherwise(share).alias("confidence"))
    return scored.select(*df.columns, F.inline(F.array(result)))


def _total(weights: Sequence[int]) -> Column:
    held = _array(weights)
    return F.aggregate("_runs", F.lit(0).cast("bigint"), lambda s, b: s + F.get(held, b))
