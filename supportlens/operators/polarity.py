"""Sentiment by sentence, with polar words learned from seeds.

A word is polar if it stands in sentences with positive seeds clearly more often, or less, than in sentences with negative ones. The
table of polar words is counted in one aggregate over the sentences and stored; texts are scored by a join of their words to it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.sentiment import sentences, sentiment_bin, with_negation, words
from supportlens.functions.text import col
from supportlens.sources.sinks import staged

#: Sentences with seeds that a word is in at least, and least polarity, in thousandths.
LEAST_SENTENCES, LEAST_POLARITY = 5, 200


def polar_words(
    df: DataFrame, text: Column | str, positive: Sequence[str] = values.POSITIVE_WORDS, negative: Sequence[str] = values.NEGATIVE_WORDS,
    least: int = LEAST_SENTENCES, bound: int = LEAST_POLARITY,
) -> DataFrame:
    """word, polarity (thousandths, -1000 to 1000). With a and b a word's rates among the sentences with positive and with negative seeds
    (one added to each count), its polarity is (a - b) / (a + b), the hyperbolic tangent of half its difference of pointwise mutual
    information. Seeds are 1000 and -1000, whether they occur or not; words of sentences without seeds tell nothing."""
    spoken = df.select(F.explode(sentences(text)).alias("_s")).select(F.array_distinct(words("_s")).alias("_words"))
    seeded = lambda seeds: F.arrays_overlap("_words", F.array(*map(F.lit, seeds)).cast("array<string>")).cast("long")
    flagged = spoken.select("_words", seeded(positive).alias("up"), seeded(negative).alias("down")).where("up + down > 0")
    # The totals go through the same aggregate under a name that is no word; staged, so that the sentences are read once for the three uses.
    counted = flagged.select(F.explode(F.array_append("_words", "")).alias("word"), "up", "down").groupBy("word").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    counted = staged(counted, "polar-counts")
    total = lambda side: counted.where("word = ''").select(side).scalar()
    rated = counted.where("word <> ''")
    a, b = (F.col("up") + 1) / (total("up") + 1), (F.col("down") + 1) / (total("down") + 1)
    polarity = F.round(1000 * (a - b) / (a + b)).cast("int")
    seeds = [*positive, *negative]
    learned = rated.where((F.col("up") + F.col("down") >= least) & ~F.col("word").isin(seeds)).select("word", polarity.alias("polarity"))
    fixed = df.sparkSession.createDataFrame([(w, 1000) for w in dict.fromkeys(positive)] + [(w, -1000) for w in dict.fromkeys(negative) if w not in positive], "word string, polarity int")
    return learned.where(F.abs("polarity") >= bound).union(fixed)


def score_sentences(df: DataFrame, text: Column | str, polarity: DataFrame, key: str, negators: Sequence[str] = values.NEGATORS) -> DataFrame:
    """Adds score, magnitude and discrete_sentiment. A sentence's score is the mean polarity of its polar words, turned where they are
    negated; score is the mean over the sentences that have polar words, magnitude the sum of their absolute scores. No polar word, or a
    null text: 0 and 0.

    key: a column without nulls that tells the rows apart. Words are summed by sentence within their task, so that one row a sentence
    is shuffled, not its words.
    """
    spoken = df.select(F.col(key).alias("_key"), F.posexplode(sentences(text)).alias("_at", "_s"))
    said = spoken.select("_key", "_at", F.explode(with_negation(words("_s"), negators)).alias("_w")).select("_key", "_at", "_w.*")
    signed = F.when(F.col("negated"), -F.col("polarity")).otherwise(F.col("polarity"))
    # Whole millionths, rounded to the next one, so that sums don't hang on their order.
    mean = lambda total: F.floor((2 * total + F.count(F.lit(1))) / (2 * F.count(F.lit(1))))
    by_sentence = said.join(polarity, "word").groupBy("_key", "_at").agg(mean(1000 * F.sum(signed)).alias("_score"))
    by_text = by_sentence.groupBy("_key").agg((mean(F.sum("_score")) / 1e6).alias("score"), (F.sum(F.abs("_score")) / 1e6).alias("magnitude"))
    scored = df.join(by_text.withColumnRenamed("_key", key), key, "left").fillna(0.0, ["score", "magnitude"])
    return scored.select(*df.columns, "score", "magnitude", sentiment_bin("score", "magnitude").alias("discrete_sentiment"))


def sentences_step(polarity: DataFrame, key: str) -> Callable[[DataFrame, Column], DataFrame]:
    """A sentiment step for `enrich.enrich_tweets` and `enrich_questions`."""
    return lambda df, text: score_sentences(df, text, polarity, key)
