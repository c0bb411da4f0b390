"""Translation of queries by a table of phrases: the best cover of a query by known phrases, other words as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BEST = "array<struct<covered:int,pieces:int,n:int,text:string>>"


def _spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def phrase_entries(phrases: DataFrame) -> DataFrame:
    """phrase, words, translation: rows (original_query, translated_query) by lower-case words, the least of several translations."""
    phrase = F.lower(_spaced(F.col("original_query")))
    kept = phrases.select(phrase.alias("phrase"), F.col("translated_query").alias("translation")).where("phrase <> '' and translation is not null")
    entries = kept.groupBy("phrase").agg(F.min("translation").alias("translation"))
    return entries.select("phrase", F.size(F.split("phrase", " ")).alias("words"), "translation")


def _runs(words: Column, longest: int) -> Column:
    """All runs of up to `longest` words: place of the first, number, text in lower case."""
    count = F.size(words)

    def at(i: Column) -> Column:
        lengths = F.sequence(F.lit(1), F.least(F.lit(longest), count - i + 1))
        return F.transform(lengths, lambda n: F.struct(i.alias("at"), n.alias("n"), F.lower(F.array_join(F.slice(words, i, n), " ")).alias("phrase")))

    return F.flatten(F.transform(F.sequence(F.lit(1), count), at))


def _best_cover(words: Column, hits: Column) -> Column:
    """The words from the last to the first: the best text of each rest of the query, the nearest rest in front."""

    def option(rest: Column, n: Column, covered: Column, pieces: Column, text: Column) -> Column:
        joined = F.when(rest["text"] == "", text).otherwise(F.concat(text, F.lit(" "), rest["text"]))
        return F.struct((rest["covered"] + covered).alias("covered"), (rest["pieces"] - pieces).alias("pieces"), n.alias("n"), joined.alias("text"))

    def step(rests: Column, i: Column) -> Column:
        stays = option(rests[0], F.lit(0), F.lit(0), F.lit(0), F.element_at(words, i))
        here = F.filter(hits, lambda h: h["at"] == i)
        taken = F.transform(here, lambda h: option(F.element_at(rests, h["n"]), h["n"], h["n"], F.lit(1), h["translation"]))
        return F.concat(F.array(F.array_max(F.concat(F.array(stays), taken))), rests).cast(_BEST)

    none = F.array(F.struct(F.lit(0).alias("covered"), F.lit(0).alias("pieces"), F.lit(0).alias("n"), F.lit("").alias("text"))).cast(_BEST)
    return F.aggregate(F.reverse(F.sequence(F.lit(1), F.size(words))), none, step, lambda rests: rests[0]["text"])


def translate_phrases(queries: DataFrame, phrases: DataFrame, query: str = "original_query") -> DataFrame:
    """Adds translated_query: phrases of the table in their translation, other words as they are.

    Of all covers of a query by phrases that don't overlap the one with the most words covered is taken, then that with the fewest
    phrases, then that with the longer phrase first. A query that is an entry itself is thus translated whole. Case and spacing don't
    count in the comparison; a query without any phrase stays as it is. Each different query is cut once, its runs of words meet the
    table in one join, and its cover is found within its row: work grows with the square of a query's words.
    """
    entries = phrase_entries(phrases)
    longest = entries.agg(F.max("words")).first()[0] or 0
    if not longest:
        return queries.withColumn("translated_query", F.col(query))
    words = F.split(_spaced(F.col("_query")), " ")
    different = queries.select(F.col(query).alias("_query")).where("_query is not null").distinct()
    runs = different.select("_query", F.inline(_runs(words, longest)))
    met = runs.join(entries, "phrase").groupBy("_query").agg(F.collect_list(F.struct("at", "n", "translation")).alias("_hits"))
    done = met.select("_query", _best_cover(words, F.col("_hits")).alias("_translated"))
    joined = queries.join(done, F.col(query) == F.col("_query"), "left")
    return joined.withColumn("translated_query", F.coalesce("_translated", query)).drop("_query", "_translated")
