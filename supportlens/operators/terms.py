"""Daily word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.text import lower_token, lower_tokens, title_and_body, tokens


def term_counts(texts: DataFrame, day: Column, text: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Uses of each term a day, every occurrence counted, ignored terms left out.

    A map-side count precedes the shuffle, so a common word is one row a task.
    """
    terms = texts.select(day.alias("tweet_dt"), F.explode(tokens(text)).alias("token"))
    terms = terms.select("tweet_dt", lower_token("token").alias("tweet_word"))
    kept = terms.where(~F.col("tweet_word").isin(list(ignore))) if ignore else terms
    return kept.groupBy("tweet_dt", "tweet_word").agg(F.count("*").alias("tweet_freq"))


def top_terms(counts: DataFrame, n: int) -> DataFrame:
    """The n most used terms over all days."""
    total = counts.groupBy("tweet_word").agg(F.sum("tweet_freq").alias("tweet_freq"))
    return total.orderBy(F.desc("tweet_freq"), "tweet_word").limit(n)


def term_summaries(counts: DataFrame, size: int = 500) -> DataFrame:
    """Each day's `size` most used terms (tweet_dt, tweet_word, tweet_freq) with `bound`, the count of the day's first term left out.

    A term that a day's summary lacks was used at most `bound` times on that day. A summary is small whatever the day holds, and those
    of any days can be taken together. Below Spark's group limit (1000) the other terms are dropped before the shuffle.
    """
    by_day = Window.partitionBy("tweet_dt")
    ranked = counts.withColumn("place", F.row_number().over(by_day.orderBy(F.desc("tweet_freq"), "tweet_word"))).where(F.col("place") <= size + 1)
    bound = F.coalesce(F.max(F.expr(f"case when place = {size + 1} then tweet_freq end")).over(by_day), F.lit(0))
    return ranked.withColumn("bound", bound).where(F.col("place") <= size)


def summary_candidates(summaries: DataFrame, n: int) -> DataFrame | None:
    """The terms that can be among the n most used over the summaries' days, or None if the summaries don't tell.

    A term's uses lie between the sum of its summaries' counts and that sum with the bounds of the days that lack it. The n-th largest
    lower end is passed by the upper end of every term of the result. If the bounds of all days together stay below it, no term
    outside all summaries gets there.
    """
    reach = summaries.agg(F.sum(F.expr("case when place = 1 then bound end")).alias("outside"))
    ends = summaries.groupBy("tweet_word").agg(F.sum("tweet_freq").alias("low"), F.sum("bound").alias("seen"))
    first = ends.orderBy(F.desc("low")).limit(n).agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("found"))
    outside, (least, found) = reach.first()[0], first.first()
    if outside is None or (outside > 0 and (found < n or outside >= least)):
        return None
    return ends.where(F.col("low") - F.col("seen") + F.lit(outside) >= F.lit(least)).select("tweet_word")


def top_terms_merged(summaries: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """`top_terms` of the days that both frames hold: candidates by the summaries, counted exactly; if the summaries don't part them
    from the rest, all terms are counted."""
    candidates = summary_candidates(summaries, n)
    return top_terms(counts if candidates is None else counts.join(candidates, "tweet_word", "left_semi"), n)


def keyword_counts(
    questions: DataFrame,
    text_terms: Sequence[str] = tuple(values.ANTIVIRUS_TERMS),
    meta_terms: Sequence[str] = tuple(values.OS_TERMS),
    phrases: bool = False,
) -> DataFrame:
    """Questions a day that name a keyword, each question once a keyword.

    Keywords equal whole tokens, so one of several words never counts; phrases=True looks for those in the text itself.
    """

    def named(text: Column, terms: Sequence[str]) -> Column:
        found = F.array_intersect(lower_tokens(text), F.array(*[F.lit(t) for t in terms]))
        spaced = [t for t in terms if " " in t]
        if phrases and spaced:
            hits = [F.when(F.contains(F.lower(text), F.lit(t)), F.lit(t)) for t in spaced]
            found = F.array_union(found, F.array_compact(F.array(*hits)))
        return F.coalesce(found, F.array().cast("array<string>"))

    body = title_and_body("question_content", "title")
    words = F.concat(named(body, text_terms), named(F.col("metadata_array"), meta_terms))
    named_words = questions.select(F.to_date("created_date").alias("forum_dt"), F.explode(words).alias("forum_word"))
    return named_words.groupBy("forum_dt", "forum_word").agg(F.count("*").alias("forum_freq"))
