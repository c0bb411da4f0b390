"""Text enrichment: language, sentiment and topic columns, and the flows made of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.language import language_by_letters
from supportlens.functions.sentiment import count_in, lexicon_score, sentiment_bin, words
from supportlens.functions.text import cap_text, col, strip_tags, title_and_body
from supportlens.functions.topics import fold, topic_records, topics, words_found

# A step that adds its columns to a frame, given the text column to read.
Step = Callable[[DataFrame, Column], DataFrame]


def detect_language(
    df: DataFrame, text: Column | str, lists: Mapping[str, Sequence[str]] = values.LANGUAGE_WORDS
) -> DataFrame:
    """Adds language and confidence: the list with most words in the whole text, and its share of all listed words.

    Counts stay within the row, so no token is shuffled. No listed word at all gives 'und' with confidence 0; of equal
    counts the earlier list wins.
    """
    counts = [count_in("_words", lists[lang]).alias(f"_n_{lang}") for lang in lists]
    counted = df.withColumn("_words", F.coalesce(words(text), F.array().cast("array<string>")))
    counted = counted.select(*df.columns, *counts)
    names = [f"_n_{lang}" for lang in lists]
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    language = F.when(total == 0, "und")
    for lang, name in zip(lists, names):
        language = language.when(F.col(name) == best, lang)
    confidence = F.when(total == 0, 0.0).otherwise(best / total)
    # As a generated row, so that a filter on the result is not pushed under the counts and made to repeat them.
    result = F.struct(language.alias("language"), confidence.alias("confidence"))
    return counted.select(*df.columns, F.inline(F.array(result)))


def letters_step(weights: Mapping[str, Sequence[int]]) -> Step:
    """A language step by letters; `weights` as counted on texts of known language."""
    return lambda df, text: language_by_letters(df, text, weights)


def filter_language(df: DataFrame, lang: str = "en", confidence: float = 0.8, inclusive: bool = True) -> DataFrame:
    """Rows surely in `lang`, without the two helper columns. Tweets count the bound itself, questions do not."""
    sure = F.col("confidence") >= confidence if inclusive else F.col("confidence") > confidence
    return df.where((F.col("language") == lang) & sure).drop("language", "confidence")


def score_sentiment(
    df: DataFrame,
    text: Column | str,
    positive: Sequence[str] = values.POSITIVE_WORDS,
    negative: Sequence[str] = values.NEGATIVE_WORDS,
) -> DataFrame:
    """Adds score, magnitude and discrete_sentiment by counting the polar words of the whole text."""
    counted = df.withColumn("_words", F.coalesce(words(text), F.array().cast("array<string>"))).select(
        *df.columns, count_in("_words", positive).alias("_up"), count_in("_words", negative).alias("_down")
    )
    score, magnitude = lexicon_score("_up", "_down")
    scored = counted.select(*df.columns, score.alias("score"), magnitude.alias("magnitude"))
    return scored.withColumn("discrete_sentiment", sentiment_bin("score", "magnitude"))


def model_step(
    predict: Callable[[pd.Series], pd.DataFrame] | None,
    schema: str,
    limit: int | None = None,
    loader: Callable[[], Callable[[pd.Series], pd.DataFrame]] | None = None,
) -> Step:
    """A step for a model of the user's own: whole texts in by Arrow batch, the schema's columns out. Only a caller whose
    model takes texts of limited length gives a limit. With `loader` in place of predict, the model is made once a task."""

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = predict if loader is None else loader()
        for texts in batches:
            yield model(texts)

    def step(df: DataFrame, text: Column) -> DataFrame:
        given = text if limit is None else cap_text(text, limit)
        return df.withColumn("_out", run(given)).select(*df.columns, "_out.*")

    return step


def model_language(
    predict: Callable[[pd.Series], pd.DataFrame], limit: int | None = None
) -> Step:
    """A language step whose language and confidence come from a model."""
    return model_step(predict, "language string, confidence double", limit)


def model_sentiment(
    predict: Callable[[pd.Series], pd.DataFrame], limit: int | None = None
) -> Step:
    """A sentiment step whose score and magnitude come from a model."""
    step = model_step(predict, "score double, magnitude double", limit)
    return lambda df, text: step(df, text).withColumn("discrete_sentiment", sentiment_bin("score", "magnitude"))


def classify(df: DataFrame, text: Column | str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds topics, the sorted topics whose rules the text meets.

    They come as a generated row: a filter on them (as Spark infers under an explode) would otherwise be pushed below
    and repeat the matching.
    """
    folded = df.withColumn("_text", col(text)).withColumn("_folded", fold("_text"))
    found = folded.withColumn("_found", words_found("_folded", rules))
    met = topics("_text", "_folded", "_found", rules)
    return found.select(*df.columns, F.inline(F.array(F.struct(met.alias("topics")))))


def add_topics(df: DataFrame, text: Column | str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds topics as repeated records, the empty one first."""
    return classify(df, text, rules).withColumn("topics", topic_records("topics"))


def enrich_tweets(
    tweets: DataFrame,
    rules: Sequence[tuple[str, str]],
    language: Step = detect_language,
    sentiment: Step = score_sentiment,
) -> DataFrame:
    """Detect, filter, score and classify in one pass over the tweets, without a shuffle."""
    text = F.col("full_text")
    sure = filter_language(language(tweets, text))
    return add_topics(sentiment(sure, text), text, rules)


def enrich_questions(
    questions: DataFrame, language: Step = detect_language, sentiment: Step = score_sentiment
) -> DataFrame:
    """Detect, filter and score on title and body, then strip tags from the stored body."""
    text = title_and_body("title", "question_content")
    asked = questions.drop("solution", "last_answer")
    scored = sentiment(filter_language(language(asked, text), inclusive=False), text)
    return scored.withColumn("question_content", strip_tags("question_content"))
