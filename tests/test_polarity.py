"""Sentiment by sentence: learned words against plain Python, negation, and the flow."""

import random
import re
from collections import Counter

import pytest

from supportlens.functions import sentiment
from supportlens.operators import enrich, polarity


def py_sentences(text):
    return [re.findall(r"[^\W\d_]+", s.lower()) for s in re.findall(r"[^.!?\n]+", text or "") if re.search(r"[^\W\d_]", s)]


def py_polar(texts, up, down, least=5, bound=200):
    counts, total = {"up": Counter(), "down": Counter()}, Counter()
    for text in texts:
        for words in py_sentences(text):
            for side, seeds in (("up", up), ("down", down)):
                if set(words) & set(seeds):
                    total[side] += 1
                    counts[side].update(set(words))
    out = {}
    for w in {*counts["up"], *counts["down"]} - {*up, *down}:
        a, b = (counts["up"][w] + 1) / (total["up"] + 1), (counts["down"][w] + 1) / (total["down"] + 1)
        p = round(1000 * (a - b) / (a + b))
        if counts["up"][w] + counts["down"][w] >= least and abs(p) >= bound:
            out[w] = p
    return out | dict.fromkeys(down, -1000) | dict.fromkeys(up, 1000)


def test_words_spread_from_seeds(spark):
    rng = random.Random(1)
    good, bad, plain = ["great", "fast", "smooth"], ["awful", "crash", "slow"], ["tab", "page", "the", "menu", "window"]
    texts = []
    for _ in range(200):
        side = rng.choice([good, bad])
        texts.append(". ".join(" ".join(rng.sample(side, 2) + rng.sample(plain, 3)) for _ in range(rng.randrange(1, 4))) + "!")
    df = spark.createDataFrame([(t,) for t in [*texts, None, "", "..."]], "t string")
    got = {r.word: r.polarity for r in polarity.polar_words(df, "t", ["great"], ["awful"]).collect()}
    assert got == py_polar(texts, ["great"], ["awful"])
    assert all(got[w] > 900 for w in ("fast", "smooth")) and all(got[w] < -900 for w in ("crash", "slow"))
    assert not {"tab", "page", "menu"} & {w for w, p in got.items() if abs(p) > 500}


def scores(spark, texts, table, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, t string")
    rows = polarity.score_sentences(df, "t", table, "id", **options).collect()
    assert len(rows) == len(texts)
    return [(r.score, r.magnitude, r.discrete_sentiment) for r in sorted(rows, key=lambda r: r.id)]


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("good", 1000), ("fine", 500), ("bad", -1000)], "word string, polarity int")


def test_scores(spark, table):
    texts = [
        "This is good.", "This is not good.", "Not, that I know, of a thing that is good.", "Good. Bad.", "Good and fine! Bad\nnothing here.",
        "Never bad, always GOOD", "no seeds at all", "", None, "..!", "not good not bad",
    ]
    assert scores(spark, texts, table) == [
        (1.0, 1.0, "positive"), (-1.0, 1.0, "negativ"), (1.0, 1.0, "positive"), (0.0, 2.0, "neutral"), (-0.125, 1.75, "neutral"),
        *[(0.0, 0.0, "neutral")] * 6,
    ]


def test_a_negated_sentence_turns(spark, table):
    plain, negated = scores(spark, ["The update is fine.", "The update is never fine."], table)
    assert plain == (0.5, 0.5, "positive") and negated == (-0.5, 0.5, "negativ")
    assert scores(spark, ["kaum good"], table, negators=["kaum"]) == [(-1.0, 1.0, "negativ")]


def test_long_texts_and_the_flow(spark, table):
    assert scores(spark, ["good. " * 20_000], table) == [(1.0, 20_000.0, "positive")]
    tweets = spark.createDataFrame([("1", "the tab is not good and the menu is"), ("2", "the page is fine and the tab is")], "id_str string, full_text string")
    rich = enrich.enrich_tweets(tweets, [("t", "tab")], sentiment=polarity.sentences_step(table, "id_str")).collect()
    assert {r.id_str: r.discrete_sentiment for r in rich} == {"1": "negativ", "2": "positive"}


def test_empty_tables(spark, table):
    none = spark.createDataFrame([], "id bigint, t string")
    assert polarity.score_sentences(none, "t", table, "id").count() == 0
    assert sorted(polarity.polar_words(none, "t", ["a"], ["b"]).collect()) == [("a", 1000), ("b", -1000)]


def test_words_are_cut_once(spark):
    """Words are cut once a sentence, not once for each word, and the sentences are read once for the counts and their totals."""
    df = spark.createDataFrame([("not good. bad",)], "t string")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert plan(df.select(sentiment.with_negation(sentiment.words("t"), ["not"]).alias("said"))).count("regexp_extract_all(") == 1
    assert plan(polarity.polar_words(df, "t", ["good"], ["bad"])).count("regexp_extract_all(") == 0
