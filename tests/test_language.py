"""Language by letters against plain Python, and its accuracy on texts it hasn't seen."""

import math
import re
from collections import Counter

import pytest

from supportlens.functions import language
from supportlens.operators import enrich
from supportlens.plans import text_queries

FOLDER = "/root/testdata/sf0.01"


def py_runs(text):
    if not any(c.isalpha() for c in text or ""):
        return []
    letters = [ord(c) for c in " " + re.sub(r"[^\W\d_]+|.", lambda m: m[0] if m[0].isalpha() else "\0", (text or "").lower(), flags=re.S) + " "]
    plain = re.sub("\0+", " ", "".join(map(chr, letters)))
    codes = list(map(ord, plain))
    return [((a * 31 + b) * 31 + c) % language.BUCKETS for a, b, c in zip(codes, codes[1:], codes[2:])]


@pytest.mark.parametrize("text", ["", None, "a", "Ab", "Größe, 12 x!", "  l'été \n", "ab" * 30_000, "漢字 и"])
def test_runs(one, text):
    if text is None:
        assert one(language.letter_runs("t").isNull() | (language.F.size(language.letter_runs("t")) == 0), t="x") is False
    else:
        assert one(language.letter_runs("t"), t=text) == py_runs(text)


def test_runs_are_made_once(spark):
    """Letters are cut once in an expression, and texts are read once for the table."""
    df = spark.createDataFrame([("the thing", "en")], "t string, lang string")
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert plan(df.select(language.letter_runs("t").alias("runs"))).count("split(") == 1
    assert plan(language.language_table(df, "t", "lang")).count("split(") == 0


def test_against_python(spark):
    rows = [(1, "the thing", "en"), (2, "der ding", "de"), (3, "this and that", "en"), (4, None, "de"), (5, "x", None), (6, "eine ganze menge", "de")]
    df = spark.createDataFrame(rows, "id bigint, t string, lang string")
    weights = language.language_weights(language.language_table(df, "t", "lang"))
    counts = {lang: Counter(b for _, t, x in rows if x == lang for b in py_runs(t)) for lang in ("de", "en")}
    for lang, c in counts.items():
        want = [round(1000 * math.log((c[b] + 1) / (sum(c.values()) + language.BUCKETS))) for b in range(language.BUCKETS)]
        assert weights[lang] == want
    texts = ["the", "ganze", "", None, "!!", "the ganze thing der", "zzz"]
    scored = language.language_by_letters(spark.createDataFrame([(t,) for t in texts], "t string"), "t", weights).collect()
    for r in scored:
        runs = py_runs(r.t)
        sums = {lang: sum(weights[lang][b] for b in runs) for lang in weights}
        best = max(sums, key=lambda lang: (sums[lang], lang == "de"))
        other = min(sums.values())
        if not re.search(r"\w", r.t or ""):
            assert (r.language, r.confidence) == ("und", 0.0)
        else:
            assert r.confidence == pytest.approx(1 / sum(math.exp((s - sums[best]) / 1000) for s in sums.values()))
            assert r.language == (best if sums[best] - other >= 1000 else "und")


def test_held_out_texts(spark):
    """Measured on sf0.01: whole texts and their first 30 characters."""
    rows = [r for r in text_queries.QUERIES["language_letters"](spark, FOLDER).collect() if r.held_out]
    assert len(rows) > 250
    assert sum(r.language == r.lang for r in rows) / len(rows) >= 0.99
    start = sum(r.start_language == r.lang for r in rows) / len(rows)
    wrong = sum(r.start_language not in (r.lang, "und") for r in rows) / len(rows)
    print(f"of {len(rows)}: {sum(r.language == r.lang for r in rows)} whole, {start:.3f} of 30 characters right, {wrong:.3f} wrong")
    assert start >= 0.8 and wrong <= 0.05


def test_one_language_and_the_flow(spark):
    """A single language is always sure; the step takes its place in the tweets' flow."""
    df = spark.createDataFrame([("a thing", "en")], "t string, lang string")
    weights = language.language_weights(language.language_table(df, "t", "lang"))
    assert [tuple(r)[2:] for r in language.language_by_letters(df, "t", weights).collect()] == [("en", 1.0)]
    more = df.union(spark.createDataFrame([("ein ganz anderer satz", "de")], df.schema))
    weights = language.language_weights(language.language_table(more, "t", "lang"))
    tweets = spark.createDataFrame([("1", "a thing"), ("2", "ganz anderer"), ("3", "")], "id_str string, full_text string")
    kept = enrich.enrich_tweets(tweets, [("t", "thing")], language=enrich.letters_step(weights)).collect()
    assert [r.id_str for r in kept] == ["1"]


def test_bounds(spark):
    table = spark.createDataFrame([(f"l{i}", -1, -1) for i in range(5)], "lang string, bucket int, weight int")
    with pytest.raises(ValueError, match="languages"):
        language.language_weights(table, most=4)
    empty = language.language_table(spark.createDataFrame([], "t string, lang string"), "t", "lang")
    assert language.language_weights(empty) == {}
