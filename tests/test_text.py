"""Tokens, escapes, clean-ups; random texts against Python's own regular expressions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions import text as tx
from supportlens.operators import terms

PY_TOKENS = re.compile("(" + "|".join(values.TOKEN_ALTERNATIVES) + ")", re.I)
PY_EMOTICON = re.compile("^" + values.EMOTICON + "$", re.I)


def py_tokens(text):
    return [t if PY_EMOTICON.search(t) else t.lower() for t in PY_TOKENS.findall(text)]


def test_tokens_of_a_post(one):
    text = "Hi @Acme :D nod32 f-secure #tag-x 1,234.5"
    assert one(tx.lower_tokens("t"), t=text) == "hi @acme :D nod 32 f-secure #tag-x 1,234.5".split()


def test_random_texts_match_python(spark):
    rng = random.Random(7)
    signs = list("abzXÉéßñ漢字12 ,.:;-_'()#@<>/&%$!\n\t😀") + ["http://", "https://a.b/", ":D", "<b>", "don't", "@me", "#x", "##", "##ab", "1,2"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", tx.lower_tokens("t").alias("w"))
    assert [r["w"] for r in rows.orderBy("id").collect()] == [py_tokens(t) for t in texts]


@pytest.mark.parametrize(
    "text, count",
    [("http://" + "a" * 60000, 1), ("1," * 60000, 1), ("#" * 9000, 9000), ("##ab" * 5000, 5000), ("<" * 9000, 9000), ("x" + "-" * 60000, 60001)],
)
def test_long_runs(one, text, count):
    """No repeat is bounded by the JVM stack."""
    assert one(F.size(tx.tokens("t")), t=text) == count


def test_newlines(one):
    assert one(tx.escape_newlines("t"), t="a\nb\r\nc") == "a\\nb\r\\nc"
    assert one(tx.escape_newlines("t", carriage_returns=True), t="a\nb\r\nc") == "a\\nb\\n\\nc"


@pytest.mark.parametrize("text", ["x" * 10, "x" * 11, "é" * 5, "é" * 6, "é" * 12])
def test_cap(one, text):
    assert one(tx.cap_text("t", 10), t=text) == (text[:10] if len(text.encode()) > 10 else text)


def test_clean_ups(one):
    assert one(tx.strip_tags("t"), t="a<b>c</b> 1<2") == "ac 1<2"
    assert one(tx.commas_to_blanks("t"), t="a,b、c，d") == "a b c d"
    assert one(tx.strip_prefix("t", "https://h.org"), t="https://h.org/x") == "/x"
    assert one(tx.strip_prefix("t", "https://h.org"), t="/x") == "/x"
    assert one(tx.title_and_body("a", "b"), a="x", b=None) is None


def test_keys(one):
    assert one(tx.composite_key("a", "b", "c"), a="2020-01-06", b="", c="q") == "2020-01-06##q"
    assert tx.load_name("sentiment", "2020-01-01", "2020-01-08") == "sentiment/start=2020-01-01/end=2020-01-08"


def test_stop_terms():
    stops = values.stop_terms(("acme",))
    assert {"the", "!", "rt", "acme", "@acme"} <= set(stops) and len(stops) == len(set(stops))


def test_keyword_counts(spark):
    rows = spark.createDataFrame(
        [
            (1, "Norton and norton, quick heal", "AVG", "linux"),
            (2, "nod32", "norton", "OS X"),
            (3, None, "norton", "linux"),
        ],
        "id int, question_content string, title string, metadata_array string",
    ).withColumn("created_date", F.expr("timestamp_ntz'2020-01-01 05:00:00'"))

    def counts(**kw):
        return {r["forum_word"]: r["forum_freq"] for r in terms.keyword_counts(rows, **kw).collect()}

    assert counts() == {"norton": 2, "avg": 1, "linux": 2}
    assert counts(phrases=True) == {"norton": 2, "avg": 1, "linux": 2, "quick heal": 1, "os x": 1}
