"""Topic rules: the worked cases, and all shipped rules against Python on made-up texts."""

import random
import re

import pytest

from supportlens import values
from supportlens.functions.topics import matches_rule, rule_pattern
from supportlens.operators.enrich import add_topics, classify

RULES = [
    ("single word", "abc"),
    ("multiple single words", "abc"),
    ("multiple single words", "def"),
    ("single phrase", "abc def"),
    ("word combinations", "abc, def"),
    ("word ending", "abc_"),
    ("word begining", "_abc"),
]


def topics_of(spark, text, rules=RULES):
    return classify(spark.createDataFrame([(text,)], "t string"), "t", rules).first()["topics"]


def py_match(text, keywords):
    found = re.compile(rule_pattern(keywords), re.I).findall(text)
    return len(set(found)) >= len(keywords.split(","))


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("", set()),
        ("Test sentence", set()),
        ("Test sentence def", {"multiple single words"}),
        ("Test sentence abc", {"single word", "multiple single words"}),
        ("Test sentence abc def", {"single word", "multiple single words", "single phrase", "word combinations"}),
        ("Test sentence def abc", {"single word", "multiple single words", "word combinations"}),
        ("Test sentence abcword", {"word begining"}),
        ("Test sentence wordabc", {"word ending"}),
    ],
)
def test_topics(spark, text, wanted):
    assert topics_of(spark, text) == sorted(wanted)


@pytest.mark.parametrize(
    "text, keywords, wanted",
    [("simple test text", k, True) for k in ("test", "test text", "text, simple", "_tes", "est_")]
    + [("simple test text", k, False) for k in ("abc", "test abc", "text, abc", "_abc", "abc_")]
    + [
        ("", "test", False),
        ("Not NOT x", "not,respon", True),
        ("load", "_load", False),
        ("it freezes", "freez", False),
        ("tab win loading", "_load,tab,win", False),
        ("loading down upload", "_load,load_", True),
    ],
)
def test_rules(one, text, keywords, wanted):
    assert one(matches_rule("t", keywords), t=text) is wanted
    assert py_match(text, keywords) is wanted


def test_shipped_rules_match_python(spark):
    rules = values.topic_rules("Acme")
    rng = random.Random(3)
    stock = [w for _, k in rules for w in re.split(r"[,\s]+", k.replace("_", "")) if w]
    extra = ["the", "loading", "Loads", "NOT", "not", "bookmarks", "h3264", "page", "İ", "ſync", "ﬁrewall", "é"]
    texts = [rng.choice([" ", " ", "-", ", "]).join(rng.choice(stock + extra) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    rows = classify(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "t", rules)
    wanted = [sorted({topic for topic, k in rules if py_match(t, k)}) for t in texts]
    assert [r["topics"] for r in rows.orderBy("id").collect()] == wanted
    assert any(wanted) and not all(wanted)


def test_records(spark):
    rows = add_topics(spark.createDataFrame([("def",), ("x",)], "t string"), "t", RULES)
    assert rows.columns == ["t", "topics"]
    assert [[r["topic"] for r in row["topics"]] for row in rows.collect()] == [["", "multiple single words"], [""]]


def test_no_text_no_rules(spark):
    assert topics_of(spark, None) == []
    assert topics_of(spark, "abc", []) == []
