"""Keyword rules: a rule's text becomes one pattern, and a text meets the rule by enough distinct matches."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from supportlens.functions.text import col

_FLAGS = "(?iU)"


def _part(keyword: str) -> str:
    word = keyword.strip()
    bare = word.replace("_", "")
    if word.startswith("_"):
        return rf"({bare}\w+)".replace(" ", r"\s")
    if word.endswith("_"):
        return rf"(\w+{bare})".replace(" ", r"\s")
    return word.replace(" ", r"\s")


def rule_pattern(keywords: str) -> str:
    """Whole-word pattern of a comma-separated rule; '_x' begins a longer word, 'x_' ends one."""
    return "|".join(rf"\b{_part(k)}\b" for k in keywords.split(","))


def matches_rule(text: Column | str, keywords: str) -> Column:
    """True when the text holds at least as many distinct matches as the rule has parts.

    Matches differ by case ("Not NOT" meets a two-part rule). Once a part has an open end, only the open-ended words
    themselves tell matches apart, all other hits count as one.
    """
    text, pattern = col(text), F.lit(_FLAGS + rule_pattern(keywords))
    parts = keywords.split(",")
    groups = sum(1 for k in parts if k.strip().startswith("_") or k.strip().endswith("_"))
    if groups <= 1:
        found = F.regexp_extract_all(text, pattern, F.lit(groups))
    else:
        found = F.arrays_zip(*[F.regexp_extract_all(text, pattern, F.lit(i + 1)) for i in range(groups)])
    if len(parts) == 1:
        return text.rlike(_FLAGS + rule_pattern(keywords))
    return F.size(F.array_distinct(found)) >= len(parts)


# The only other letters that equal an ASCII letter when case is ignored, and the letters they equal.
_ODD_CASES = ("\u017f\u212a\u0131\u0130", "skii")


def fold(text: Column | str) -> Column:
    """The text's runs of ASCII letters and digits in lower case, each between blanks: ' a b '. In it an ASCII keyword is
    found as it stands, and one that begins or ends a word with the blank at that side."""
    lower = F.lower(F.translate(col(text), *_ODD_CASES))
    return F.concat(F.lit(" "), F.regexp_replace(lower, "[^a-z0-9]+", " "), F.lit(" "))


def _runs(keyword: str) -> list[str] | None:
    """ASCII letter and digit runs that stand alone wherever the keyword matches; None where that is not certain."""
    word = keyword.strip().lower()
    if not word.isascii() or re.search(r"[^a-z0-9 \-/:']", word):
        return None
    return re.findall(r"[a-z0-9]+", word)


def rule_words(rules: Sequence[tuple[str, str]]) -> list[str]:
    """All runs of all rules."""
    return sorted({run for _, keywords in rules for k in keywords.split(",") for run in _runs(k) or []})


def words_found(folded: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Which of the rules' runs the folded text holds, from one pass over the text however many rules there are."""
    runs = F.split(col(folded), " ")
    return F.array_intersect(runs, F.array(*[F.lit(w) for w in rule_words(rules)]).cast("array<string>"))


def may_match(folded: Column | str, found: Column | str, keywords: str) -> Column:
    """False only where no part of the rule can match; cheap, so it stands before the pattern."""
    tests = []
    for keyword in keywords.split(","):
        word, runs = keyword.strip().lower(), _runs(keyword)
        bare, opened = word.replace("_", ""), word.startswith("_") or word.endswith("_")
        if runs:
            tests.append(reduce(and_, [F.array_contains(found, run) for run in runs]))
        elif opened and bare.isascii() and bare.isalnum():
            first = " " if word.startswith("_") else ""
            last = "" if first else " "
            tests.append(F.contains(col(folded), F.lit(first + bare + last)))
        else:
            return F.lit(True)
    return reduce(or_, tests)


def topics(text: Column | str, folded: Column | str, found: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """Sorted distinct topics whose rules the text meets; null text gives none. `folded` and `found` are columns made
    beforehand by fold and words_found, so each is worked out once a row."""
    by_topic: dict[str, Column] = {}
    for topic, keywords in dict.fromkeys(rules):
        hit = may_match(folded, found, keywords) & matches_rule(text, keywords)
        by_topic[topic] = by_topic[topic] | hit if topic in by_topic else hit
    met = F.array(*[F.when(hit, F.lit(topic)) for topic, hit in sorted(by_topic.items())])
    return F.array_compact(met.cast("array<string>"))


def topic_records(found: Column | str) -> Column:
    """Topics as the warehouse's repeated record: an empty one first, then one each."""
    records = F.transform(col(found), lambda t: F.struct(t.alias("topic")))
    return F.concat(F.array(F.struct(F.lit("").alias("topic"))), records)
