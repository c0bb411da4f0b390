"""Sentiment columns: bins, and the default lexicon score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from supportlens import values
from supportlens.functions.text import col, once

_WORD = r"[\p{L}]+"


def sentiment_bin(
    score: Column | str,
    magnitude: Column | str,
    score_cutoff: float = values.SCORE_CUTOFF,
    magnitude_cutoff: float = values.MAGNITUDE_CUTOFF,
) -> Column:
    """Weak texts and weak scores are neutral; the rest follows the score's sign. No score, no bin."""
    score = F.nanvl(col(score), F.lit(None).cast("double"))
    magnitude = F.nanvl(col(magnitude), F.lit(None).cast("double"))
    return (
        F.when(magnitude < magnitude_cutoff, values.NEUTRAL)
        .when(score < -score_cutoff, values.NEGATIVE)
        .when(score > score_cutoff, values.POSITIVE)
        .when(score.isNotNull(), values.NEUTRAL)
    )


def words(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(text)), F.lit(_WORD), F.lit(0))


def count_in(found: Column | str, vocabulary: Sequence[str]) -> Column:
    """How many of the words are in the vocabulary, repeats counted."""
    return F.size(F.filter(col(found), lambda w: w.isin(list(vocabulary))))


def lexicon_score(positive: Column | str, negative: Column | str) -> tuple[Column, Column]:
    """(score, magnitude): mean polarity of the polar words, and their number."""
    up, down = col(positive).cast("double"), col(negative).cast("double")
    return F.when(up + down > 0, (up - down) / (up + down)).otherwise(F.lit(0.0)), up + down


def sentences(text: Column | str) -> Column:
    """The runs between full stops, exclamation and question marks and line ends that hold a letter."""
    return F.filter(F.regexp_extract_all(col(text), F.lit(r"[^.!?\n]+"), F.lit(0)), lambda s: F.rlike(s, F.lit(r"\p{L}")))


def with_negation(found: Column | str, negators: Sequence[str], reach: int = values.NEGATION_REACH) -> Column:
    """(word, negated) of a sentence's words: negated if one of the `reach` words before is a negator."""
    listed = list(negators)
    before = lambda own, i: F.slice(own, F.greatest(i - (reach - 1), F.lit(1)), F.least(i, F.lit(reach)))
    flagged = lambda own: F.transform(own, lambda w, i: F.struct(w.alias("word"), F.exists(before(own, i), lambda x: x.isin(listed)).alias("negated")))
    return once(found, flagged)
