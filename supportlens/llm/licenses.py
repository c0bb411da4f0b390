"""License scans by diagonal voting.

All rolling k-grams of a document's words are looked at. Words are numbered by the templates' vocabulary, so that a k-gram's
number stands for its words exactly. The scan already drops k-grams that stand in no template, which are nearly all; Spark joins the
others to all their template positions. Hits on one diagonal (word position less template position) are votes for one
placing of the template; diagonals a few words apart are one placing with words put in or left out. The words of each placing are then
aligned with the template's; it is a span if enough of the template's words are matched, the matches are dense in the text, and the
words that name the license are among them. A span within one that fits better is no license of its own.

Base phrases are found apart and always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supportlens.llm.common import stored
from supportlens.llm.license_templates import NAMES, PHRASES, TEMPLATES

K = 4
#: Diagonals at most so many words apart are one placing.
SLACK = 4
#: Least share of the template's words that are matched, and of the span's words that are matches.
COVERAGE, DENSITY = 0.75, 0.6
#: What a word put in costs an alignment, in matched words; every one is tried.
GAPS = (0.05, 0.25, 0.5)

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

ROWS = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, grams array<struct<pos:int,gram:bigint>>, ids array<int>"


def words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class _Numbers(dict):
    """Numbers of known words, from 1; 0 for all others."""

    def __missing__(self, word: bytes) -> int:
        return 0


class Templates:
    def __init__(self, templates: list[tuple[str, str]], phrases: list[tuple[str, str]], k: int = K, names: list[str] = NAMES):
        self.k = k
        self.labels = [label for label, _ in templates]
        texts = [words(text) for _, text in templates]
        short = [t for t in texts if len(t) < k]
        if short:
            raise ValueError(f"templates need {k} words at least: {short}")
        spoken = [(words(phrase), label) for phrase, label in phrases]
        vocabulary = sorted({w for t in texts for w in t} | {w for p, _ in spoken for w in p})
        self.base = len(vocabulary) + 1
        if self.base**k >= 2**63:
            raise ValueError("too many different words for exact numbers of k-grams")
        self.numbers = _Numbers({w: i + 1 for i, w in enumerate(vocabulary)})
        self.texts = [np.array([self.numbers[w] for w in t], np.int64) for t in texts]
        # A license's name words: those of its label and of `names`. A notice without them is another license's.
        told = [set(words(label)) | set(words(" ".join(names))) for label in self.labels]
        self.needed = [np.unique([self.numbers[w] for w in t if w in own]).astype(np.int64) for t, own in zip(texts, told, strict=True)]
        self.phrases = [(np.array([self.numbers[w] for w in p], np.int64), label) for p, label in spoken]

    def grams(self, ids: np.ndarray, k: int) -> np.ndarray:
        """The number of the k-gram at each position, 0 where a word is unknown."""
        n = max(0, len(ids) - k + 1)
        number, known = np.zeros(n, np.int64), np.ones(n, bool)
        for j in range(k):
            part = ids[j : j + n]
            number = number * self.base + part
            known &= part > 0
        return np.where(known, number, 0)

    def seed(self, ids: np.ndarray) -> int:
        """Words of the k-grams that vote for a template: two for short ones, where a changed word leaves no longer run."""
        return self.k if len(ids) >= 2 * self.k else 2

    def positions(self) -> list[tuple[int, int, int]]:
        """(gram, template, position): bounded by the templates' words. Numbers of k-grams of different k differ."""
        return [(int(g), t, i) for t, ids in enumerate(self.texts) for i, g in enumerate(self.grams(ids, self.seed(ids)))]

    def align(self, template: int, ids: np.ndarray, low: int, high: int, coverage: float, density: float) -> tuple[int, int, float] | None:
        """First word, last word and coverage of the template's best placing in the text's words low..high, if one is good enough."""
        words, needed = self.texts[template], self.needed[template]
        m, low, high = len(words), max(0, low), min(len(ids), high)
        part, best = ids[low:high], None
        n = self.base
        if np.minimum(np.bincount(part, minlength=n), np.bincount(words, minlength=n))[1:].sum() < coverage * m:
            return None  # not even in any order
        for gap in GAPS:
            # rows: score, matches, first word of the best chain that ends at or before each template word
            score, count, first = np.full(m + 1, -np.inf), np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
            for i, word in enumerate(part.tolist()):
                score -= gap
                at = np.flatnonzero(words == word) if word else ()
                if not len(at):
                    continue
                go_on = score[at] + gap > 0  # `score` holds the chains before this word, which itself is no gap
                ends = np.where(go_on, score[at] + gap, 0) + 1
                counts, starts = np.where(go_on, count[at], 0) + 1, np.where(go_on, first[at], i)
                for j, s, c, f in zip((at + 1).tolist(), ends.tolist(), counts.tolist(), starts.tolist(), strict=True):
                    fits = c >= coverage * m and c >= density * (i - f + 1) and (best is None or c > best[2])
                    if fits and np.isin(needed, part[f : i + 1]).all():
                        best = (low + f, low + i, c)
                    end = j + int(np.searchsorted(score[j:], s))  # scores rise along the template
                    score[j:end], count[j:end], first[j:end] = s, c, f
        return best and (best[0], best[1], best[2] / m)


    def outermost(self, spans: list[tuple]) -> list[tuple]:
        """The spans (label, template, first, last, coverage) that lie within no other label's span of as high a coverage and more
        words of its template, or of higher coverage and as many."""
        size = lambda s: round(s[4] * len(self.texts[s[1]]))
        within = lambda s, t: s[0] != t[0] and t[2] <= s[2] and s[3] <= t[3]
        better = lambda t, s: t[4] >= s[4] and size(t) >= size(s) and (t[4], size(t)) != (s[4], size(s))
        return [s for s in spans if not any(within(s, t) and better(t, s) for t in spans)]


def license_rows(docs: DataFrame, templates: Templates, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, written once: row, doc_id, counts of base phrases, and the k-grams of template words."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = text.schema["doc_id"].dataType.simpleString()

    seeds = np.unique([g for g, _, _ in templates.positions()])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = templates.numbers.__getitem__
        for batch in batches:
            rows = []
            for value in batch.column(1):
                found = words(value.as_py())
                ids = np.fromiter(map(number, found), np.int64, len(found))
                labels, starts = [], []
                for phrase, label in templates.phrases:
                    n = max(0, len(ids) - len(phrase) + 1)
                    same = np.ones(n, bool)
                    for j, word in enumerate(phrase):
                        same &= ids[j : j + n] == word
                    at = np.flatnonzero(same)
                    if len(at):
                        labels.append(label)
                        starts.append(at)
                places = np.concatenate(starts) if starts else np.zeros(0, np.int64)
                hits, grams = [], []
                for k in sorted({2, templates.k}):
                    own = templates.grams(ids, k)
                    hits.append(np.flatnonzero(np.isin(own, seeds)))
                    grams.append(own[hits[-1]])
                hits, grams = np.concatenate(hits), np.concatenate(grams)
                rows.append({
                    "n_words": len(found), "n_base": len(places), "base_labels": labels,
                    "first_word": int(places.min()) if len(places) else None, "last_word": int(places.max()) if len(places) else None,
                    "grams": [{"pos": p, "gram": g} for p, g in zip(hits.tolist(), grams.tolist(), strict=True)],
                    "ids": ids if len(hits) else [],
                })
            columns = [batch.column(0)]
            for name, type_ in _ARROW.items():
                columns.append(pa.array([r[name] for r in rows], type_))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_ARROW])

    return stored(text.mapInArrow(scan, f"doc_id {kind}, {ROWS}").withColumn("row", F.monotonically_increasing_id()), "license-rows")


_ARROW = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.list_(pa.string()),
    "grams": pa.list_(pa.struct([("pos", pa.int32()), ("gram", pa.int64())])), "ids": pa.list_(pa.int32()),
}


def license_spans(rows: DataFrame, templates: Templates, coverage: float = COVERAGE, density: float = DENSITY, slack: int = SLACK) -> DataFrame:
    """Verified spans: row, doc_id, label, template, first_word, last_word (positions in the text), coverage."""
    spark = rows.sparkSession
    table = spark.createDataFrame(templates.positions(), "gram bigint, template int, tpos int")
    hits = rows.select("row", F.inline("grams")).join(F.broadcast(table), "gram")
    votes = hits.select("row", "template", (F.col("pos") - F.col("tpos")).alias("diagonal")).distinct()
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > slack, F.lit(True)).cast("int")
    merged = votes.withColumn("new", new).withColumn("placing", F.sum("new").over(order))
    placed = merged.groupBy("row", "template", "placing").agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"))
    placed = placed.groupBy("row").agg(F.collect_list(F.struct("template", "low", "high")).alias("placings"))  # at most the text's hits
    joined = rows.select("row", "doc_id", "ids").join(placed, "row")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i, (ids, placings) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                ids, spans = ids.values.to_numpy(), []
                for p in placings.as_py():
                    m = len(templates.texts[p["template"]])
                    more = int(m / density) - m + slack  # a span is at most so much longer than its template
                    found = templates.align(p["template"], ids, p["low"] - more, p["high"] + m + more, coverage, density)
                    if found:
                        spans.append((templates.labels[p["template"]], p["template"], *found))
                best = templates.outermost(spans)
                at += [i] * len(best)
                out += best
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
            places = pa.array(at, pa.int64())
            arrays = [batch.column(0).take(places), batch.column(1).take(places), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "label", "template", "first_word", "last_word", "coverage"])

    return joined.mapInArrow(verify, f"row bigint, doc_id {kind}, label string, template int, first_word bigint, last_word bigint, coverage double")


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES, **limits) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    score is 1 where a base phrase stands, else the largest coverage of a verified span, else 0. Null and empty texts have no words
    and no labels (''); repeated rows, null ids and clashing column names are no matter; an empty table gives no rows.
    """
    made = Templates(templates, phrases)
    rows = license_rows(docs, made)
    found = license_spans(rows, made, **limits).groupBy("row").agg(F.collect_set("label").alias("found"), F.max("coverage").alias("coverage"))
    joined = rows.drop("grams", "ids").join(found, "row", "left")
    every = F.concat("base_labels", F.coalesce("found", F.array().cast("array<string>")))
    listed = [F.array_join(F.sort_array(F.array_distinct(x)), ",") for x in (F.col("base_labels"), every)]
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("coverage", F.lit(0.0)))
    return joined.select("doc_id", "n_words", "n_base", "first_word", "last_word", listed[0].alias("base_labels"), listed[1].alias("labels"), score.alias("score"))
