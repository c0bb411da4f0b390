"""Quality classifier: a generalised additive model with pairwise interactions, from cyclic boosted shallow trees.

Each feature is cut into bins. Boosting goes round the features, each time fitting a small tree on one feature's bins to the
gradient, so that the trees of a feature add up to one lookup table; the pairs of features that explain most of what is
left then get tables of their own the same way. A score is the sum of a document's table entries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows a model is fitted on: those whose ids have the smallest hashes. Bounds the driver's memory.
TRAIN_ROWS = 20_000
BINS, PAIR_BINS = 64, 16
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 8
RATE, LEAVES, MIN_HESSIAN, RIDGE = 0.1, 3, 2.0, 1.0

FEATURES = [
    "log_words", "word_length", "long_words", "upper", "digits", "marks", "spaces", "other_bytes", "lines", "line_words",
    "distinct_words", "repeated_pairs", "top_word", "lone_marks", "marked_words", "upper_words", "exclaimed", "symbols",
]

_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH, _MARK = range(6)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[[9, 10, 11, 12, 13, 32]], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _SPACE, _HIGH
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#$%&*@^~<>{}[]\\/=+_", np.uint8)] = True
_SENTENCE = frozenset(".,;:?!\"'()-")


def features(text: str | None) -> np.ndarray:
    """Numbers on the whole text; an empty one has zeros."""
    out = np.zeros(len(FEATURES), np.float32)
    words = (text or "").split()
    if not words:
        return out
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_CLASS[data], minlength=6)
    n, size = len(words), len(data)
    letters = max(1, kinds[_UPPER] + kinds[_LOWER] + kinds[_HIGH])
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = text.count("\n") + 1
    out[:] = (
        np.log1p(n), lengths.mean(), (lengths > 20).mean(), kinds[_UPPER] / letters, kinds[_DIGIT] / size, kinds[_MARK] / size,
        kinds[_SPACE] / size, kinds[_HIGH] / size, np.log1p(lines), np.log1p(n / lines), len(counts) / n, repeats / n,
        max(counts.values()) / n, sum(not any(map(str.isalnum, w)) * c for w, c in counts.items() if len(w) < 4) / n,
        sum(c for w, c in counts.items() if not (w[-1].isalnum() or w[-1] in _SENTENCE)) / n,
        sum(c for w, c in counts.items() if w.isupper()) / n, text.count("!") / n, _SYMBOL[data].sum() / size,
    )
    return out


@dataclass
class Gam:
    """edges: upper bounds of each feature's bins. tables: a row of scores by bin for each feature. pairs: for (a, b) a table
    over the coarse bins of both, which are the fine ones divided by `fold`."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    fold: int = BINS // PAIR_BINS

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(self.edges)], axis=1)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[bins[:, f]]
        for (a, b), table in self.pairs.items():
            total += table[bins[:, a] // self.fold, bins[:, b] // self.fold]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.binned(x)), -40, 40)))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int) -> np.ndarray:
    """Values by bin of the tree of up to `leaves` leaves that explains the gradient best, split by split."""
    parts = [(0, len(grad))]
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])

    def best(low: int, high: int) -> tuple[float, int]:
        cut = np.arange(low + 1, high)
        gl, hl, gr, hr = g[cut] - g[low], h[cut] - h[low], g[high] - g[cut], h[high] - h[cut]
        gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - (g[high] - g[low]) ** 2 / (h[high] - h[low] + RIDGE)
        gain[(hl < MIN_HESSIAN) | (hr < MIN_HESSIAN)] = -1
        return (float(gain.max()), int(cut[gain.argmax()])) if len(cut) else (-1.0, 0)

    for _ in range(leaves - 1):
        gain, at, part = max((*best(*p), p) for p in parts)
        if gain <= 1e-9:
            break
        parts.remove(part)
        parts += [(part[0], at), (at, part[1])]
    values = np.zeros(len(grad))
    for low, high in parts:
        values[low:high] = -(g[high] - g[low]) / (h[high] - h[low] + RIDGE)
    return values


def _pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that splits one feature and then the other on either side."""
    best = (0.0, np.zeros_like(grad))
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        gc, hc = g.cumsum(axis=0), h.cumsum(axis=0)
        for cut in range(1, len(g)):
            values, gain = np.empty_like(g), 0.0
            for rows, gs, hs in ((slice(0, cut), gc[cut - 1], hc[cut - 1]), (slice(cut, None), gc[-1] - gc[cut - 1], hc[-1] - hc[cut - 1])):
                values[rows] = _tree(gs, hs, 2)
                gain -= float((gs * values[rows][0] + 0.5 * hs * values[rows][0] ** 2).sum())
            if gain > best[0] + 1e-12:
                best = gain, (values.T if turned else values).copy()
    return best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS) -> Gam:
    """The model of the rows. Without rows it scores 0.5; with labels of one kind, near that kind."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) if len(x) else np.zeros(0) for f in range(len(FEATURES))]
    rate = (y.sum() + 1) / (len(y) + 2)
    model = Gam(edges, float(np.log(rate / (1 - rate))), [np.zeros(BINS) for _ in edges])
    if not len(x) or y.min() == y.max():
        return model
    bins = model.binned(x)
    raw = np.full(len(x), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            grad, hess = slopes()
            step = RATE * _tree(np.bincount(bins[:, f], grad, BINS), np.bincount(bins[:, f], hess, BINS), LEAVES)
            table += step
            raw += step[bins[:, f]]
    coarse = bins // model.fold
    cells = {(a, b): coarse[:, a] * PAIR_BINS + coarse[:, b] for a, b in combinations(range(len(edges)), 2)}

    def grid(pair: tuple[int, int], values: np.ndarray) -> np.ndarray:
        return np.bincount(cells[pair], values, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)

    grad, hess = slopes()
    gains = sorted(((_pair_tree(grid(p, grad), grid(p, hess))[0], p) for p in cells), reverse=True)
    model.pairs = {p: np.zeros((PAIR_BINS, PAIR_BINS)) for gain, p in gains[:pairs] if gain > 0}
    for _ in range(pair_rounds):
        for p, table in model.pairs.items():
            grad, hess = slopes()
            step = RATE * _pair_tree(grid(p, grad), grid(p, hess))[1]
            table += step
            raw += step.reshape(-1)[cells[p]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from. A row without id has no label and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most `rows` labelled documents outside the held-out fold. Labels other than 0 and 1 are ignored;
    where an id is labelled more than once, its majority counts, and a tie is ignored."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("share")).filter("share <> 0.5")
    # only labels of documents at hand count towards the bound; their ids alone are compared
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most `rows` rows of two numbers

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_ = [features(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows_, pa.binary()), batch.column(2)], ["doc_id", "x", "share"])

    kind = found.schema["doc_id"].dataType.simpleString()
    got = found.mapInArrow(measure, f"doc_id {kind}, x binary, share double").orderBy("doc_id", "x").limit(2 * rows).collect()
    x = np.frombuffer(b"".join(r.x for r in got), np.float32).reshape(-1, len(FEATURES))
    return x, np.array([r.share > 0.5 for r in got], float)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Gam:
    return fit(*training_rows(docs, labels, rows))


def scored(docs: DataFrame, model: Gam) -> DataFrame:
    """`docs` with held_out, score and predicted; all rows and columns stay (columns of those names are replaced).

    The score hangs on the text alone. Null and empty texts have zero features and a score like any other; repeated rows score
    alike; an empty table gives no rows.
    """
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.stack([features(t) for t in texts]) if len(texts) else np.zeros((0, len(FEATURES)), np.float32)
            yield pd.Series(shared.value.score(x))

    keep = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("held_out", "score", "predicted")]
    rows = rows.withColumn("_score", score("_text"))
    return rows.select(
        *keep, held_out(F.col("_id")).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted")
    )
