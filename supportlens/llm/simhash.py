"""SimHash near-duplicates by pivot distance tables.

The table holds a fingerprint's Hamming distances to many reference fingerprints. References come in groups: those of a group are
equal but for one segment of the bits, so that their distances to a fingerprint, taken relative to the group's first, hang on that
segment alone. Two fingerprints that differ in at most `radius` bits differ in at most `radius` segments; their relative
distances are the same in all other groups. Spark brings together fingerprints with equal relative distances in all but `radius` groups,
for every choice of those. Within such a set, pairs whose table rows differ by more than `radius` in any coordinate are
discarded (the triangle inequality), and survivors are verified on the bits.

The references of a group tell the patterns of its segment apart, so a set is bounded by the bits left open. Sets of more than HOT
fingerprints are dealt again with more and shorter segments, which leave so few bits open that a set has at most some
thousand members: nothing is capped, and near copies in any number stay small tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.llm.common import semi, stored
from supportlens.llm.links import components

BITS = 64
RADIUS = 2
WORDS = 3
SEED = 42
SEGMENTS, FINE_SEGMENTS = 5, 12
#: Sets of more fingerprints than this are dealt again by FINE_SEGMENTS.
HOT = 1000

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """SimHash of the word shingles, repeats included."""
    found = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    last = ends[min(words, len(found)) - 1 :]
    digest, seed = xxhash.xxh64_intdigest, SEED
    spans = zip(starts[:n].tolist(), last.tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    set_ = np.zeros(BITS, np.int64)
    for part in range(0, n, 65_536):
        bits = np.unpackbits(hashes[part : part + 65_536, None].view(np.uint8), axis=1, bitorder="little")
        set_ += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), text_hash of every row, written once."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    text = text.withColumn("text_hash", F.xxhash64("text"))
    kind = text.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), batch.column(2)], ["doc_id", "fp", "text_hash"])

    return stored(text.mapInArrow(make, f"doc_id {kind}, fp bigint, text_hash bigint"), "fingerprints")


class Pivots:
    """Reference fingerprints in groups, one group for each of `segments` parts of the bits."""

    def __init__(self, segments: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        base = rng.integers(0, 2**63, dtype=np.uint64)
        edges = np.linspace(0, BITS, segments + 1).astype(int)
        self.groups: list[np.ndarray] = []
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            self.groups.append(self._resolving(base, low, high - low, rng))

    @staticmethod
    def _resolving(base: np.uint64, low: int, width: int, rng) -> np.ndarray:
        """References that differ from `base` in the segment alone, as many as tell all its patterns apart."""
        patterns = np.arange(2**width, dtype=np.uint64) << np.uint64(low)
        found, seen = [base], np.zeros(len(patterns), np.int64)
        mask = np.uint64((2**width - 1) << low)
        first = np.bitwise_count(patterns ^ (base & mask)).astype(np.int64)
        while len(np.unique(seen)) < len(patterns):
            ref = base ^ (rng.integers(1, 2**width, dtype=np.uint64) << np.uint64(low))
            more = seen * (2 * width + 1) + np.bitwise_count(patterns ^ (ref & mask)) - first
            _, more = np.unique(more, return_inverse=True)
            if more.max() > seen.max():
                found.append(ref)
                seen = more.astype(np.int64)
        return np.array(found, np.uint64)

    def table(self, prints: np.ndarray) -> np.ndarray:
        """Distances to all references: one row a fingerprint."""
        return np.concatenate([np.bitwise_count(prints[:, None] ^ g[None, :]) for g in self.groups], axis=1).astype(np.int8)

    def profiles(self, prints: np.ndarray) -> np.ndarray:
        """One number a fingerprint and group for its relative distances: equal for equal ones."""
        columns = []
        for g in self.groups:
            distances = np.bitwise_count(prints[:, None] ^ g[None, :]).astype(np.int64)
            number = np.zeros(len(prints), np.uint64)
            for j in range(1, len(g)):
                number = number * np.uint64(131) + (distances[:, j] - distances[:, 0] + BITS).astype(np.uint64)
            columns.append(number)
        return np.stack(columns, axis=1)


@lru_cache
def _pivots(segments: int) -> Pivots:
    return Pivots(segments)


def _keyed(prints: DataFrame, segments: int, radius: int) -> DataFrame:
    """fp and choice, key for every choice of groups that may differ: fingerprints within the radius meet under one key at least."""
    chosen = list(combinations(range(segments), segments - radius))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = _pivots(segments)
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            profiles = pivots.profiles(own)
            for number, groups in enumerate(chosen):
                key = np.zeros(len(own), np.uint64)
                for g in groups:  # a mixed number; a clash would only bring more candidates together
                    key = (key ^ profiles[:, g]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                columns = [batch.column(0), pa.array(np.full(len(own), number, np.int32)), pa.array(key.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["fp", "choice", "key"])

    return prints.mapInArrow(make, "fp bigint, choice int, key bigint")


def near_pairs(own: np.ndarray, table: np.ndarray, radius: int, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs within the radius: blocks of rows against all later ones. A pair is dropped at the first coordinate that
    differs by more than the radius; what is left is verified on the bits."""
    for low in range(0, len(own), rows):
        i, j = np.nonzero(np.abs(table[low : low + rows, None, 0] - table[None, :, 0]) <= radius)
        i += low
        i, j = i[i < j], j[i < j]
        for c in range(1, table.shape[1]):
            if not len(i):
                break
            near = np.abs(table[i, c] - table[j, c]) <= radius
            i, j = i[near], j[near]
        near = np.bitwise_count(own[i] ^ own[j]) <= radius
        yield i[near], j[near]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Of the pairs, those that join parts not joined yet: the same components in fewer than n links."""
    parent, kept = list(range(n)), []
    for left, right in pairs:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            x, y = a, b
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[max(x, y)] = min(x, y)
                kept.append((a, b))
    return kept


def _linked(prints: DataFrame, segments: int, radius: int, most: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Links a, b within each set of up to `most` fingerprints, and the fingerprints of larger sets."""
    keyed = stored(_keyed(prints, segments, radius), "simhash-keys")
    sets = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    fit = sets.filter(F.col("n") <= most) if most else sets
    lists = keyed.join(fit.drop("n"), ["choice", "key"]).groupBy("choice", "key").agg(F.collect_list("fp").alias("fps"))
    large = keyed.join(sets.filter(F.col("n") > most).drop("n"), ["choice", "key"]).select("fp").distinct() if most else None

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = _pivots(segments)
        for batch in batches:
            found = [np.zeros((0, 2), np.int64)]
            for fps in batch.column(0):
                own = fps.values.to_numpy().view(np.uint64)
                at = forest(len(own), near_pairs(own, pivots.table(own), radius))
                if at:
                    found.append(own.view(np.int64)[np.array(at)])
            links = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    return lists.select("fps").mapInArrow(link, "a bigint, b bigint"), large


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links a, b between distinct fingerprints (`fp`) that give the components of all pairs within the radius."""
    links, large = _linked(prints, SEGMENTS, radius, HOT)
    links, large = stored(links, "simhash-links"), stored(large, "simhash-large")
    if large.isEmpty():
        return links
    return links.union(_linked(large, FINE_SEGMENTS, radius, None)[0])


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, fp, text_hash, keep_hash.

    component_id is the smallest doc_id reachable over fingerprints that differ in at most `radius` bits, null ids last; keep_hash
    is the text hash of that document. Null and empty texts have fingerprint zero and link like any other; fewer words than a
    shingle are one shingle. Repeated rows fall into one component; an empty table gives no rows; other columns are ignored.
    """
    rows = fingerprints(docs, words=words)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    prints = stored(rows.groupBy("fp").agg(first), "simhash-classes")
    roots = components(near_links(prints.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    classes = rooted.join(least, "root").select("fp", F.col("least.doc_id").alias("component_id"), F.col("least.text_hash").alias("keep_hash"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(classes, "fp").select("doc_id", hexed, "component_id", "fp", "text_hash", "keep_hash")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stand for their component, with all their columns."""
    found = near_duplicates(docs, **options)
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("keep_hash")))
    return semi(docs, kept.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
