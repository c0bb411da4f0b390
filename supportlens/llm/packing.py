"""Best-fit packing by exact-complement hashing.

Documents become pieces of at most `capacity` tokens. What decides a packing is how many pieces there are of each length,
at most `capacity` numbers: on these, sums of one, two and three lengths are looked up that fill a gap exactly, used
as often as the pieces suffice, and what is left goes best-fit. The plan says for ranges of ranks within a length which
sequences and offsets they get; Spark ranks the pieces and looks their places up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from supportlens.llm import tokens
from supportlens.llm.common import stored

CAPACITY = 2048
END_ID = 0
#: Pieces ranked by one task, about.
RANKED = 50_000

Pattern = tuple[int, ...]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, and before them what is left over."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = text.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokens.ByteEncoder, vocabulary)
        for batch in batches:
            at, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, data in enumerate(encoder.encoded(value.as_py() or "" for value in batch.column(1))):
                data += end
                for k, (s, n) in enumerate(cuts(len(data) // 4, capacity)):
                    part = data[4 * s : 4 * (s + n)]
                    at.append(i), piece.append(k), start.append(s), length.append(n), crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype("int32"))
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names + ["ids"] * with_ids)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return text.mapInArrow(cut, schema)


class _Exact:
    """Availability by length, with an index of the sums that pairs can make."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        there = (counts > 0).astype(float)
        sums = np.convolve(there, there)[: len(counts)]
        self.pair_possible = sums > 0.5  # falls behind as pieces go; a sum that fails is struck out

    def take(self, lengths: Pattern) -> int:
        """Uses the combination as often as all its lengths suffice."""
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        times = min(int(self.counts[x]) // k for x, k in need.items())
        for x, k in need.items():
            self.counts[x] -= times * k
        return times

    def pair(self, total: int, other: Pattern) -> Pattern | None:
        """Two available lengths of that sum beside those of `other`, the largest first."""
        if total < 2 or not self.pair_possible[total]:
            return None
        a = np.arange(total - 1, (total - 1) // 2, -1)
        a = a[(self.counts[a] > 0) & (self.counts[total - a] > 0)]
        for x in a.tolist():
            if self.enough((*other, x, total - x)):
                return x, total - x
        if not len(a):
            self.pair_possible[total] = False
        return None

    def enough(self, lengths: Pattern) -> bool:
        return all(self.counts[x] >= lengths.count(x) for x in set(lengths))

    def complement(self, length: int, gap: int, most: int) -> Pattern | None:
        """Up to `most` (one, two or three) available lengths that fill the gap beside `length`."""
        if self.enough((length, gap)):
            return (gap,)
        if most > 1 and (two := self.pair(gap, (length,))):
            return two
        if most > 2:
            a = np.arange(gap - 2, (gap - 1) // 3, -1)
            a = a[a > 0]
            a = a[(self.counts[a] > 0) & self.pair_possible[gap - a]]
            for x in a.tolist():
                if two := self.pair(gap - x, (length, x)):
                    return (x, *two)
        return None


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns of lengths and how many sequences are filled so, from the number of pieces of each length.

    Exact fills by more pieces can leave large pieces without a small one, so that plans with exact fills of up to two,
    three and four pieces are made and the one with the fewest sequences is used.
    """
    return min((_plan(counts, capacity, most) for most in (1, 2, 3)), key=lambda patterns: sum(t for _, t in patterns))


def _plan(counts: np.ndarray, capacity: int, most: int) -> list[tuple[Pattern, int]]:
    counts = np.array(counts, np.int64)
    made = [((capacity,), int(counts[capacity]))] if counts[capacity] else []
    counts[capacity] = 0
    exact = _Exact(counts)
    for upto in range(1, most + 1):
        for length in range(capacity - 1, 0, -1):
            while counts[length] and (rest := exact.complement(length, capacity - length, upto)):
                made.append(((length, *rest), exact.take((length, *rest))))
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    gaps = np.zeros(capacity + 1, bool)

    def put(pattern: Pattern, times: int) -> None:
        gap = capacity - sum(pattern)
        open_.setdefault(gap, []).append((pattern, times))
        gaps[gap] = True

    for length in range(capacity - 1, 0, -1):
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(gaps[length:])
            if not len(fits):
                each = capacity // length
                if left >= each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                break
            gap = length + int(fits[0])
            pattern, times = open_[gap].pop()
            used = min(times, left)
            if used < times:
                open_[gap].append((pattern, times - used))
            gaps[gap] = bool(open_[gap])
            put((*pattern, length), used)
            left -= used
    return made + [x for bins in open_.values() for x in bins]


def places(patterns: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: pieces of a length from that rank on go to the sequences from
    that one on, at that offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + times
            offset += length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def ranked(rows: DataFrame, n: int) -> DataFrame:
    """`rows` with their rank among those of their length, from 0. A length is dealt over buckets, whose counts give each
    bucket's first rank, so that a frequent length isn't ranked by one task."""
    buckets = max(1, -(-n // RANKED))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    sizes = rows.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("row")) - 1
    return rows.withColumn("own", own).join(starts, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("own"))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces (any columns, `length` among them) with sequence_id and offset. Lengths lie between 1 and `capacity`."""
    names = cut.columns
    rows = stored(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in rows.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    table = places(plan(counts, capacity))
    keys = table[:, 0] << 40 | table[:, 1]
    held = ranked(rows, int(counts.sum())).select(*names, "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(names.index("length")).to_numpy(), batch.column(len(names)).to_numpy())
            at = np.searchsorted(keys, length.astype(np.int64) << 40 | rank, "right") - 1
            found = [pa.array(table[at, 2] + rank - table[at, 1]), pa.array(table[at, 3])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return held.mapInArrow(place, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null and empty texts are their end token alone; longer documents than `capacity` are cut, the first piece taking what is
    left over. Repeated rows and null ids are packed like others. An empty table gives no rows. Other columns are ignored.
    """
    path = vocabulary or tokens.vocabulary("byte_bpe_50k.json")
    return pack(pieces(docs, path, capacity, with_ids=with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces with ids: sequence_id, ids. A sequence holds at most the capacity's tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
