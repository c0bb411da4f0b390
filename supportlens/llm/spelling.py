"""Spelling variants: words of a corpus that differ by one code point, and the frequent form each of them leads to.

The vocabulary is counted in Spark. Its words go into blocked Bloom filters, one for each word length (one block is 64 bits, so
a probe reads one number), built by tasks, joined by bit-wise or, and broadcast. Each word's edits are generated and probed there:
deletions in the filter of the next shorter length, replacements by a later letter in the filter of its own. So each pair of near words
comes from one of its two ends only; insertions are the deletions of the other end. Edits that a filter takes for words are sent
on, and an exact join with the vocabulary removes the false ones.

Hashes of edits come from the word's own by a term each: a hash is a sum of letters times powers, mixed at the end, so that a task
makes and probes edits by arrays and spells out only those that pass.

The filters take at most FILTER_BITS at a time whatever the size of the vocabulary: a larger one is dealt into parts by hash, and
each part is filtered and probed in a pass of its own.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supportlens.llm.common import stored

#: Letters of words (fixed values), least length and least number of occurrences of a word, how much more frequent a form is.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: One in so many words of a document loses a letter, decided by the checksum of document and word.
DROPS = 199
#: Bits a word, bits set by a word, and bits of all filters of a pass (32 MB).
WORD_BITS, SET_BITS, FILTER_BITS = 16, 5, 1 << 28
#: Longer words share a filter.
LONG = 64
#: Words to a task of the probing, and words of one length that are worked on at once.
TASK_WORDS, ROWS = 10_000, 4096

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 2**64))


def lowered(run: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.octet_length(run) == F.char_length(run)
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, string.ascii_uppercase, string.ascii_lowercase))


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """word: one row for each run of at least `least` letters that is so long still after the letter it may lose."""
    # A run that is shorter can't become a word, and a longer one is taken whole, since matches are as long as can be.
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"([{LETTERS}]{{{least},}})"))).alias("run"),
    ).select("id", lowered(F.col("run")).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return runs.select(F.when(F.col("h") % DROPS == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.char_length("word") >= least)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of all words that occur often enough."""
    return occurrences(docs, id_col, text_col, least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and code points (a row a word) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        of = np.flatnonzero(lengths == length)
        step = max(1, min(ROWS, (ROWS << 6) // max(int(length), 1)))
        for at in range(0, len(of), step):
            part = of[at : at + step]
            codes = np.frombuffer("".join([words[i] for i in part]).encode("utf-32-le"), "<u4")
            yield part, codes.reshape(len(part), length)


def _powers(length: int) -> np.ndarray:
    return np.multiply.accumulate(np.full(length, _BASE, np.uint64))


class Filters:
    """Blocked Bloom filters by word length, in one array of blocks."""

    def __init__(self, counts: dict[int, int], part: int = 0, parts: int = 1):
        """counts: number of words by length (LONG and longer together)."""
        self.part, self.parts = part, parts
        self.size, self.start, at = np.zeros(LONG + 1, np.uint64), np.zeros(LONG + 1, np.uint64), 0
        for length, n in sorted(counts.items()):
            self.size[length], self.start[length] = max(1, math.ceil(n * WORD_BITS / 64 / parts)), at
            at += int(self.size[length])
        self.blocks = at

    def places(self, sums: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block, mask of bits, and whether the hash belongs to this part, for words of a length given by their sums."""
        h, shard = _mixed(sums), min(length, LONG)
        block = self.start[shard] + ((h >> _U(32)) * self.size[shard] >> _U(32))
        mask = np.zeros_like(h)
        for k in range(SET_BITS):
            mask |= _U(1) << (h >> _U(6 * k) & _U(63))
        own = _mixed(h ^ _BASE) % _U(self.parts) == self.part if self.parts > 1 else np.ones(h.shape, bool)
        return block, mask, own

    def added(self, words: DataFrame) -> np.ndarray:
        """The blocks with all `words` in them."""

        def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = np.zeros(self.blocks, np.uint64)
            for batch in batches:
                for _, codes in _by_length(batch.column(0).to_pylist()):
                    block, mask, own = self.places((codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64), codes.shape[1])
                    np.bitwise_or.at(blocks, block[own].astype(np.int64), mask[own])
            set_ = np.flatnonzero(blocks)
            for at in range(0, len(set_), 1 << 16):
                some = set_[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(blocks[some].view(np.int64))], ["block", "mask"])

        found = words.select("word").mapInArrow(fill, "block bigint, mask bigint").groupBy("block").agg(F.bit_or("mask").alias("mask")).toArrow()
        blocks = np.zeros(self.blocks, np.uint64)
        blocks[found["block"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
        return blocks

    def hold(self, blocks: np.ndarray, sums: np.ndarray, length: int) -> np.ndarray:
        """Which of the words of a length, given by their sums, are in the filter and this part."""
        if not self.size[min(length, LONG)]:
            return np.zeros(sums.shape, bool)
        block, mask, own = self.places(sums, length)
        return own & (blocks[block.astype(np.int64)] & mask == mask)


def edits(codes: np.ndarray, letters: np.ndarray, hold) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
    """Deletions, and replacements by a later letter, of words of one length that `hold(sums, length)`: place of the edit, rows, and
    the new letters (None: deleted). Each word comes up once, however it can be made."""
    length = codes.shape[1]
    powers = _powers(length)
    terms = codes * powers
    whole = terms.sum(axis=1, dtype=np.uint64)
    before = np.zeros(len(codes), np.uint64)
    for i in range(length):
        after = whole - before - terms[:, i]
        # Of equal letters in a row the first is deleted; deleting another one gives the same word.
        rows = np.flatnonzero(codes[:, i] != codes[:, i - 1]) if i else np.arange(len(codes))
        rows = rows[hold((before + after * _BACK)[rows], length - 1)]
        if len(rows):
            yield i, rows, None
        at, new = np.nonzero(letters[None, :] > codes[:, i, None])
        sums = (whole - terms[:, i])[at] + letters[new].astype(np.uint64) * powers[i]
        found = np.flatnonzero(hold(sums, length))
        if len(found):
            yield i, at[found], letters[new[found]]
        before = before + terms[:, i]


def candidates(words: DataFrame, filters: Filters, blocks, letters: np.ndarray) -> DataFrame:
    """word, n, other: the edits of `words` (word, n) that are in the filters. blocks: a broadcast variable."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold = lambda sums, length: filters.hold(blocks.value, sums, length)
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            for part, codes in _by_length(words):
                rows, other = [], []
                for i, of, new in edits(codes, letters, hold):
                    for k, row in enumerate(part[of].tolist()):
                        rows.append(row)
                        other.append(words[row][:i] + (chr(new[k]) if new is not None else "") + words[row][i + 1 :])
                    if len(rows) >= 1 << 16:
                        yield pa.RecordBatch.from_arrays([pa.array([words[r] for r in rows]), counts.take(pa.array(rows)), pa.array(other)], names)
                        rows, other = [], []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([words[r] for r in rows]), counts.take(pa.array(rows)), pa.array(other)], names)

    names = ["word", "n", "other"]
    return words.mapInArrow(probe, "word string, n bigint, other string")


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: each pair of words (word, n) that differ by one code point, once, from one of its ends."""
    spark = words.sparkSession
    length = F.least(F.char_length("word"), F.lit(LONG))
    counts = {row.length: row["count"] for row in words.groupBy(length.alias("length")).count().collect()}
    total = sum(counts.values())
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).distinct().collect()
    letters = np.array(sorted(ord(row.letter) for row in letters if row.letter), np.uint32)
    parts = max(1, math.ceil(total * WORD_BITS / FILTER_BITS))
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / TASK_WORDS))
    dealt = words.repartition(tasks, "word")
    found = None
    for part in range(parts):
        filters = Filters(counts, part, parts)
        blocks = spark.sparkContext.broadcast(filters.added(words))
        some = candidates(dealt, filters, blocks, letters)
        found = some if found is None else found.union(some)
    known = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    return found.join(known, "other").select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word on the way from each `word` of `forms` (word, form). Each round doubles the way looked ahead."""
    ways = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        moved = stored(ways.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "spelling-roots")
        ways = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return ways


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """One row per word of the vocabulary: word, form (its most frequent near word if that is `times` as frequent, else null), root (the
    last form on the way from it, itself if there is none), n, n_near, form_n.

    Null texts have no words. A null id counts as an empty one. Repeated rows count each. Of equally frequent near words the first in
    code-point order counts. An empty table, or one without frequent words, gives no rows. Other columns are ignored. Words of
    any length are taken whole.
    """
    words = stored(vocabulary(docs, id_col, text_col, least, least_count), "spelling-words")
    pairs = stored(near_pairs(words), "spelling-pairs")
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = pairs.union(back).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    formed = -F.col("best.less") >= F.lit(times) * F.col("n")
    near = near.select("word", "n_near", F.when(formed, F.col("best.form")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n"))
    near = stored(near, "spelling-near")
    ends = roots(near.filter("form is not null").select("word", "form"))
    rows = words.join(near, "word", "left").join(ends, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
