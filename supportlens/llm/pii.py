"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans, which always stay. The field labels the words that hold a digit or an @ (no other word can be a
span) with a kind or none. Neighbouring words share potentials. So do the repeated and similar mentions of a document: words of the
same digits or letters, numbers that differ in one digit, and numbers of one ending behind other prefixes. All mentions of a group hang
on one shared node, and loopy message passing gives them one label, so that a number or address whose other mention was found is
found where its form alone would not tell.

The patterns are a one-sided teacher: what they find is personal data, but they miss some (a phone number with a card number behind
it matches as one run of too many digits). So words that no pattern took but that look like a kind (`doubt`) teach nothing, neither
as features nor in pairs; what has the form of no kind, or fails a kind's check sum, is taken for none.

One pass over the texts makes a compact table of words; training and labelling read that table only. The weights come from all
documents: the words' features by logistic regression on the base labels, the pair potentials from the counts of label pairs
(piecewise training): of neighbours, and of the mentions of one key in any documents.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supportlens.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
CHAIN, SKIP = 0, 1
#: Training uses at most this many different combinations of word features and label, sampled by hash; bounds the driver's memory.
TRAIN_SHAPES = 50_000
#: A word is labelled if its probability is at least this.
SURE = 0.9
#: Messages move by STEP of their way; after SETTLE rounds the step shrinks by SHRINK a round, so that every document comes to rest.
STEP, SETTLE, SHRINK, REST = 0.7, 50, 0.9, 1e-4
#: Score of a label that a pattern gives.
GIVEN = 30.0

_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MARKED = re.compile(r"[0-9@]")
_SPACE = re.compile(r"\s")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches that pass, sorted; kind by its place in KINDS."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (match := _DOMAIN.match(text, at)):
            end = match.end()
            found.append((start, 0, end))
        else:
            end = max(end, at + 1)  # nothing before this @ can be part of a later match
        at = text.find("@", at + 1)
    if _DIGITS.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if _is_ip(m[0])]
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() <= 37 else ""
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def marked_words(text: str) -> list[tuple[int, int]]:
    """Start and end of the words with a digit or an @, without marks around them."""
    words, done = [], 0
    for m in _MARKED.finditer(text):
        if m.start() < done:
            continue
        start = m.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        after = _SPACE.search(text, m.start())
        done = after.start() if after else len(text)
        end = done
        while start < m.start() and not (text[start].isalnum() or text[start] in "+(@"):
            start += 1
        while end > m.start() + 1 and not text[end - 1].isalnum():
            end -= 1
        words.append((start, end))
    return words


def _shape(word: str) -> int:
    """The word's features as bits."""
    digits, n = _digits(word), len(word)
    letters = sum(map(str.isalpha, word))
    d = len(digits)
    tests = (
        d == 0, d <= 2, d == 3, d == 4, d in (5, 6), d == 7, d in (8, 9), d in (10, 11), 12 <= d <= 15, d == 16, 17 <= d <= 19, d > 19,
        letters == 0, 0 < letters <= 3, letters > 3, letters > d, "@" in word, word.count("@") == 1 and "." in word[word.find("@") :],
        word.count(".") == 1, word.count(".") == 3, "-" in word, "(" in word, ")" in word, word[:1] == "+", "=" in word, '"' in word,
        "_" in word, any(c in word for c in "#$%&*!"), ":" in word or "/" in word, word.isupper(), word.count(".") == 3 and letters == 0 and _is_ip_like(word),
        letters == 0 and 12 <= d <= 19 and luhn(digits), n > 25, letters == 0 and d == n,
    )
    return sum(1 << i for i, test in enumerate(tests) if test)


def _is_ip_like(word: str) -> bool:
    return all(p.isascii() and p.isdigit() for p in word.split(".")) and _is_ip(word)


SHAPES = 34
#: Bits of the neighbours: the word before or after is marked too, and begins with +, or has brackets.
BITS = SHAPES + 5


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1 | 1


def _core(word: str) -> str:
    """Equal for words of the same digits (five and more) or else the same letters and digits; empty for short words."""
    digits = _digits(word)
    core = digits if len(digits) >= 5 and 2 * len(digits) > len(word) else "".join(filter(str.isalnum, word)).lower()
    return core if len(core) >= 5 else ""


def groups(cores: list[str]) -> list[int]:
    """For each word the number of its group of repeated or similar mentions, that of the group's first word; -1 for words alone.

    Similar are equal cores, numbers of 7 to 15 digits that end in the same seven, and numbers of 7 to 19 digits that differ in one. One
    kind of likeness is looked at after the other, so that memory is a few entries a word.
    """
    top = list(range(len(cores)))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    def join(items: Iterator[tuple[str, int]]) -> None:
        first: dict[str, int] = {}
        for key, i in items:
            a, b = find(first.setdefault(key, i)), find(i)
            top[max(a, b)] = min(a, b)

    join((c, i) for i, c in enumerate(cores) if c)
    numbers = [(c, i) for c, i in {c: i for i, c in reversed(list(enumerate(cores)))}.items() if 7 <= len(c) <= 19 and c.isdecimal()]
    join((c[-7:], i) for c, i in numbers if len(c) <= 15)
    for at in range(max((len(c) for c, _ in numbers), default=0)):
        join((f"{c[:at]}*{c[at + 1 :]}", i) for c, i in numbers if at < len(c))
    roots = [find(i) for i in range(len(cores))]
    size = Counter(roots)
    return [r if size[r] > 1 else -1 for r in roots]


def _doubtful(mask: int, phone: bool) -> bool:
    """Whether a word looks like a kind: an address, four numbers of an IP address, 12 to 19 digits that pass Luhn; or, by its run, a phone."""
    return bool(mask & (1 << 17 | 1 << 30 | 1 << 31)) or phone


def word_nodes(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """The marked words: place, feature bits, base label, doubt, key, group, digits, and whether they follow the marked word before
    directly."""
    words = marked_words(text)
    shapes = [_shape(text[a:b]) for a, b in words]
    adjacent = [False] + [b[0] - a[1] <= 4 and text[a[1] : b[0]].strip(" ()-.,\n\t") == "" for a, b in zip(words, words[1:])]
    cores = [_core(text[a:b]) for a, b in words]
    digits = [len(_digits(text[a:b])) for a, b in words]
    group = groups(cores)
    by_kind = [[x for x in spans if x[1] == k] for k in range(len(KINDS))]
    at = [0] * len(KINDS)
    nodes, dialled = [], False
    for i, (start, end) in enumerate(words):
        over = []
        for k, own in enumerate(by_kind):  # spans of one kind don't overlap
            while at[k] < len(own) and own[at[k]][2] <= start:
                at[k] += 1
            if at[k] < len(own) and own[at[k]][0] < end:
                over.append(own[at[k]])
        label = min(over)[1] + 1 if over else 0
        before, after = adjacent[i], i + 1 < len(words) and adjacent[i + 1]
        bits = (before, after, before and text[words[i - 1][0]] == "+", before and ")" in text[words[i - 1][0] : words[i - 1][1] + 1],
                after and "-" in text[words[i + 1][0] : words[i + 1][1]])
        mask = shapes[i] | sum(1 << (SHAPES + j) for j, b in enumerate(bits) if b)
        bare = bool(shapes[i] >> 12 & 1)
        dialled = bare and (text[start] in "+(" or (before and dialled))  # a run of numbers that began with + or a bracket
        doubt = not label and _doubtful(shapes[i], bare and (7 <= digits[i] <= 11 or dialled))
        nodes.append({"start": start, "end": end, "mask": mask, "label": label, "doubt": doubt, "key": _hash(cores[i]) if cores[i] else 0,
                      "group": group[i], "digits": digits[i], "adjacent": before})
    return nodes


_NODE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("mask", pa.int64()), ("label", pa.int32()), ("doubt", pa.bool_()), ("key", pa.int64()),
                   ("group", pa.int64()), ("digits", pa.int64()), ("adjacent", pa.bool_())])
_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_NODES = "array<struct<start:bigint,end:bigint,mask:bigint,label:int,doubt:boolean,key:bigint,group:bigint,digits:bigint,adjacent:boolean>>"


def pii_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base spans and marked words of every document, written once."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = text.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, nodes = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                found = base_spans(text)
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                nodes.append(word_nodes(text, found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(_SPAN)), pa.array(nodes, pa.list_(_NODE))], ["doc_id", "spans", "nodes"])

    return stored(text.mapInArrow(scan, f"doc_id {kind}, spans array<struct<start:bigint,kind:int,end:bigint>>, nodes {_NODES}"), "pii-rows")


def edges(group: np.ndarray, adjacent: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """from, to and type of the edges among words in order, and the documents of the shared nodes, which are numbered behind the
    words: neighbours, and each mention with its group's shared node, so that any number of mentions needs as many edges."""
    chain = np.flatnonzero(adjacent)
    known = np.flatnonzero(group >= 0)
    shared, number = np.unique(np.stack([doc[known], group[known]]), axis=1, return_inverse=True)
    types = np.concatenate([np.full(len(chain), CHAIN), np.full(len(known), SKIP)])
    left, right = np.concatenate([chain - 1, known]), np.concatenate([chain, len(doc) + number.reshape(-1)])
    return left, right, types, shared[0]


@dataclass
class Field:
    """weights: a row of label scores for each feature bit, the last one for any word. pairs: potentials by edge type. prior: label
    scores of shared nodes."""

    weights: np.ndarray
    pairs: np.ndarray
    prior: np.ndarray

    def marginals(self, mask: np.ndarray, known: np.ndarray, left: np.ndarray, right: np.ndarray, types: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Label probabilities of each word after loopy message passing; exact where the edges form no loop. doc: the document of each
        word and shared node. known: labels of the words that patterns took, which are given, or 0. A document's messages stop when they
        are at rest, whatever other documents do."""
        own = np.concatenate([_bits(mask) @ self.weights, np.tile(self.prior, (len(doc) - len(mask), 1))])
        given = np.flatnonzero(known)
        own[given] = GIVEN * np.eye(len(LABELS))[known[given]]
        n_edges = len(left)
        src, dst = np.concatenate([left, right]), np.concatenate([right, left])
        potential = np.concatenate([self.pairs[types], self.pairs[types].transpose(0, 2, 1)])
        messages = np.zeros((2 * n_edges, len(LABELS)))
        live, step, rounds = np.arange(n_edges), STEP, 0
        while len(live):
            both = np.concatenate([live, live + n_edges])
            back = np.concatenate([live + n_edges, live])
            nodes, place = np.unique(dst[both], return_inverse=True)
            belief = own[nodes]
            np.add.at(belief, place, messages[both])
            came = belief[np.searchsorted(nodes, src[both])] - messages[back]
            out = _log_sum(potential[both] + came[:, :, None], 1)
            out -= _log_sum(out, 1)[:, None]
            moved = np.zeros(int(doc.max()) + 1)
            np.maximum.at(moved, doc[src[both]], step * np.abs(out - messages[both]).max(axis=1))
            messages[both] += step * (out - messages[both])
            live = live[moved[doc[src[live]]] >= REST]
            rounds += 1
            step *= SHRINK if rounds > SETTLE else 1
        np.add.at(own, dst, messages)
        own = own[: len(mask)]
        return np.exp(own - _log_sum(own, 1)[:, None])


def _bits(mask: np.ndarray) -> np.ndarray:
    bits = (mask[:, None] >> np.arange(BITS)[None, :] & 1).astype(float)
    return np.concatenate([bits, np.ones((len(mask), 1))], axis=1)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def fit(shapes: list[tuple[int, int, int]], pairs: np.ndarray, steps: int = 400) -> Field:
    """From (feature bits, label, count) and counts of label pairs by edge type. Without words the field labels nothing."""
    weights = np.zeros((BITS + 1, len(LABELS)))
    weights[-1, 0] = 4.0
    if shapes:
        mask, label, count = (np.array(x) for x in zip(*shapes, strict=True))
        x, y, share = _bits(mask), np.eye(len(LABELS))[label], count / count.sum()
        share = np.sqrt(share)
        share /= share.sum()
        pace = np.zeros_like(weights)
        for _ in range(steps):  # gradient steps with the usual per-weight scale
            own = x @ weights
            p = np.exp(own - _log_sum(own, 1)[:, None])
            grad = x.T @ ((p - y) * share[:, None]) + 1e-5 * weights
            pace += grad**2
            weights -= 0.5 * grad / np.sqrt(pace + 1e-10)
    both = pairs + pairs.transpose(0, 2, 1)
    chain = (both[CHAIN] + 0.5) / (both[CHAIN] + 0.5).sum()
    alone = chain.sum(axis=1)
    # mentions agree at one rate for all labels, which few pairs tell: a mention takes the other's label or else any
    share = (both[SKIP] + 0.1).sum(axis=1) / (both[SKIP] + 0.1).sum()
    same, by_chance = (np.trace(both[SKIP]) + 0.5) / (both[SKIP].sum() + 1), (share**2).sum()
    rate = max(0.0, (same - by_chance) / (1 - by_chance))
    skip = np.log(rate * np.diag(1 / share) + 1 - rate)
    return Field(weights, np.stack([np.log(chain / (alone[:, None] * alone[None, :])), skip]), np.log(share))


def _flat(batch_nodes: pa.ListArray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The nodes of a batch as arrays, and the row of each."""
    at = batch_nodes.offsets.to_numpy()
    flat = batch_nodes.flatten()
    columns = {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in _NODE}
    return columns, np.repeat(np.arange(len(at) - 1), np.diff(at))


def train(rows: DataFrame) -> Field:
    """The field of all documents' words."""
    words = rows.select(F.inline("nodes")).where("not doubt")
    shapes = words.groupBy("mask", "label").count()
    shapes = [tuple(r) for r in shapes.orderBy(F.xxhash64("mask", "label"), "mask", "label").limit(TRAIN_SHAPES).collect()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(LABELS), len(LABELS)), np.int64)
        for batch in batches:
            nodes, _ = _flat(batch.column(0))
            right = np.flatnonzero(nodes["adjacent"])
            right = right[~(nodes["doubt"][right] | nodes["doubt"][right - 1])]
            np.add.at(total, (nodes["label"][right - 1], nodes["label"][right]), 1)
        place = np.argwhere(total)
        columns = [pa.array(place[:, i].astype(np.int32)) for i in range(2)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(total[tuple(place.T)])], ["a", "b", "n"])

    pairs = np.zeros((2, len(LABELS), len(LABELS)))
    for r in rows.select("nodes").mapInArrow(count, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        pairs[CHAIN, r["a"], r["b"]] = r["n"]
    kinds = range(len(LABELS))
    keys = words.where("key != 0").groupBy("key").agg(*[F.count_if(F.col("label") == k).alias(f"n{k}") for k in kinds])
    # n mentions of a key weigh n - 1 pairs, in whole thousandths so that their sum has one value
    n = sum((F.col(f"n{k}") for k in kinds), F.lit(0))
    ways = {(a, b): F.col(f"n{a}") * (F.col(f"n{b}") - int(a == b)) for a in kinds for b in kinds}
    sums = keys.where(n > 1).agg(*[F.sum(F.floor(1000.0 * w / n).cast("long")).alias(f"p{a}{b}") for (a, b), w in ways.items()]).first()
    for a, b in ways:
        pairs[SKIP, a, b] = (sums[f"p{a}{b}"] or 0) / 1000
    return fit(shapes, pairs)


def _added(nodes: dict[str, np.ndarray], lo: int, hi: int, label: np.ndarray, spans: list[dict]) -> list[tuple[int, int, int]]:
    """Spans of a document's labelled words outside the base spans; neighbours of one kind are one span. A span must have what its kind
    can't do without."""
    found, i = [], lo
    while i < hi:
        if not label[i] or nodes["label"][i]:
            i += 1
            continue
        j = i + 1
        while j < hi and label[j] == label[i] and nodes["adjacent"][j] and not nodes["label"][j] and label[i] >= 3:
            j += 1
        start, end, kind = int(nodes["start"][i]), int(nodes["end"][j - 1]), int(label[i]) - 1
        if _plausible(kind, nodes["mask"][i:j], int(nodes["digits"][i:j].sum())) and all(s["end"] <= start or s["start"] >= end for s in spans):
            found.append((start, kind, end))
        i = j
    return found


def _plausible(kind: int, masks: np.ndarray, digits: int) -> bool:
    """email: an @ with a dot behind it; ip: four numbers; card: 12 to 19 digits without letters; phone: 7 to 15 digits without letters."""
    has = lambda bit: bool((masks >> bit & 1).any())
    lettered = has(13) or has(14)
    if kind == 0:
        return has(17)
    if kind == 1:
        return has(30)
    return not lettered and (12 <= digits <= 19 if kind == 2 else 7 <= digits <= 15)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def labelled(rows: DataFrame, model: Field) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added), n_added."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, doc = _flat(batch.column(2))
            left, right, types, shared = edges(nodes["group"], nodes["adjacent"], doc)
            p = model.marginals(nodes["mask"], nodes["label"], left, right, types, np.concatenate([doc, shared]))
            found = np.where(p.max(axis=1) >= SURE, p.argmax(axis=1), 0) if len(p) else np.zeros(0, int)
            ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            out = []
            for i, spans in enumerate(batch.column(1).to_pylist()):
                base = [(s["start"], s["kind"], s["end"]) for s in spans]
                more = _added(nodes, int(ends[i]), int(ends[i + 1]), found, spans) if ends[i] < ends[i + 1] else []
                sha = hashlib.sha256(_joined(base).encode()).hexdigest()
                out.append((*(sum(k == n for _, k, _ in base) for n in range(4)), sha, _joined(base + more), len(more)))
            columns = list(zip(*out, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], _NAMES)

    return rows.select("doc_id", "spans", "nodes").mapInArrow(
        label, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"
    )


_NAMES = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: the columns of `labelled`.

    Null and empty texts have no spans ('' and its hash); repeated rows, null ids and clashing column names are no matter; an empty
    table gives no rows. Work and memory of a document grow with its marked words, also where one word repeats.
    """
    rows = pii_rows(docs)
    return labelled(rows, train(rows))
