import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from supportlens.llm import spelling

LOWER = {c: c + 32 for c in range(65, 91)}


def brute_words(rows, least=6, least_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= least_count}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, times=5):
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= times * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def found(docs, **options):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_forms(docs, **options).collect()}


def variants(seed, alphabet="abÀß", words=40):
    """Texts of words that are often edits of each other, over few letters, so that letters repeat."""
    rng = random.Random(seed)
    base = ["".join(rng.choices(alphabet, k=rng.randint(6, 9))) for _ in range(words)]
    for w in base[:]:
        i = rng.randrange(len(w))
        base += [w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:], w[:i] + rng.choice(alphabet) + w[i + 1 :]]
    return [(i, " ".join(rng.choice(base[: 1 + int(len(base) * rng.random() ** 3)]) for _ in range(400))) for i in range(20)]


@pytest.mark.parametrize("seed, bits", [(1, 1 << 28), (2, 1 << 28), (3, 512)])
def test_like_all_pairs(make_docs, monkeypatch, seed, bits):
    """512 bits: the filters are made and probed in many parts."""
    monkeypatch.setattr(spelling, "FILTER_BITS", bits)
    rows = variants(seed)
    want = brute(brute_words(rows))
    assert found(make_docs(*rows)) == want
    assert any(form for _, form, *_ in want) and any(near > 3 for *_, near, _ in want)


def test_text_table_like_all_pairs(small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    words = brute_words(rows, least_count=8)
    assert found(small_docs, least_count=8) == brute(words)


def test_odd_documents(make_docs, odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert found(odd_docs, least=3, least_count=2) == brute(brute_words(rows, 3, 2))


def test_words_of_any_length_and_null_ids(make_docs):
    long = "x" * 300 + "y" * 20_000
    texts = [f"{long} {long}z", "Straße STRAßE Straßen ÀBCDEF Àbcdef àbcdef", "", None]
    rows = [(None if i % 2 else i, t) for i in range(6) for t in texts]
    assert found(make_docs(*rows)) == brute(brute_words(rows))


def test_chain_of_forms(make_docs):
    """Each word's form has a form of its own; of equally frequent ones the first in code-point order counts."""
    rows = [(1, " ".join(["abcdefg"] * 125 + ["abcdefh"] * 125 + ["abcdef"] * 25 + ["bcdef"] * 9 + ["abcdeé"] * 5))]
    want = brute(brute_words(rows, least=5), times=5)
    assert found(make_docs(*rows), least=5) == want
    assert ("abcdeé", "abcdef", "abcdefg", 5, 1, 25) in want


def test_empty_tables(make_docs, no_docs):
    for docs in (no_docs, make_docs((1, "five words that are rare"))):
        out = spelling.spelling_forms(docs)
        assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_edits_are_whole_and_unique():
    """With a filter that takes all, every deletion and later replacement comes up once, with the sum of its spelling."""
    letters = np.array(sorted(map(ord, "abcé")), np.uint32)
    for word in ("aabba", "cébcaa", "bbb"):
        codes = np.array([[ord(c) for c in word]], np.uint32)
        made, sums = [], []
        take = lambda s, length: sums.extend(zip(s.tolist(), [length] * s.size)) or np.ones(s.shape, bool)
        for i, rows, new in spelling.edits(codes, letters, take):
            made += [word[:i] + ("" if new is None else chr(new[k])) + word[i + 1 :] for k in range(len(rows))]
        want = {word[:i] + word[i + 1 :] for i in range(len(word))}
        want |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in "abcé" if c > word[i]}
        assert sorted(made) == sorted(want)
        for spelt, (total, length) in zip(made, sums, strict=True):
            own = np.array([ord(c) for c in spelt], np.uint64)
            assert length == len(spelt) and total == int((own * spelling._powers(len(spelt))).sum(dtype=np.uint64))
