import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from supportlens.llm import packing, token_files, tokens
from supportlens.llm.packing import CAPACITY

BYTE, WORD = tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("word_bpe_49k.json")
ODD = ["", " ", "\n", " a", "a ", "a\n", "\na", "a\n\nb", "a  b", "it's I'll 'tis", "x y\u0085z", "é ́e", "\x1ca\x1fb",
       "ΟΔΟΣ ΣΑΣ", "<|endoftext|> a<|startoftext|>b", "１２ ½ x²", "a \n b", "\t\ta", "日本語 テキスト", "İstanbul", "a" * 5000, "İı ſß Ⱥ µª º²½ ÷× Ÿ", "it'S 're''s 'LL", "a_b__c --- ³x9¼", "\xad\xa0x \x7f y"]


def whole(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("kind, path", [(tokens.ByteEncoder, BYTE), (tokens.WordEncoder, WORD)])
def test_chunks_encode_like_whole_texts(small_docs, kind, path):
    encode, want = kind(path), whole(path)
    rng = random.Random(3)
    mixed = ["".join(rng.choices(["a", "B", " ", "\n", "'s", ".", "7", "é", "́", "　", "\x1d", "\t", "ß", "_", "Ÿ", "²", "İ", "½", "+", "É", "\xad"], k=12)) for _ in range(3000)]
    mixed += ["".join(rng.choices(["ab", "Cd", " ", ". ", ", ", ".", "\\n", "é"], k=9)) for _ in range(3000)]
    texts = ODD + mixed + [r.text for r in small_docs.limit(60).collect()]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == want(text), repr(text[:80])


@pytest.mark.parametrize("at_once", [1, 40, 1 << 20])
def test_texts_cut_together_encode_like_whole_texts(monkeypatch, at_once):
    monkeypatch.setattr(tokens, "AT_ONCE", at_once)
    encoder, want = tokens.ByteEncoder(BYTE), whole(BYTE)
    rng = random.Random(4)
    bits = ["a", "It", "'", "'", "s", "re", "ll", "ve", "m", "'d", "T", " ", " ", "\n", "7", "²", "é", "Ÿ", "ſ", "İ", "’", "“", "語", "́", "-", "\t", "\xa0", "\u2003", "\x1c", "\xad"]
    texts = ["".join(rng.choices(bits[: rng.choice([16, 20, 30])], k=rng.randrange(9))) for _ in range(6000)] + ODD
    texts += ["it'", "s ok", "'", "'", "re", "", "'r", "e", " ", " a", "\n", "\n", "é'", "ll"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encoded(iter(texts))]
    for text, ids in zip(texts, got, strict=True):
        assert ids == want(text), repr(text)
    assert list(encoder.encoded([])) == []


def test_parts_are_encoded_once_however_many_there_are(monkeypatch):
    """Texts of more different words than are remembered used to encode every word again, and every combination of word and mark."""
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    encoder, calls = tokens.ByteEncoder(BYTE), []
    owner = encoder.parts if hasattr(encoder, "parts") else encoder.first.parts
    tokenize = owner.tokenize
    owner.tokenize = lambda text: calls.append(text) or tokenize(text)
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(300)]
    texts = [" " + " ".join(w + mark for w in words) for mark in ("", ",", ".", ";", "")]
    encode = getattr(encoder, "encoded", lambda texts: map(encoder, texts))
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts)]
    assert got == [whole(BYTE)(text) for text in texts]
    assert len(calls) == len(set(calls)) == 303


@pytest.mark.parametrize("at_once", [1, 40, 1 << 20])
def test_words_cut_together_encode_like_whole_texts(monkeypatch, at_once):
    monkeypatch.setattr(tokens, "AT_ONCE", at_once)
    encoder, want = tokens.WordEncoder(WORD), whole(WORD)
    rng = random.Random(5)
    bits = ["a", "It", "'", "'", "S", "re", "LL", "ve", "m", "'d", "T", " ", " ", "\n", "7", "²", "É", "Ÿ", "ſ", "İ", "’", "“", "語", "́", "-", "\t", "\xa0", "\u2003", "\x1c", "\xad", "H", "\u0331", "Σ", "\x85", "ŉ", "K"]
    texts = ["".join(rng.choices(bits[: rng.choice([16, 20, 30, 36])], k=rng.randrange(9))) for _ in range(6000)] + ODD
    texts += ["it'", "s ok", "'", "'", "re", "", "'r", "e", " ", " a", "\n", "\n", "é'", "ll", "12", "3", "²", "²x", "\xa0", "\xa0 '\xa0s"]
    texts += [f"a{chr(c)}b {chr(c)}' {chr(c)}'s{chr(c)}{chr(c)}" for c in [*range(0x250), 0x345, 0x1680, 0x2028, 0x212A, 0x212B, 0x3000, 0x1F600]]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encoded(iter(texts))]
    for text, ids in zip(texts, got, strict=True):
        assert ids == want(text), repr(text)
    assert list(encoder.encoded([])) == [] and list(encoder.encoded(["", " \n"])) == [b"", b""]


def test_words_are_encoded_once_however_many_there_are(monkeypatch):
    """op9's encoder went chunk by chunk and encoded a word again each time that more words than are remembered stood between."""
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    encoder, calls = tokens.WordEncoder(WORD), []
    owner = encoder.parts if hasattr(encoder, "parts") else encoder.chunks.parts
    tokenize = owner.tokenize
    owner.tokenize = lambda text: calls.append(text) or tokenize(text)
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(300)]
    texts = [" ".join(w + mark for w in words) for mark in ("", ",", ".", ";", "")] + [" ".join(words).title()]
    encode = getattr(encoder, "encoded", lambda texts: map(encoder, texts))
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts)]
    assert got == [whole(WORD)(text) for text in texts]
    assert len(calls) == len(set(calls)) == 303


@pytest.mark.parametrize("kind, path", [(tokens.ByteEncoder, BYTE), (tokens.WordEncoder, WORD)])
def test_memory_is_bounded_and_keeps_what_comes_again(monkeypatch, kind, path):
    for name, value in {"AT_ONCE": 40, "REMEMBERED": 20, "LONGEST_REMEMBERED": 6}.items():
        monkeypatch.setattr(tokens, name, value)
    encoder, want = kind(path), whole(path)
    rng = random.Random(6)
    texts = [" ".join(["often", *("".join(rng.choices("abcÉ語", k=rng.randrange(1, 9))) for _ in range(5))]) for _ in range(2000)]
    calls, tokenize = [], encoder.parts.tokenize
    encoder.parts.tokenize = lambda text: calls.append(text) or tokenize(text)
    for i, ids in enumerate(encoder.encoded(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == want(texts[i]), texts[i]
        assert len(encoder.memory.parts) <= 20
    assert len(encoder.memory.sizes) == len(encoder.memory.met) == len(encoder.memory.parts)
    assert encoder.memory.sizes.sum() == len(encoder.memory.ids)
    assert calls.count("often") + calls.count("Ġoften") <= 2


def check_packed(rows, docs):
    """Every document is cut as asked and every sequence is filled without gaps or overlaps."""
    encode = whole(BYTE)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in docs:
        ids = np.array([*encode(text or ""), 0], "<u4")
        mine = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert [r.piece for r in mine] == list(range(len(mine)))
        assert sum(r.length for r in mine) == len(ids) and all(r.length == CAPACITY for r in mine[1:])
        at = 0
        for r in mine:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return len(by_seq), sum(r.length for r in rows)


def test_packing_round_trip(small_docs):
    rows = packing.pack_documents(small_docs).collect()
    n, total = check_packed(rows, [(r.doc_id, r.text) for r in small_docs.collect()])
    assert n <= -(-total // CAPACITY) + 1


def test_packing_odd_documents(odd_docs, no_docs):
    packed = packing.pack_documents(odd_docs, with_ids=True)
    rows = packed.collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 1 and sum(r.doc_id == 4 for r in rows) == 2
    assert sorted({r.doc_id for r in rows if r.doc_id is not None}) == [1, 2, 3, 4, 5, 6, 7, 8]
    sequences = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    assert sum(map(len, sequences.values())) == sum(r.length for r in rows)
    assert packing.pack_documents(no_docs).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(CAPACITY + 1, np.int64)
    for length in rng.integers(1, CAPACITY + 1, [0, 1, 50, 2000, 20_000, 3000][seed]):
        counts[length // (6 if seed == 5 else 1) + (length < 6)] += 1
    patterns = packing.plan(counts)
    back = np.zeros_like(counts)
    for pattern, times in patterns:
        assert times > 0 and sum(pattern) <= CAPACITY
        for length in pattern:
            back[length] += times
    assert (back == counts).all()
    used, least = sum(t for _, t in patterns), -(-int((counts * np.arange(CAPACITY + 1)).sum()) // CAPACITY)
    assert used <= least * 1.02 + 1 if seed != 2 else used <= least * 1.3


def test_exact_complements_are_found():
    counts = np.zeros(CAPACITY + 1, np.int64)
    for length, n in {2000: 5, 48: 5, 1500: 3, 300: 3, 248: 3, 1100: 2, 500: 2, 400: 2, 49 - 1: 0, 1024: 4}.items():
        counts[length] += n
    patterns = dict(packing.plan(counts))
    assert patterns == {(2000, 48): 5, (1500, 300, 248): 3, (1100, 500, 400): 2, (1024, 1024): 2} or sum(patterns.values()) == 12


def test_token_files_round_trip(spark, small_docs, tmp_path):
    encode = whole(WORD)
    for encoding in ("dictionary", "delta"):
        rows = sorted(token_files.token_round_trip(small_docs, encoding=encoding).collect(), key=lambda r: r.doc_id)
        start = 0
        for r, d in zip(rows, sorted(small_docs.collect(), key=lambda r: r.doc_id), strict=True):
            ids = [*encode(d.text), 1]
            assert (r.doc_id, r.start, r.n_tokens) == (d.doc_id, start, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
            start += len(ids)


def test_token_files_layout(spark, small_docs, tmp_path):
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "files")
    token_files.write_token_files(small_docs, path, row_group=1 << 20, page=1 << 12, encoding="delta")
    files = sorted(glob.glob(path + "/*.parquet"))
    last = -1
    for f in files:
        meta = pq.ParquetFile(f).metadata
        ids = pq.read_table(f).column("doc_id").to_pylist()
        assert ids == sorted(ids) and (not ids or ids[0] > last)
        last = ids[-1] if ids else last
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(meta.num_columns - 1)
            assert "DELTA_BINARY_PACKED" in column.encodings and column.has_column_index
    part = token_files.read_token_files(spark, path, 20, 25)
    assert sorted(r.doc_id for r in part.select("doc_id").collect()) == list(range(20, 26))
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,20)" in part._jdf.queryExecution().toString()


def test_token_files_odd_documents(odd_docs, no_docs):
    rows = token_files.token_round_trip(odd_docs).collect()
    assert len(rows) == 10 and sum(r.n_tokens == 1 for r in rows) == 3
    spans = sorted((r.start, r.n_tokens) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert min(rows, key=lambda r: r.start).doc_id is None
    assert token_files.token_round_trip(no_docs).collect() == []
