"""Token ids by the tokenizers library, as little-endian unsigned 32-bit bytes.

Both vocabularies treat what stands between white space on its own. Chunks of plain Latin letters are cut as the vocabulary's pattern
cuts them, and the parts are encoded by its model; all else (unusual separators, other scripts, for byte-level vocabularies also texts
with runs of white space) is encoded whole. Many texts are cut at once by numpy, and each of their different parts is encoded once and
remembered in Arrow arrays; this memory is bounded.
"""

from __future__ import annotations

import codecs
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts that a Python worker remembers, and their bytes at most.
REMEMBERED = 600_000
LONGEST_REMEMBERED = 48
#: Characters of texts that are cut together, about.
AT_ONCE = 8 << 20

_RUN = re.compile(r"\s\s")
_WHITE = "\t\n\x0b\x0c\r \x85\xa0"


def _kinds() -> bytes:
    """Classes of Latin-1 characters: white space, x separators, w all others."""
    kinds = ["w"] * 256
    for c in _WHITE:
        kinds[ord(c)] = " "
    for c in "\x1c\x1d\x1e\x1f":
        kinds[ord(c)] = "x"
    return "".join(kinds).encode()


_KINDS = _kinds()


def _kinds_of(text: str) -> bytes | None:
    """The classes of a text's characters, None if some are not Latin-1."""
    try:
        return text.encode("latin-1").translate(_KINDS)
    except UnicodeEncodeError:
        return None


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


#: Letters whose classes and lower case are beyond doubt, and their classes in the patterns.
_PLAIN = re.compile("[!-~¡-\u012f\u0131-\u017f]*")


def _visible() -> str:
    """Byte-level models spell bytes as visible characters: those that are visible as they are, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


_VISIBLE = _visible()


def _spelt(data: bytes) -> str:
    return codecs.charmap_decode(data, "strict", _VISIBLE)[0]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Whole:
    """Texts that are encoded whole."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def made(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


class _Spelt:
    """Parts, as they are spelt, that the model encodes on their own."""

    def __init__(self, tokenizer):
        self.tokenize = tokenizer.model.tokenize

    def made(self, text: str) -> bytes:
        return _packed([t.id for t in self.tokenize(text)])


class _Memory:
    """Parts and their ids, one part's behind the other's."""

    def __init__(self):
        self.parts = pa.array([], pa.large_binary())
        self.sizes, self.ids, self.met = np.zeros(0, np.int64), np.zeros(0, "<u4"), np.zeros(0, bool)

    def places(self, parts: pa.LargeBinaryArray) -> np.ndarray:
        """Where the parts stand, -1 for new ones."""
        at = pc.index_in(parts, value_set=self.parts).fill_null(-1).to_numpy().astype(np.int64)
        self.met[at[at >= 0]] = True
        return at

    def add(self, parts: pa.LargeBinaryArray, made: list[bytes]) -> None:
        """New parts go behind the others."""
        self.parts = pa.concat_arrays([self.parts, parts])
        self.sizes = np.append(self.sizes, np.fromiter(map(len, made), np.int64, len(made)) // 4)
        self.ids = np.append(self.ids, np.frombuffer(b"".join(made), "<u4"))
        self.met = np.append(self.met, np.zeros(len(made), bool))

    def trim(self) -> None:
        """Long parts go. When there are too many, what was not met again since the last time goes too, and of the rest the latest stay, for
        which half the room suffices."""
        kept = pc.binary_length(self.parts).to_numpy() <= LONGEST_REMEMBERED
        if len(kept) > REMEMBERED:
            kept &= self.met
            kept[np.flatnonzero(kept)[: -(REMEMBERED // 2)]] = False
            self.met[:] = False
        if not kept.all():
            self.ids = self.ids[np.repeat(kept, self.sizes)]
            self.parts, self.sizes, self.met = self.parts.filter(pa.array(kept)), self.sizes[kept], self.met[kept]


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # a special token's string in a text is ordinary text
    return tokenizer


_ODD, _SPACE, _LINE, _LETTER, _NUMBER, _MARK = range(6)


def _classes() -> np.ndarray:
    """Classes of the characters below U+0180 in the byte-level pattern; odd ones are left to the library."""
    of = {"L": _LETTER, "N": _NUMBER}
    plain = [of.get(unicodedata.category(c)[0], _MARK) if _PLAIN.fullmatch(c) else _ODD for c in map(chr, range(0x180))]
    plain[ord(" ")], plain[ord("\n")] = _SPACE, _LINE
    return np.array(plain, np.uint8)


_CLASSES = _classes()
_BYTE_CLASSES = np.append(_CLASSES[:0x80], np.full(0x80, _ODD, np.uint8))
_WORD_CLASSES = _CLASSES.copy()
_WORD_CLASSES[list(map(ord, _WHITE))] = _SPACE
_WORD_BYTE_CLASSES = np.append(_WORD_CLASSES[:0x80], np.full(0x80, _ODD, np.uint8))
#: Lower case of the characters below U+0180 that are not odd; none needs more or fewer bytes.
_LOWER = np.array([ord(chr(c).lower()) if _CLASSES[c] else c for c in range(0x180)], np.uint16)
_BYTE_LOWER = np.append(_LOWER[:0x80], np.arange(0x80, 0x100)).astype(np.uint8)
_SHORT, _LONG = (np.array([int.from_bytes(x) for x in ends], np.uint16) for ends in ([b"s", b"t", b"m", b"d"], [b"re", b"ve", b"ll"]))


def _translated(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[data] for bytes."""
    return np.frombuffer(bytearray(data).translate(table.tobytes()), np.uint8)


def _pairs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the characters of two bytes up to U+017F stand, and which these are."""
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xC5))
    return lead, (data[lead].astype(np.uint16) & 31) << 6 | data[lead + 1] & 63


def _with_endings(part: np.ndarray, text: np.ndarray, quote: np.ndarray, data: np.ndarray) -> None:
    """Moves the cuts behind quotes where 's and its like are parts. `text`: where texts begin."""
    quote = quote[~text[quote + 1]]
    short = quote[np.isin(data[quote + 1], _SHORT)]
    quote = quote[~text[quote + 2]]
    long = quote[np.isin(data[quote + 1].astype(np.uint16) << 8 | data[quote + 2], _LONG)]
    part[short + 1] = part[long + 1] = False
    part[short + 2] = part[long + 3] = True


def _with_odd_whole(part: np.ndarray, chunk: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cuts but those in chunks with odd characters, and which parts are such chunks."""
    n = len(classes)
    cuts = np.flatnonzero(part[: n + 1])
    odd = np.flatnonzero(classes == _ODD)
    if not len(odd):
        return cuts, np.zeros(len(cuts) - 1, bool)
    chunks = np.flatnonzero(chunk[: n + 1])
    uncut = np.zeros(len(chunks), bool)
    uncut[np.searchsorted(chunks, odd, "right") - 1] = True
    uncut = uncut[np.searchsorted(chunks, cuts, "right") - 1]
    kept = ~uncut | chunk[cuts]
    return cuts[kept], uncut[kept][:-1]


def _cuts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the byte-level pattern cuts texts without runs of white space that stand one behind the other (first and last place
    included), and which of these parts are chunks with odd characters, uncut."""
    n = len(data)
    classes = _translated(data, _BYTE_CLASSES)
    lead, code = _pairs(data)
    classes[lead] = classes[lead + 1] = _CLASSES[code]
    text = np.zeros(n + 2, bool)  # a place beyond the end, for what is looked up behind a quote
    text[0] = text[ends] = text[n + 1] = True
    chunk = text.copy()
    chunk[:n] |= (classes == _SPACE) | (classes == _LINE)
    chunk[1 : n + 1] |= classes == _LINE
    part = chunk.copy()
    part[1:n] |= (classes[1:] != classes[:-1]) & (classes[:-1] != _SPACE)
    quote = np.flatnonzero(data == ord("'"))  # 's and its like are parts where no mark and no space stands before the quote
    quote = quote[text[quote] | ((classes[quote - 1] >= _LINE) & (classes[quote - 1] <= _NUMBER))]
    _with_endings(part, text, quote, data)
    return _with_odd_whole(part, chunk, classes)


def _word_cuts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of such texts without white space and in lower case (odd chunks as they are), where the word pattern cuts them,
    which parts are odd chunks, and how many parts there are up to each text's end."""
    n = len(data)
    classes, lower = _translated(data, _WORD_BYTE_CLASSES), _translated(data, _BYTE_LOWER)
    lead, code = _pairs(data)
    classes[lead] = classes[lead + 1] = _WORD_CLASSES[code]
    code = _LOWER[code]
    lower[lead], lower[lead + 1] = 0xC0 | code >> 6, 0x80 | code & 63
    text = np.zeros(n + 2, bool)
    text[0] = text[ends] = text[n + 1] = True
    white = classes == _SPACE
    chunk = text.copy()
    chunk[1:n] |= white[1:] != white[:-1]
    part = chunk.copy()
    part[1:n] |= classes[1:] != classes[:-1]
    part[:n] |= (classes == _NUMBER) & (data & 0xC0 != 0x80)
    quote = np.flatnonzero(data == ord("'"))  # here also behind a space
    quote = quote[text[quote] | (classes[quote - 1] != _MARK)]
    _with_endings(part, text, quote, lower)
    cuts, uncut = _with_odd_whole(part, chunk, classes)
    if uncut.any():
        within = np.repeat(uncut, np.diff(cuts))
        lower[within] = data[within]
    starts, sizes = cuts[:-1], np.diff(cuts)
    seen = ~white[starts]
    return lower[~white], np.append(0, np.cumsum(sizes[seen])), uncut[seen], np.searchsorted(starts[seen], ends)


class _Encoder:
    def __init__(self, path: str):
        tokenizer = _tokenizer(path)
        self.whole, self.parts, self.memory = _Whole(tokenizer), _Spelt(tokenizer), _Memory()

    def __call__(self, text: str) -> bytes:
        (data,) = self.encoded([text])
        return data

    def encoded(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Each text's ids; texts of some `AT_ONCE` characters are encoded together."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= AT_ONCE:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        whole = {i: self.whole.made(text) for i, text in enumerate(texts) if self._uncut(text)}
        rest = [b"" if i in whole else text.encode() for i, text in enumerate(texts)]
        ids, ends = self._of_parts(b"".join(rest), np.cumsum(np.fromiter(map(len, rest), np.int64, len(rest))))
        data, start = memoryview(ids).cast("B"), 0
        for i, end in enumerate(ends.tolist()):
            yield whole[i] if i in whole else bytes(data[4 * start : 4 * end])
            start = end

    def _of_parts(self, data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts that stand one behind the other, and how many there are up to each text's end."""
        data, cuts, uncut, upto = self._cut(np.frombuffer(data, np.uint8), ends)
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        parts = parts.dictionary_encode()
        memory, at = self.memory, parts.indices.to_numpy()
        known = memory.places(parts.dictionary)
        new = np.flatnonzero(known < 0)
        odd = np.zeros(len(known), bool)
        odd[at[uncut]] = True
        known[new] = len(memory.parts) + np.arange(len(new))
        new_parts = parts.dictionary.take(pa.array(new))
        memory.add(new_parts, self._made(new_parts, odd[new]))
        sizes = memory.sizes[known]
        starts = (np.cumsum(memory.sizes) - memory.sizes)[known]
        lengths = sizes[at]
        before = np.append(0, np.cumsum(lengths))
        places = np.repeat(starts[at] - before[:-1], lengths)
        places += np.arange(len(places))
        ids = memory.ids[places]
        memory.trim()
        return ids, before[upto]

    def _made(self, parts: pa.LargeBinaryArray, odd: np.ndarray) -> list[bytes]:
        """Each part's ids."""
        if odd.any():
            return [self.whole.made(p.decode()) if o else self.parts.made(_spelt(p)) for p, o in zip(parts.to_pylist(), odd.tolist(), strict=True)]
        return [self.parts.made(_spelt(p)) for p in parts.to_pylist()]

    def _uncut(self, text: str) -> bool:
        """Whether the text is to be encoded whole."""
        return False

    def _cut(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of the parts, where these begin and the last one ends, which are to be encoded whole, and how many there are up
        to each text's end."""
        raise NotImplementedError


class ByteEncoder(_Encoder):
    """For byte-level vocabularies, where a word takes the one space before it along."""

    def _uncut(self, text: str) -> bool:
        kinds = _kinds_of(text)
        return bool(_RUN.search(text)) if kinds is None else b"  " in kinds or b"x" in kinds

    def _cut(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        cuts, uncut = _cuts(data, ends)
        return data, cuts, uncut, np.searchsorted(cuts, ends)


class WordEncoder(_Encoder):
    """For vocabularies that drop white space and end words."""

    def _cut(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return _word_cuts(data, ends)


_made: dict = {}


def encoder(kind: type, path: str):
    """One encoder a worker process, so that its memory serves all tasks of the process."""
    if (kind, path) not in _made:
        _made[kind, path] = kind(path)
    return _made[kind, path]
