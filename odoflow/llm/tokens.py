"""Token ids of whole texts by the tokenizers library.

The library spends most of its time in splitting and bookkeeping, so each
distinct piece of text between split points is encoded by the library's BPE
model once and remembered (MEMORY pieces at most). ``ids_of`` finds the split points of
many texts at once, on their bytes, and looks up each distinct piece of them once. Texts with characters beyond
ASCII and the Latin-1 letters go through the library's whole encoder instead,
as Python's character classes are certain to agree only there; so do texts that
hold an added token (``<|endoftext|>``), which the library takes out before it splits.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
MEMORY = 600_000
#: Characters of text whose pieces are looked up together (one longer text goes alone).
SLICE = 6 << 20

# The split rule of this byte-level vocabulary, for ASCII and Latin-1 letters: plain
# character sets, and words first, as no other branch can start where they do.
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_SPLIT = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+|'(?:[sdmt]|ll|ve|re)| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_OTHER = re.compile(r"[^\x00-\x1b\x20-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]")

# The same rule on UTF-8 bytes: a class for each (all beyond ASCII belong to Latin-1 letters), END after each text.
END = "\x1f"
_LETTER, _DIGIT, _MARK, _WHITE, _END = range(5)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[*range(9, 14), 32]] = _WHITE
_CLASS[ord(END)] = _END


def _starts(data: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin, in their bytes; each text is followed by END."""
    kind = _CLASS[data]
    begins = np.append(True, kind[1:] != kind[:-1]) | (kind == _END)
    white = kind == _WHITE
    # A run of white space before a text goes on: its last character stands alone, or opens the next piece if it is a space.
    last = np.flatnonzero(white[:-1] & (kind[1:] < _WHITE))
    begins[last] = True
    space = last[data[last] == 32]
    begins[space + 1] = False
    # 's, 'd, 'm, 't, 'll, 've and 're where a piece begins with the mark.
    for i in np.flatnonzero((data[:-1] == 39) & begins[:-1] & (kind[1:] == _LETTER)).tolist():
        two = data[i + 1 : i + 3].tobytes()
        n = 1 if two[:1] in (b"s", b"d", b"m", b"t") else 2 if two in (b"ll", b"ve", b"re") else 0
        if n:
            begins[i + 1] = False
            begins[i + 1 + n] = True
    return np.flatnonzero(begins)


def _printable_bytes() -> dict[int, str]:
    """How a byte-level vocabulary writes each byte: itself if printable, else the next free code from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + i)
    return table


class _Known(dict):
    """Piece of text -> its ids as bytes, in two generations: when the younger is full it replaces the
    older, and pieces met again move up, so the frequent ones stay."""

    def __init__(self, model) -> None:
        super().__init__()
        self.model, self.table, self.older = model, _printable_bytes(), {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMORY // 2:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            if piece.isascii() and piece.isprintable():
                shown = piece.replace(" ", self.table[32])
            else:
                shown = piece.encode().decode("latin-1").translate(self.table)
            tokens = self.model.tokenize(shown)
            ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = _Known(self.tokenizer.model)
        self.end = np.array([END_ID], "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Ids of the text and the end id, as little-endian unsigned 32-bit integers."""
        if _OTHER.search(text) or any(a in text for a in self.added):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(found, "<u4").tobytes() + self.end
        return b"".join(map(self.known.__getitem__, _SPLIT.findall(text))) + self.end

    def ids_of(self, texts: list[str]) -> Iterator[bytes]:
        """``ids`` of each text in order."""
        first = held = 0
        for i, text in enumerate(texts):
            held += len(text)
            if held > SLICE or i + 1 == len(texts):
                yield from self._together(texts[first : i + 1])
                first, held = i + 1, 0

    def _together(self, texts: list[str]) -> Iterator[bytes]:
        odd = [bool(_OTHER.search(t)) or any(a in t for a in self.added) for t in texts]
        data = "".join(t + END for t, o in zip(texts, odd) if not o).encode()
        body, ends = b"", []
        if data:
            at = np.append(_starts(np.frombuffer(data, np.uint8)), len(data)).astype(np.int32)
            pieces = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
            found = list(map(self.known.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False)))
            found[close := pieces.dictionary.index(END).as_py()] = self.end
            code, size = pieces.indices.to_numpy(), np.array([len(x) // 4 for x in found], np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(np.frombuffer(b"".join(found), "<u4")))
            body = ids.take(pieces.indices).flatten().to_numpy().tobytes()
            closing = np.flatnonzero(code == close)
            ends = (4 * np.cumsum(size[code], dtype=np.int64)[closing]).tolist()
        before, plain = 0, iter(ends)
        for text, o in zip(texts, odd):
            if o:
                yield self.ids(text)
            else:
                end = next(plain)
                yield body[before:end]
                before = end


@lru_cache(maxsize=2)
def encoder(name: str = TOKENIZER) -> Encoder:
    """One encoder for each Python worker. ``name``: a file of the public tokenizers, or a path."""
    import public_tokenizers

    return Encoder(name if "/" in name else public_tokenizers.path(name))
