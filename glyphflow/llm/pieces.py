"""Tokenizing through a memo of pieces, exactly as the tokenizers library does on the whole text.

Texts are cut only where no pre-token can cross, and where what follows is encoded alike whatever stands before: before a
lone space, on both sides of a lone line feed, and between an ASCII letter and a full stop or comma. The patterns of the
covered pre-tokenizers look ahead, never back, and all three cuts are ends of their matches; the covered normalisers
change nothing across them, and added tokens hold none of these characters. So the ids of a text are those of its pieces.

Cutting and counting is by arrays: a slice of texts is one Arrow array of pieces, whose distinct values are looked up once.
The memo is bounded by bytes and has two generations; what neither holds is encoded again, which costs time, never results.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Letters to every version of Unicode that are composed already and whose lower case is one of them.
LATIN = re.compile(" ?([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)")
MEMO_BYTES = 320 << 20
#: Ids of texts of so many pieces are put together at once.
TOGETHER = 1 << 18
#: What an entry takes besides the characters of its piece and its ids.
ENTRY_BYTES = 150
#: Patterns of pre-tokenizers that the cuts are proven for.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_SOLID = np.zeros(256, dtype=bool)
_SOLID[33:127] = True
#: Bytes that begin a character that surely is no white space: neither control nor one of the blocks that have some.
_NEXT = _SOLID.copy()
_NEXT[[*range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True
_LEAD2, _LEAD3 = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_LEAD2[0xC3:0xE0] = True
_LEAD3[[0xE0, *range(0xE4, 0xF0)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def require(tokenizer: Tokenizer, kind: str) -> Tokenizer:
    """tokenizer, if cuts and boundaries are proven for it: a byte-level ("bytes") or lower-casing ("words") BPE."""
    told = json.loads(tokenizer.to_str())
    level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": kind == "bytes"}
    parts = lambda x, inner: [] if x is None else x[inner] if x["type"] == "Sequence" else [x]
    pre, norm = parts(told["pre_tokenizer"], "pretokenizers"), parts(told["normalizer"], "normalizers")
    fits = bool(pre) and all(pre[-1].get(k) == v for k, v in level.items()) and told["model"]["type"] == "BPE" and not told["model"]["dropout"] and told["post_processor"] is None
    if kind == "bytes":
        fits = fits and len(pre) == 1 and not norm
    else:
        fits = fits and len(pre) == 2 and pre[0]["type"] == "Split" and pre[0]["pattern"] == {"Regex": WORDS} and pre[0]["behavior"] == "Removed" and pre[0]["invert"]
        fits = fits and all(x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " " for x in norm) and any(x["type"] == "Lowercase" for x in norm)
    fits = fits and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or re.search(r"[\s.,]", x["content"]) for x in told["added_tokens"])
    if not fits:
        raise ValueError(f"the pieces of this tokenizer aren't proven to be those of a {kind} tokenizer")
    return tokenizer


def byte_letters() -> dict[int, str]:
    """The character that byte-level tokenizers use for each byte: itself if it prints, else the next from 256 on."""
    out, following = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = chr(b)
        else:
            out[b], following = chr(following), following + 1
    return out


LETTERS = byte_letters()
SPACE = LETTERS[32]


def spelled(text: str) -> str:
    if text.isascii():
        return SPACE + text[1:] if text[0] == " " else text
    return "".join(map(LETTERS.__getitem__, text.encode()))


def piece_offsets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin, and the end of the last: the texts' own offsets and all cuts inside them."""
    n = len(data)
    if not n:
        return offsets
    edge = np.zeros(n + 2, dtype=bool)
    edge[offsets] = True

    def lone(byte: int) -> np.ndarray:
        at = np.flatnonzero(data == byte)
        at = at[~edge[at] & ~edge[at + 1]]
        before = data[at - 1]
        # negative places are those of other texts' bytes, behind a byte that is none of a character of two or three
        solid = _SOLID[before] | ((before & 0xC0) == 0x80) & (_LEAD2[data[at - 2]] | _LEAD3[data[at - 3]])
        return at[solid & _NEXT[data[at + 1]]]

    line = lone(10)
    stop = np.flatnonzero((data == 46) | (data == 44))
    stop = stop[~edge[stop]]
    edge[lone(32)] = True
    edge[line] = True
    edge[line + 1] = True
    edge[stop[_LETTER[data[stop - 1]]]] = True
    out = np.flatnonzero(edge[: n + 1])
    if len(offsets) > 1 and (offsets[1:] == offsets[:-1]).any():  # empty texts have an empty piece each
        out = np.sort(np.concatenate([out, offsets[1:][offsets[1:] == offsets[:-1]]]))
    return out


def distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pieces of texts, the index in these of each piece, and the first piece of each text (and the end)."""
    begins = piece_offsets(data, offsets)
    column = pa.Array.from_buffers(pa.large_string(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(data)])
    coded = column.dictionary_encode()
    first = np.searchsorted(begins, offsets, "left")
    same = np.zeros(len(offsets), np.int64)  # of equal offsets, the k-th text has the k-th piece there
    for i in np.flatnonzero(offsets[1:] == offsets[:-1]) + 1:
        same[i] = same[i - 1] + 1
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), first + same


class Memo:
    """What pieces are encoded to, in two generations of at most so many bytes together."""

    def __init__(self, tokenizer: Tokenizer, most: int = MEMO_BYTES):
        self.tokenizer, self.model, self.most = tokenizer, tokenizer.model, most // 2
        self.at: dict[str, int] = {}
        self.begins, self.sizes, self.flat = array("i"), array("i"), array("I")
        self.letters, self.old = 0, ({}, self.begins, self.sizes, self.flat)

    def __len__(self) -> int:
        return len(self.at)

    def encoded(self, piece: str) -> list[int]:
        raise NotImplementedError

    def add(self, piece: str) -> int:
        at, begins, sizes, flat = self.old
        if (k := at.get(piece)) is not None:
            ids = flat[begins[k] : begins[k] + sizes[k]]
        else:
            ids = array("I", self.encoded(piece))
        self.at[piece] = k = len(self.sizes)
        self.begins.append(len(self.flat))
        self.sizes.append(len(ids))
        self.flat += ids
        self.letters += len(piece)
        return k

    def found(self, pieces: list[str]) -> np.ndarray:
        """The entries of pieces, which hold until the next call."""
        if len(self.at) * ENTRY_BYTES + 2 * self.letters + 4 * len(self.flat) >= self.most:
            self.old = self.at, self.begins, self.sizes, self.flat
            self.at, self.begins, self.sizes, self.flat, self.letters = {}, array("i"), array("i"), array("I"), 0
        out = np.fromiter(map(self.at.get, pieces, repeat(-1)), np.int32, len(pieces))
        for i in np.flatnonzero(out < 0).tolist():
            out[i] = self.add(pieces[i])
        return out


class Counts(Memo):
    """Number of tokens by piece, for a tokenizer that puts text in lower case and drops white space."""

    def __init__(self, tokenizer: Tokenizer, most: int = MEMO_BYTES):
        super().__init__(require(tokenizer, "words"), most)

    def encoded(self, piece: str) -> list[int]:
        """One number: how many tokens there are."""
        if found := LATIN.fullmatch(piece):
            return [len(self.model.tokenize(spelled(found[1].lower())))]
        return [len(self.tokenizer.encode(piece, add_special_tokens=False).ids) if piece else 0]

    def of(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Numbers of tokens of texts: data[offsets[i]:offsets[i + 1]] in UTF-8."""
        pieces, at, first = distinct(data, offsets)
        if not pieces:
            return np.zeros(len(offsets) - 1, np.int64)
        entry = self.found(pieces)
        size = np.frombuffer(self.flat, np.uint32)[entry]  # an entry's only number
        total = np.concatenate([[0], np.cumsum(size[at], dtype=np.int64)])
        return total[first[1:]] - total[first[:-1]]


class Ids(Memo):
    """Token ids by piece, for a byte-level tokenizer."""

    def __init__(self, tokenizer: Tokenizer, most: int = MEMO_BYTES):
        super().__init__(require(tokenizer, "bytes"), most)

    def encoded(self, piece: str) -> list[int]:
        if not piece:
            return []
        if LATIN.fullmatch(piece):
            return [t.id for t in self.model.tokenize(spelled(piece))]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def of(self, data: np.ndarray, offsets: np.ndarray, end: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ids of texts, some texts at a time: the first, the last + 1, their ids, one text's after the other's, each with
        the end id if there is one, and where each text's begin."""
        pieces, at, first = distinct(data, offsets)
        entry = self.found(pieces)[at]
        begin, size = np.frombuffer(self.begins, np.int32)[entry], np.frombuffer(self.sizes, np.int32)[entry]
        flat = np.frombuffer(self.flat, np.uint32)
        flat = np.append(flat, np.uint32(end or 0))
        del at, entry
        a, n = 0, len(offsets) - 1
        while a < n:
            b = max(a + 1, int(np.searchsorted(first, first[a] + TOGETHER, "right")) - 1)
            begins, sizes, edges = begin[first[a] : first[b]], size[first[a] : first[b]], first[a : b + 1] - first[a]
            if end is not None:  # the end is one more piece of each text
                begins, sizes = np.insert(begins, edges[1:], len(flat) - 1), np.insert(sizes, edges[1:], 1)
                edges = edges + np.arange(len(edges))
            total = np.zeros(len(sizes) + 1, np.int64)
            np.cumsum(sizes, out=total[1:])
            place = np.int32 if total[-1] < 1 << 31 else np.int64
            where = np.repeat((begins - total[:-1]).astype(place), sizes)
            where += np.arange(total[-1], dtype=place)
            yield a, b, flat[where], total[edges]
            a = b
