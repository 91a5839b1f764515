"""Token ids of whole texts with the tokenizers library, each distinct piece of text encoded once.

A text is cut where no token of the two public byte-level tokenizers can reach over: in front
of single white-space characters that stand between two others, and between ASCII punctuation
and letters. The ids of a text are the ids of its pieces one after another; pieces
repeat, and are kept in a bounded cache. Pieces of letters alone are merged by the
library's model at once; other pieces of printable Latin-1 characters are split by the
tokenizer's own pattern first, and any other piece goes through the library's whole encoder.
"""

from __future__ import annotations

import json
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from gridloom.llm.words import IS_SPACE, LOWER, slices, take_ranges, word_hashes

#: The published pattern of byte-level pre-tokenizers: a fixed value.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED = 400_000
SLICE = 1 << 20  # text encoded at once: the positions of its pieces are what takes memory
_PLAIN = regex.compile(r"[ \t\n\r]?[\x21-\x7e\xa1-\xff]+")
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True  # first bytes of all white space beyond ASCII
_SAME = np.arange(256, dtype=np.uint8)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def _byte_characters() -> dict[int, str]:
    """Byte to character of byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the letters U+00C0 to U+00FF."""
    out = _LETTER[data]
    if len(data) > 1:
        two = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        out[:-1] |= two
        out[1:] |= two
    return out


def cut_points(data: np.ndarray, bounds: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Where pieces start: at texts that are not empty and at safe places inside them."""
    n = len(data)
    space, mark = IS_SPACE[data], _MARK[data]
    cut = np.zeros(n, bool)
    if n > 2:
        lead = _LEADS[data]
        cut[1:-1] = space[1:-1] & ~space[:-2] & ~space[2:] & ~lead[2:]
        cut[2:] &= ~lead[:-2]  # the character before may be white space of two or three bytes
        cut[3:] &= ~lead[:-3]
    edge = bounds[bounds < n]
    cut[edge[edge > 0] - 1] = False
    if n > 1:
        # an apostrophe may belong to the letters behind it
        cut[1:] |= (letter[:-1] & mark[1:]) | (mark[:-1] & (data[:-1] != 0x27) & letter[1:])
    cut[edge] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts by a tokenizer file; special tokens' strings in texts are ordinary text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.pattern, self.lower = self._rules(kind.get("pre_tokenizer"), kind.get("normalizer"))
        self.characters = _byte_characters()
        # ids as 32-bit words; two generations: the older one goes when the newer is full
        self.fresh: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @staticmethod
    def _rules(cutter: dict | None, normalizer: dict | None):
        """The pattern and the lower-casing of the two known kinds; no pattern for any other."""
        steps = [s["type"] for s in (normalizer or {}).get("normalizers", [])]
        if normalizer is not None and steps != ["NFC", "Replace", "Lowercase"]:
            return None, False
        if (cutter or {}).get("type") == "ByteLevel" and cutter["use_regex"] and not cutter["add_prefix_space"]:
            return regex.compile(BYTE_PATTERN), normalizer is not None
        parts = (cutter or {}).get("pretokenizers", [])
        if [p["type"] for p in parts] == ["Split", "ByteLevel"] and "Regex" in parts[0]["pattern"] \
                and parts[0]["behavior"] == "Removed" and parts[0]["invert"]:
            return regex.compile(parts[0]["pattern"]["Regex"]), normalizer is not None
        return None, False

    def _merged(self, part: str) -> list[int]:
        """Ids of one part that the pattern does not split."""
        if not part.isascii() or " " in part or not part.isprintable():
            part = part.encode().decode("latin-1").translate(self.characters)
        return [t.id for t in self.whole.model.tokenize(part)]

    def _new(self, piece: bytes, whole: bool) -> list[int] | None:
        """Ids of a piece; ``whole``: letters alone behind at most one space. None for the library's encoder."""
        text = piece.decode()
        if self.lower:
            text = text.lower()
        if whole:
            return self._merged(text)
        if not _PLAIN.fullmatch(text):
            return None
        return [i for part in self.pattern.findall(text) for i in self._merged(part)]

    def _encode_pieces(self, pieces: list[bytes], whole: list[bool]) -> list[bytes]:
        """Ids of each piece, new ones encoded."""
        out: list[bytes | None] = []
        rest: list[int] = []
        fresh, older = self.fresh, self.older
        for i, piece in enumerate(pieces):
            ids = fresh.get(piece)
            if ids is None:
                ids = older.get(piece)
                if ids is None:
                    new = self._new(piece, whole[i])
                    if new is None:
                        rest.append(i)
                    else:
                        ids = array("I", new).tobytes()
                if ids is not None:
                    fresh[piece] = ids
            out.append(ids)
        if rest:
            found = self.whole.encode_batch([pieces[i].decode() for i in rest], add_special_tokens=False)
            for i, e in zip(rest, found):
                out[i] = fresh[pieces[i]] = array("I", e.ids).tobytes()
        if len(fresh) > CACHED // 2:
            self.older, self.fresh = fresh, {}
        return out

    def encode(self, texts: pa.Array, end: int):
        """``first row, end row, ids, offsets`` of slices of rows; each text ends with the id ``end``."""
        for first, last, data, bounds in slices(texts, SLICE):
            if self.pattern is None:
                found = self.whole.encode_batch(texts.slice(first, last - first).fill_null("").to_pylist(),
                                                add_special_tokens=False)
                lists = [[*e.ids, end] for e in found]
                ids = np.fromiter(chain.from_iterable(lists), np.uint32)
                sizes = np.fromiter(map(len, lists), np.int64, len(lists))
                yield first, last, ids, np.concatenate([[0], np.cumsum(sizes)])
                continue
            letter = letters(data)
            starts = cut_points(data, bounds, letter)
            ends = np.append(starts[1:], len(data)) if len(starts) else starts
            # the lower-casing kind drops white space, so a piece may go without it
            bare = starts + IS_SPACE[data[starts]] if self.lower else starts
            fold = LOWER if self.lower else _SAME
            _, at, which = np.unique(word_hashes(data, bare, ends, fold), return_index=True, return_inverse=True)
            inside = np.concatenate([[0], np.cumsum(letter, dtype=np.int32)])
            body = bare if self.lower else bare + (data[bare] == 0x20)
            whole = (inside[ends] - inside[np.minimum(body, ends)] == ends - body) & (ends > body)
            raw = data.tobytes()
            lists = self._encode_pieces([raw[a:b] for a, b in zip(bare[at].tolist(), ends[at].tolist())],
                                        whole[at].tolist())
            sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 4
            flat = np.frombuffer(b"".join(lists), np.uint32)
            begin = np.cumsum(sizes) - sizes
            joined = flat[take_ranges(begin[which], sizes[which])]
            # the end id goes behind the last piece of each text
            before = np.concatenate([[0], np.cumsum(sizes[which])])[np.searchsorted(starts, bounds)]
            ids = np.insert(joined, before[1:], end)
            yield first, last, ids, before + np.arange(len(before))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, kept for the life of a Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
