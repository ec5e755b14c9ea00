"""Token ids of texts by a public tokenizer file, encoded piece by piece with a cache."""

from __future__ import annotations

import json
import re
from array import array
from codecs import charmap_decode
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECES_KEPT = 200_000  # pieces a worker remembers; some 10 MB
LONGEST_KEPT = 64  # bytes of a piece that is remembered
BLOCK, STEP = 1 << 19, 1 << 15  # pieces looked up at once, and of these written at once

# The pre-tokenizer of byte-level BPE, for texts of the Latin-1 characters.
_LETTERS, _NUMBERS, _BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_UNIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
    f"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)


class Encoder:
    """Ids as little-endian unsigned 32-bit integers, the same as encoding whole texts.

    Byte-level BPE merges within units only (a word with the space before it, a number, a run
    of signs), so texts are parted between units, and each distinct piece of a batch is looked
    up or encoded once. With `added`, as in a plain call of the library, the strings of the
    file's added tokens are these tokens; else they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        before, model = described.get("pre_tokenizer") or {}, described["model"]
        self.by_unit = (
            model.get("type") == "BPE"
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not described.get("normalizer")
        )
        tokens = described.get("added_tokens") or [] if added else []
        # Those that take blanks with them or end words are left to the library.
        self.by_unit &= not any(x.get(k) for x in tokens for k in ("single_word", "lstrip", "rstrip"))
        self.by_unit &= len({bool(x.get("normalized")) for x in tokens}) < 2
        self.added = {x["content"]: self._id(x["content"]) for x in tokens if x["content"]}
        # Of those that begin at the same place the longest is meant.
        self.parts = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})")
        # The tokenizer's own model, not a second one: both would lie in every worker's memory.
        self.pieces = _Pieces(self.tokenizer) if self.by_unit else None

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, column: pa.Array) -> list[bytes]:
        """The ids of each text of an Arrow column, a null as the empty text."""
        if not self.by_unit:
            return [self._whole(text or "") for text in column.to_pylist()]
        column = column.fill_null("")
        marked = np.zeros(len(column), bool)
        for token in self.added:
            marked |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._plain(column)
        plain = iter(self._plain(column.filter(pa.array(~marked))))
        split = [self.parts.split(text) for text in column.filter(pa.array(marked)).to_pylist()]
        between = iter(self._plain(pa.array([x for parts in split for x in parts[::2]], pa.string())))
        joined = (b"".join([self.added[x] if k % 2 else next(between) for k, x in enumerate(parts)]) for parts in split)
        return [next(joined if mark else plain) for mark in marked.tolist()]

    def _id(self, token: str) -> bytes:
        return array("I", [self.tokenizer.token_to_id(token)]).tobytes()

    def _plain(self, column: pa.Array) -> list[bytes]:
        if not len(column):
            return []
        column = column.cast(pa.large_binary())
        _, ends, data = column.buffers()
        ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
        if ends[0] == ends[-1]:
            return [b""] * len(column)
        data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        marks = np.zeros(len(data) + 1, bool)
        marks[ends] = True
        marks[cuts(data)] = True
        places = np.flatnonzero(marks).astype(np.int64)
        ids, each = zip(*(self._block(data, places[k : k + BLOCK + 1]) for k in range(0, len(places) - 1, BLOCK)))
        whole = b"".join(ids)
        before = np.concatenate([[0], np.cumsum(np.concatenate(each))])
        at = (4 * before[np.searchsorted(places, ends)]).tolist()
        return [whole[start:end] for start, end in zip(at, at[1:])]

    def _block(self, data: np.ndarray, places: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids of the pieces between places, and how many each piece has."""
        buffers = [None, pa.py_buffer(places), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers).dictionary_encode()
        ids, starts, sizes = self.pieces.look_up(coded.dictionary)
        codes = coded.indices.to_numpy()
        some = (codes[k : k + STEP] for k in range(0, len(codes), STEP))
        return b"".join([_gathered(ids, starts[x], sizes[x]) for x in some]), sizes[codes]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class _Pieces:
    """Ids by piece (UTF-8), made when first asked for. What few batches asked for is given up first."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        self.chars = _byte_chars()
        self.pieces = pa.array([], pa.large_binary())
        self.sizes, self.asked = np.zeros(0, np.int64), np.zeros(0, np.float32)
        self.ids = np.zeros(0, np.uint32)

    def look_up(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the places and numbers of those of each of the distinct pieces."""
        codes = pc.index_in(pieces, self.pieces).fill_null(-1).to_numpy()
        new = codes < 0
        self.asked[codes[~new]] += 1
        added = pieces.filter(pa.array(new))
        made = [self._made(piece) for piece in _values(added)]
        codes = np.where(new, len(self.pieces) + np.cumsum(new) - 1, codes)
        self.pieces = pa.concat_arrays([self.pieces, added])
        self.sizes = np.concatenate([self.sizes, np.fromiter(map(len, made), np.int64, len(made))])
        self.asked = np.concatenate([self.asked, np.ones(len(made), np.float32)])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(made), np.uint32)])
        found = self.ids, (np.cumsum(self.sizes) - self.sizes)[codes], self.sizes[codes]
        self._give_up()
        return found

    def _give_up(self) -> None:
        kept = pc.binary_length(self.pieces).to_numpy() <= LONGEST_KEPT
        if len(kept) > PIECES_KEPT:
            kept[np.argpartition(self.asked, -PIECES_KEPT // 2)[: -PIECES_KEPT // 2]] = False
            self.asked /= 2  # what was asked for long ago counts less
        if not kept.all():
            self.ids = self.ids[np.repeat(kept, self.sizes)]
            self.pieces = self.pieces.filter(pa.array(kept))
            self.sizes, self.asked = self.sizes[kept], self.asked[kept]

    def _made(self, piece: bytes) -> list[int]:
        if piece.isalpha() or piece[:1] == b" " and piece[1:].isalpha():
            return self._unit(piece)
        text = piece.decode()
        if text.isascii() or _is_latin(text):
            return [x for unit in _UNIT.findall(text) for x in self._unit(unit.encode())]
        # Other scripts are encoded by the library as they are.
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _unit(self, unit: bytes) -> list[int]:
        return [token.id for token in self.tokenize(charmap_decode(unit, "strict", self.chars)[0])]


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    shift = starts - (np.cumsum(sizes) - sizes)
    return ids[np.repeat(shift, sizes) + np.arange(sizes.sum())].tobytes()


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _values(column: pa.LargeBinaryArray) -> list[bytes]:
    """As to_pylist, which takes four times as long."""
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    data = data.to_pybytes()
    return [data[start:end] for start, end in zip(ends, ends[1:])]


def _byte_chars() -> str:
    """Fixed values of byte-level BPE: printable bytes stand for themselves, the others for
    the characters from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in printable else next(others)) for b in range(256))


# Kinds of bytes: letters, other signs and blanks of ASCII at which texts may be parted; bytes of longer
# characters; digits and the rest.
_REST, _LETTER, _SIGN, _BLANK, _LONG = range(5)
_KINDS = np.full(256, _REST, np.uint8)
_KINDS[0x21:0x7F] = _SIGN
_KINDS[0x30:0x3A] = 5
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KINDS[[0x20, 0x0A]] = _BLANK
_KINDS[0x80:] = _LONG
# By the kinds of two neighbours, whether a unit ends between them: 1 always, 2 depending on the first.
_ENDS = np.zeros((8, 8), np.uint8)
_ENDS[[_LETTER, _SIGN, 5], _BLANK] = 1
_ENDS[_LETTER, _SIGN] = 1
_ENDS[_LONG, [_BLANK, _SIGN]] = 2
_ENDS = _ENDS.ravel()


def cuts(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 text where a unit surely ends, whatever stands before and after: between
    a character that is no blank and a space or line feed, and between a letter and a sign.

    Blanks and letters beyond ASCII are not all known here; where in doubt, there is no cut.
    """
    kinds = _KINDS[data]
    ends = _ENDS[(kinds[:-1] << 3) | kinds[1:]]
    sure = np.flatnonzero(ends == 1) + 1
    at = np.flatnonzero(ends == 2) + 1
    if not len(at):
        return sure
    last, second, third = data[at - 1], data[at - 2], data[at - 3]
    two = (second >= 0xC3) & (second < 0xE0)  # U+00C0 to U+07FF
    three = (second < 0xC0) & ((third == 0xE0) | (third >= 0xE4) & (third < 0xF0) | (third == 0xE3) & (second > 0x80))
    quotes = (third == 0xE2) & (second == 0x80) & (last >= 0x90) & (last <= 0xA7)  # and dashes
    latin = (second == 0xC3) & (last != 0x97) & (last != 0xB7)
    return np.concatenate([sure, at[np.where(kinds[at] == _BLANK, two | three | quotes, latin)]])


@cache
def encoder(path: str, added: bool = False) -> Encoder:
    """The worker's encoder of a file; tasks that follow in the same worker share its cache."""
    return Encoder(path, added)


def default_file() -> str:
    """Path of the byte-level vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
