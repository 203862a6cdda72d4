"""Byte-level BPE: exact merges in linear time by longest matches and a table of compatible pairs, and decoding by offsets."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType
from tokenizers.pre_tokenizers import ByteLevel

from changeloom.llm.text import parts

#: Fixed pattern: how byte-level tokenizers of this kind split a text before any merge.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of at most so many characters are remembered, so many at a time; the tables of a task stay below some 100 MB.
SHORT, REMEMBERED = 48, 1 << 18
NEVER = 1 << 60


def alphabet() -> dict[str, int]:
    """The character that stands for each byte in the file: itself if it is printable, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and added tokens of a byte-level BPE file, as plain data that travels with the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        model, split = given["model"], given.get("pre_tokenizer") or {}
        plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None}
        if model["type"] != "BPE" or given.get("normalizer") or any(model.get(k) or None for k in plain) or model.get("ignore_merges"):
            raise ValueError("not a plain BPE model")
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            raise ValueError("not split into pieces of bytes")
        code = alphabet()
        self.tokens: dict[int, bytes] = {i: bytes(code[c] for c in token) for token, i in model["vocab"].items()}
        ids = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: Rank of the merge of two tokens; the two parts and the rank of each merged token.
        self.ranks = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made: dict[int, tuple[int, int, int]] = {}
        for (a, b), rank in self.ranks.items():
            token = ids["".join(pairs[rank])]
            if token in self.made or any(part in self.made and self.made[part][2] > rank for part in (a, b)):
                raise ValueError("merges that do not follow one another")
            self.made[token] = a, b, rank
        self.bytes = {token[0]: i for i, token in self.tokens.items() if len(token) == 1}
        if len(self.bytes) < 256:
            raise ValueError("some bytes have no token")
        self.added: dict[str, int] = {}
        for token in given.get("added_tokens") or []:
            if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError("an added token that does not stand for its own text")
            self.added[token["content"]] = token["id"]
            self.tokens[token["id"]] = token["content"].encode()


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.ranks, self.made, self.added = vocabulary.ranks, vocabulary.made, vocabulary.added
        self.compatible: dict[tuple[int, int], bool] = {}
        self.borders: tuple[dict, dict] = ({}, {})
        good = set(vocabulary.bytes.values())
        for token, (a, b, rank) in sorted(self.made.items(), key=lambda item: item[1][2]):
            if a in good and b in good and self._first_across(a, b) == rank:
                good.add(token)
        known = {vocabulary.tokens[token].decode("latin-1"): token for token in good}
        self.automaton = ahocorasick.Automaton()
        for text, token in known.items():
            self.automaton.add_word(text, token)
        self.automaton.make_automaton()
        self.length = {token: len(text) for text, token in known.items()}
        self.longest = max(self.length.values())
        #: The longest token that each token begins with.
        self.shorter = {token: next((known[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in known), None) for text, token in known.items()}
        self.packed = {token: token.to_bytes(4, "little") for token in self.length}
        self.whole = {text.encode("latin-1"): self.packed[token] for text, token in known.items()}
        self.pieces = _Pieces(self)
        self.split = regex.compile(PIECES)
        self.special = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))) if self.added else None
        # Versions of Unicode differ in what they know of these: texts that hold one are split by the library itself.
        self.unsure = re.compile(f"[{_unassigned()}\U00010000-\U0010ffff]")
        self.by_library = ByteLevel(add_prefix_space=False, use_regex=True)

    def _first_across(self, left: int, right: int) -> int:
        """Rank of the first merge that would join the end of ``left`` to the start of ``right``; NEVER if none does.

        Merges happen in the order of their ranks. At any rank, the pieces beside the border are those of the two tokens that are
        made by then; both grow, bytes first, until they are whole. A merge across comes first if its rank is below that of the left
        piece's next merge and not above that of the right one's: of equal pairs in a row, the left one is merged first.
        """
        ends, starts = self._border(left, 1), self._border(right, 0)
        i = j = 0
        while True:
            (end, next_left), (start, next_right) = ends[i], starts[j]
            across = self.ranks.get((end, start), NEVER)
            if across < next_left and across <= next_right:
                return across
            if next_left == next_right == NEVER:
                return NEVER
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def _border(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces on one side (0: first, 1: last) of a token as it grows from bytes, each with the rank of the merge that ends it."""
        found = self.borders[side].get(token)
        if found is None:
            found, inner, until = [], token, NEVER
            while True:
                found.append((inner, until))
                if inner not in self.made:
                    break
                until = self.made[inner][2]
                inner = self.made[inner][side]
            found.reverse()
            self.borders[side][token] = found
        return found

    def fits(self, left: int, right: int) -> bool:
        """Whether two tokens can stand side by side, looked up in the table of pairs, which fills as pairs turn up."""
        found = self.compatible.get((left, right))
        if found is None:
            if len(self.compatible) >= 4 * REMEMBERED:
                self.compatible.clear()
            found = self.compatible[left, right] = self._first_across(left, right) == NEVER
        return found

    def tokens(self, piece: bytes) -> list[int]:
        """The tokens that merging in order of rank leaves of a piece.

        They are the only sequence of which all neighbours fit. From the left, the longest match that fits the token before is taken; where
        nothing fits, the last token is taken back and its next shorter match tried. An end without a way on is never tried again, so the
        work is linear in the length of the piece.
        """
        text = piece.decode("latin-1")
        n, at, found, last = len(text), 0, [], None
        dead = bytearray(n + 1)
        length, shorter, compatible, fits, longest = self.length, self.shorter, self.compatible, self.fits, self._longest
        token = longest(text, 0) if n else None
        while at < n:
            while token is not None:
                end = at + length[token]
                if not dead[end] and (last is None or compatible.get((last, token)) or fits(last, token)):
                    break
                token = shorter[token]
            if token is not None:
                found.append(token)
                at, last = end, token
                token = longest(text, at) if at < n else None
            else:
                dead[at] = 1
                found.pop()
                at -= length[last]
                token, last = shorter[last], found[-1] if found else None
        return found

    def _longest(self, text: str, at: int) -> int:
        return next(self.automaton.iter_long(text[at : at + self.longest]))[1]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, four bytes each, the lowest first."""
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out, at = [], 0
        for match in self.special.finditer(text):
            out += [self._plain(text[at : match.start()]), self.added[match[0]].to_bytes(4, "little")]
            at = match.end()
        return b"".join([*out, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        if not text.isascii() and self.unsure.search(text):
            found = [text[a:b] for _, (a, b) in self.by_library.pre_tokenize_str(text)]
        else:
            found = self.split.findall(text)
        return b"".join(map(self.pieces.__getitem__, found))


class _Pieces(dict):
    """The packed ids of short pieces; those of long ones are not kept."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        packed = self.encoder.whole.get(raw)
        if packed is None:
            packed = b"".join(map(self.encoder.packed.__getitem__, self.encoder.tokens(raw)))
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


def _unassigned() -> str:
    """The code points of the basic plane without a meaning yet, as ranges of a character class."""
    ends = [c for c in range(0x80, 0xFFFF) if (unicodedata.category(chr(c)) == "Cn") != (unicodedata.category(chr(c + 1)) == "Cn")]
    return "".join(f"{chr(a + 1)}-{chr(b)}" for a, b in zip(ends[::2], [*ends, 0xFFFF][1::2], strict=False))


class Decoder:
    """The bytes of all tokens in a row, and where each begins."""

    def __init__(self, vocabulary: Vocabulary):
        size = max(vocabulary.tokens) + 1
        texts = [vocabulary.tokens.get(i, b"") for i in range(size)]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.offsets = np.zeros(size + 1, np.int64)
        np.cumsum([len(text) for text in texts], out=self.offsets[1:])

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; ids without a token give nothing, bytes that are no UTF-8 give U+FFFD."""
        ids = np.frombuffer(packed, "<u4")
        ids = ids[ids < len(self.offsets) - 1]
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        at = np.arange(total) + np.repeat(self.offsets[ids] - ends + lengths, lengths)
        return self.data[at].tobytes().decode("utf-8", "replace")


def _mapped(frame: DataFrame, source: str, result: str, kind, make) -> DataFrame:
    """All columns of a frame, and ``result`` for each value of ``source``; a column of that name is replaced. Evaluated once a row."""
    kept = [f for f in frame.schema.fields if f.name.lower() != result.lower()]
    packed = kind == BinaryType()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = None
        for batch in batches:
            function = function or make()
            for part in parts(batch, 16 << 20):
                values = [function(value) for value in part.column(part.schema.get_field_index(source)).to_pylist()]
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.binary() if packed else pa.string())], [*[f.name for f in kept], result])

    return frame.mapInArrow(run, StructType([*kept, StructField(result, kind)]))


def encode(frame: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The input's columns, then ``ids``: the tokens of every whole text, each as four bytes, the lowest first.

    ``path`` is the file of a byte-level BPE tokenizer; it is read on the driver. Added tokens are found in the text, as the library finds them.
    Texts are split into pieces and each piece into tokens by ``Encoder.tokens``, whose work and memory are linear in the length of
    a text. Null and empty texts have no tokens. Rows stay as they are, repeated ones too; a column named like the result is replaced; an empty
    table stays empty.
    """
    vocabulary = Vocabulary(path)

    def make():
        encoder = Encoder(vocabulary)
        return lambda value: encoder.encode(value or "")

    return _mapped(frame, text, ids, BinaryType(), make)


def decode(frame: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The input's columns, then the text of its packed ``ids``; null ids are the empty text. A column named like the result is replaced."""
    vocabulary = Vocabulary(path)

    def make():
        decoder = Decoder(vocabulary)
        return lambda value: decoder.decode(value or b"")

    return _mapped(frame, ids, text, StringType(), make)


def unpacked(ids: bytes) -> list[int]:
    """Packed ids as numbers."""
    return [int.from_bytes(ids[a:b], "little") for a, b in pairwise(range(0, len(ids) + 1, 4))]
