"""Encoding with public vocabularies, one text piece at a time, each distinct piece once per task."""

from __future__ import annotations

import base64
import codecs
import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import regex
from tokenizers import Tokenizer, models, pre_tokenizers

from shopgrain.llm.common import words_of

HELD = 1 << 18  # distinct pieces a task remembers before it starts afresh
REMEMBERED = 1 << 19  # entries of each generation of a word encoder: some 500 MB of four full ones


class Remembered(dict):
    """Piece to value; forgets everything at ``HELD`` entries, so memory is bounded."""

    def __init__(self, value: Callable[[object], object]) -> None:
        super().__init__()
        self.value = value

    def __missing__(self, piece):
        if len(self) >= HELD:
            self.clear()
        found = self[piece] = self.value(piece)
        return found


def packed(ids: list[int]) -> bytes:
    return b"".join(i.to_bytes(4, "little") for i in ids)


class Generations:
    """Key to value in two generations of at most ``most`` entries each: when the young one is full
    it becomes the old one, so what is met often stays and memory is bounded."""

    def __init__(self, most: int) -> None:
        self.most, self.young, self.old = most, {}, {}

    def fill(self, keys: set[bytes], values: Callable[[list[bytes]], Iterable[bytes]]) -> None:
        """Have all of ``keys`` in ``young``; ``values`` gives the unknown ones' together."""
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young
        missing = keys - self.young.keys()
        if self.old:
            again = missing & self.old.keys()
            self.young.update(zip(again, map(self.old.__getitem__, again)))
            missing -= again
        missing = list(missing)
        self.young.update(zip(missing, values(missing)))


class WordEncoder:
    """Ids of a vocabulary file that drops white space and never joins over it.

    Text is cut at ASCII white space. The distinct pieces of some texts that are not remembered are
    given to the library in one call, joined by spaces, and told apart by its offsets; what it does
    inside a piece, other white space included, is left to it. Latin letters and the marks after
    them are pieces of their own, and their case does not count: the vocabulary is lower case and
    never joins letters with such marks. ``remembered`` trades memory for time, the ids are the same.
    """

    _LATIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
    _MARKS = b".,!?;:|#*$%&()"
    _TOGETHER = 4 << 20  # bytes of text whose pieces are looked up together
    _CALL = 1 << 15  # bytes of one call

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.library = Tokenizer.from_file(path)
        self.parts, self.pieces = Generations(remembered), Generations(remembered)

    def _encode(self, parts: list[bytes]) -> Iterator[bytes]:
        """Ids of each part, by calls over many of them."""
        at = 0
        while at < len(parts):
            some, size = [], 0
            while at < len(parts) and size < self._CALL:
                some.append(parts[at].decode("utf-8", "replace"))
                size += len(some[-1]) + 1
                at += 1
            found = self.library.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4").tobytes()
            first = np.array(found.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
            after = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)) + 1)
            begin = 0
            for end in (4 * np.searchsorted(first, after)).tolist():
                yield ids[begin:end]
                begin = end

    def _whole(self, pieces: list[bytes]) -> Iterator[bytes]:
        letters, marks = [], []
        for piece in pieces:
            word = piece.rstrip(self._MARKS)
            if word.isalpha():  # of bytes: A-Z and a-z
                letters.append(word.lower())
            elif self._LATIN.fullmatch(word):
                letters.append(word.decode().lower().encode())
            else:
                word = piece
                letters.append(piece)
            marks.append(piece[len(word):])
        self.parts.fill({*letters, *marks}, self._encode)
        known = self.parts.young.__getitem__
        return map(bytes.__add__, map(known, letters), map(known, marks))

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers, in order."""
        held, size = [], 0
        for text in texts:
            held.append(words_of(text))
            size += len(text or "")
            if size >= self._TOGETHER:
                yield from self._ids(held)
                held, size = [], 0
        yield from self._ids(held)

    def _ids(self, texts: list[list[bytes]]) -> Iterator[bytes]:
        self.pieces.fill(set().union(*texts), self._whole)
        known = self.pieces.young
        for words in texts:
            yield b"".join(map(known.__getitem__, words))


def byte_table() -> list[str]:
    """Fixed values of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the
    others, in order, for the characters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


class ByteEncoder:
    """Byte-level BPE by a file of ranks, run by the tokenizers library, and its decoding.

    Merging by rank joins the neighbours whose joined bytes have the lowest rank, whichever two parts
    make it up, so every split of a token into two tokens is a merge, in rank order. A match of the
    pattern that is itself a token is that token.
    """

    def __init__(self, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        chars = byte_table()
        shown = {token: "".join(chars[b] for b in token) for token in ranks}
        merges = [
            (shown[token[:i]], shown[token[i:]])
            for token in sorted(ranks, key=ranks.get) for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        vocab = {shown[token]: rank for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.library = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=False
        )
        self.ids = Remembered(lambda piece: packed(self._encode(piece).ids))
        self.spans = Remembered(lambda piece: (len(piece), self._encode(piece).offsets))

    def _encode(self, piece: str):
        return self.library.encode(piece, add_special_tokens=False)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.ids.__getitem__, self.pattern.findall(text)))

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """First character and the one after the last of each id; ids that share a character, as
        where one ends inside it, have it in both spans."""
        out, base = [], 0
        for piece in self.pattern.findall(text):
            size, spans = self.spans[piece]
            out.extend((base + a, base + b) for a, b in spans)
            base += size
        return out


class ByteDecoder:
    """Ids to the characters of the vocabulary, and those back through the reversed byte table.

    An id may hold part of a character only. ``decode`` gives bytes, which may then begin or end
    inside one; ``texts`` holds an incomplete character back until the ids that complete it.
    """

    def __init__(self, path: str) -> None:
        chars = byte_table()
        self.shown = {rank: "".join(chars[b] for b in token) for token, rank in read_ranks(path).items()}
        self.byte_of = np.zeros(0x200, dtype=np.uint8)
        self.byte_of[list(map(ord, chars))] = np.arange(256, dtype=np.uint8)

    def decode(self, ids: list[int]) -> bytes:
        shown = "".join(map(self.shown.__getitem__, ids))
        return self.byte_of[np.frombuffer(shown.encode("utf-16-le"), dtype="<u2")].tobytes()

    def texts(self, parts: Iterable[list[int]]) -> list[str]:
        """The text of each of the consecutive ``parts`` of a sequence of ids, cut anywhere.

        A character goes to the part that holds its last byte. Bytes that are no UTF-8, at the end
        of the last part an incomplete character too, become U+FFFD.
        """
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        out = [reader.decode(self.decode(ids)) for ids in parts]
        if out:
            out[-1] += reader.decode(b"", final=True)
        return out


# One of each per Python worker: tasks that follow each other in a worker share what it remembers.


@cache
def word_encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    return WordEncoder(path, remembered)


@cache
def byte_encoder(path: str, pattern: str) -> ByteEncoder:
    return ByteEncoder(path, pattern)


@cache
def byte_decoder(path: str) -> ByteDecoder:
    return ByteDecoder(path)
