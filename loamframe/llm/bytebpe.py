"""Ids of a byte-level BPE tokenizer, each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

REMEMBERED_BYTES = 256 << 20
LONGEST = 64  # longer words are encoded anew each time
CHUNK_BYTES = 12 << 20  # texts encoded together, of which equal words are looked up once
_OTHER_SPACE = re.compile(r"[^\S \n]")
# Latin-1 letters, then other ASCII signs (no apostrophe, which may start a
# contraction): the tokenizer's pattern takes each as one run.
_PLAIN = re.compile(r"([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]*)([!-&(-/:-@\[-`{-~]*)")


# Of a byte: 1 an ASCII letter, 2 one of those signs, 3 a space or line feed, 0 any other.
_KIND = np.zeros(256, np.uint8)
_KIND[[c for c in range(128) if chr(c).isalpha()]] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = 2
_KIND[[10, 32]] = 3
_LETTERS = re.compile(r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
# The first two bytes of white space beyond ASCII (and of some other signs).
_WIDE_SPACE = sorted({c.encode()[0] << 8 | c.encode()[1] for c in map(chr, range(128, 1 << 16)) if c.isspace()})


def _stand_ins() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


class _Known(dict):
    """Text -> ids (little-endian, 4 bytes each), with a fixed text before it."""

    def __init__(self, encode, before: str | bytes = ""):
        super().__init__()
        self.before, self.encode, self.bytes = before, encode, 0

    def __missing__(self, text: str | bytes) -> bytes:
        ids = self.encode(self.before + text)
        if len(text) <= LONGEST:
            self[text] = ids
            self.bytes += 200 + 2 * len(text) + len(ids)
        return ids


class ByteBpe:
    """Encodes texts as the tokenizer's library does, word by word.

    The tokenizer's pattern starts a new word at a single space or line feed
    between two signs that are not white space, and never looks back over it, so
    a text is cut there and equal words are encoded once. Texts with other white
    space are cut at single spaces only. What is remembered is bounded by bytes.
    """

    _loaded: dict[str, ByteBpe] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings in a text are ordinary text
        self.size = self.tokenizer.get_vocab_size()
        self.model, self.letters = self.tokenizer.model, str.maketrans({chr(b): s for b, s in _stand_ins().items()})
        self.runs = _Known(self._run)
        self.first, self.later = _Known(self._ids), _Known(self._ids, " ")
        self.line = self._ids("\n")
        self.pieces = _Known(self._piece, b"")

    @classmethod
    def load(cls, path: str) -> ByteBpe:
        """One instance per Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _run(self, run: str) -> bytes:
        """Ids of one run of the tokenizer's pattern."""
        shown = run.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _ids(self, text: str) -> bytes:
        """Ids of a word, with or without a space before it."""
        space, word = (" ", text[1:]) if text[:1] == " " else ("", text)
        plain = _PLAIN.fullmatch(word) if 0 < len(word) <= LONGEST else None
        if not plain:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        letters, signs = plain.groups()
        if not letters:
            return self.runs[space + signs]
        return self.runs[space + letters] + self.runs[signs] if signs else self.runs[space + letters]

    def _words(self, words: list[str]) -> bytes:
        return self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:]))

    def _make_room(self) -> None:
        for known, share in ((self.pieces, 2 / 3), (self.first, 1 / 9), (self.later, 1 / 9), (self.runs, 1 / 9)):
            if known.bytes > REMEMBERED_BYTES * share:
                known.clear()
                known.bytes = 0

    @staticmethod
    def _odd(text: str) -> bool:
        """White space other than single signs between words, or two line feeds."""
        return bool(
            text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n\n" in text or _OTHER_SPACE.search(text)
        )

    def encode(self, text: str) -> bytes:
        """The ids of a text, 4 bytes each, little-endian."""
        self._make_room()
        if not text:
            return b""
        if self._odd(text):
            return self._words(_BETWEEN_WORDS.split(text))
        return self.line.join([self._words(line.split(" ")) for line in text.split("\n")])

    def _piece(self, piece: bytes) -> bytes:
        """Ids of a part of a word, with the white space before it."""
        text = piece.decode()
        if text[0] == "\n":
            return self.line + self.pieces[piece[1:]] if len(piece) > 1 else self.line
        return self._ids(text)

    def _look_up(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces; of letters the run is a word of the vocabulary's letters."""
        known, tokenize, added = self.pieces, self.model.tokenize, 0
        said = list(map(known.get, pieces))
        for n in [n for n, ids in enumerate(said) if ids is None]:
            piece = pieces[n]
            spaced = piece[0] == 32
            run = piece[1:] if spaced else piece
            if len(run) > LONGEST or not (run.isalpha() or _LETTERS.fullmatch(run.decode())):
                said[n] = known[piece]
                continue
            shown = run.decode() if run.isascii() else run.decode("latin-1").translate(self.letters)
            ids = said[n] = known[piece] = array("I", [t.id for t in tokenize("\u0120" + shown if spaced else shown)]).tobytes()
            added += 200 + 2 * len(piece) + len(ids)
        known.bytes += added
        return said

    def _odd_ones(self, texts: list[str]) -> np.ndarray:
        """Which texts are odd; only those with a suspicious byte are looked at one by one."""
        coded = [t.encode() for t in texts]
        signs = np.frombuffer(b"".join(coded) + b"\n", np.uint8)
        gap = _KIND[signs] == 3
        # Control signs, two signs of white space in a row (also across two texts), and the first
        # two bytes of every other white space.
        doubtful = ((signs < 32) & (signs != 10)) | np.append(gap[1:] & gap[:-1], False)
        high = np.flatnonzero(signs >= 0xC2)
        two = signs[high].astype(np.int32) << 8 | signs[np.minimum(high + 1, len(signs) - 1)]
        doubtful[high[np.isin(two, _WIDE_SPACE)]] = True
        ends = np.cumsum([len(c) for c in coded])
        out = np.zeros(len(texts), bool)
        maybe = np.zeros(len(texts), bool)
        maybe[np.minimum(np.searchsorted(ends, np.flatnonzero(doubtful), side="right"), len(texts) - 1)] = True
        for n, t in enumerate(texts):
            out[n] = t and (t[0] in " \n" or t[-1] in " \n" or (maybe[n] and self._odd(t)))
        return out

    def encode_texts(self, texts: list[str], end_id: int, kind: str) -> pa.Array:
        """The ids of each text and ``end_id``, as binary numbers of ``kind``.

        The same ids as ``encode`` gives; the words of many texts are told apart
        by Arrow, so only distinct ones are looked up.
        """
        return pa.concat_arrays([self._encode_chunk(part, end_id, kind) for part in _chunks(texts)] or [pa.array([], pa.binary())])

    def _encode_chunk(self, texts: list[str], end_id: int, kind: str) -> pa.Array:
        self._make_room()
        odd = self._odd_ones(texts)
        plain = [b"" if o else t.encode() for t, o in zip(texts, odd)]
        raw = b"".join(plain)
        stops = np.cumsum([len(t) for t in plain])
        signs = np.frombuffer(raw, np.uint8)
        sort = _KIND[signs]
        # Latin-1's letters are two bytes each.
        latin = np.flatnonzero(signs == 0xC3)
        latin = latin[(signs[latin + 1] != 0x97) & (signs[latin + 1] != 0xB7)]
        sort[latin] = sort[latin + 1] = 1
        begins = sort == 3
        # Between a letter and a sign (no apostrophe) the tokenizer's pattern always starts anew.
        begins[1:] |= (sort[1:] ^ sort[:-1] == 3) & (sort[1:] % 3 > 0) & (sort[:-1] % 3 > 0)
        begins[[stop - len(t) for stop, t in zip(stops.tolist(), plain) if t]] = True
        offsets = np.append(np.flatnonzero(begins), len(raw)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        said = self._look_up(coded.dictionary.to_pylist())
        # An odd text is one more piece, and so is every text's end, which comes after it.
        after = np.searchsorted(offsets[:-1], stops).astype(np.int32)
        number = np.flatnonzero(odd)
        extra = np.concatenate([np.arange(len(number)) + len(said), np.full(len(texts), len(said) + len(number))]).astype(np.int32)
        of = np.concatenate([number, np.arange(len(texts))])
        order = np.argsort(of, kind="stable")
        said += [self.encode(texts[n]) for n in number] + [int(end_id).to_bytes(4, "little")]
        codes = np.insert(coded.indices.to_numpy(), after[of][order], extra[order])
        sizes = np.fromiter(map(len, said), np.int32, len(said)) // 4
        flat = np.frombuffer(b"".join(said), "<u4").astype(kind)
        n = sizes[codes]
        ends = np.cumsum(n, dtype=np.int64)
        small = np.int32 if max(int(ends[-1]), len(flat)) < 1 << 31 else np.int64
        ends = ends.astype(small)
        at = np.repeat((np.cumsum(sizes) - sizes).astype(small)[codes] - (ends - n), n)
        at += np.arange(len(at), dtype=small)
        ids = flat[at]
        last = after + np.cumsum(odd + 1) - 1
        places = np.append(0, ends[last].astype(np.int64) * ids.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(places), pa.py_buffer(ids)])


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part
