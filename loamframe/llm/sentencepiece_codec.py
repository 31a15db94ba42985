"""SentencePiece encoding and decoding by Viterbi over an Aho-Corasick automaton."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from loamframe.llm.common import fresh, whole_text

SPACE = "▁"  # stands for a blank in pieces
CACHED = 300_000
UNKNOWN_PENALTY = 10.0


class Automaton:
    """Aho-Corasick automaton over a model's pieces.

    States are numbered; ``step`` holds each state's own edges, ``fail`` its
    longest proper suffix state, ``piece`` the piece that ends there (if any)
    and ``output`` the nearest suffix state where a piece ends.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        self.step: list[dict[str, int]] = [{}]
        self.piece: list[tuple[int, int, float] | None] = [None]
        for text, (number, score) in pieces.items():
            state = 0
            for letter in text:
                if letter not in self.step[state]:
                    self.step[state][letter] = len(self.step)
                    self.step.append({})
                    self.piece.append(None)
                state = self.step[state][letter]
            self.piece[state] = (len(text), number, score)
        self.fail = [0] * len(self.step)
        self.output = [0] * len(self.step)
        queue = [s for s in self.step[0].values()]
        for state in queue:
            for letter, to in self.step[state].items():
                back = self.fail[state]
                while back and letter not in self.step[back]:
                    back = self.fail[back]
                self.fail[to] = self.step[back].get(letter, 0)
                queue.append(to)
            suffix = self.fail[state]
            self.output[state] = suffix if self.piece[suffix] else self.output[suffix]

    def segment(self, text: str, unknown: float) -> list[tuple[int, int]]:
        """(piece, length) of the best segmentation; piece -1 is one unknown letter.

        One pass: the automaton reads a letter, then the pieces that end there,
        found along the output links, relax the best score of this position.
        Ties go to the longer last piece.
        """
        best, back = [0.0], [(-1, 0)]
        state, step, fail, output, piece = 0, self.step, self.fail, self.output, self.piece
        for at, letter in enumerate(text, 1):
            while state and letter not in step[state]:
                state = fail[state]
            state = step[state].get(letter, 0)
            top, how, single = None, None, False
            ends = state if piece[state] else output[state]
            while ends:
                size, number, score = piece[ends]
                value = best[at - size] + score
                single |= size == 1
                if top is None or value > top:
                    top, how = value, (number, size)
                ends = output[ends]
            if not single:  # a letter that is no piece can still be passed
                value = best[at - 1] + unknown
                if top is None or value > top:
                    top, how = value, (-1, 1)
            best.append(top)
            back.append(how)
        out, at = [], len(text)
        while at:
            out.append(back[at])
            at -= back[at][1]
        return out[::-1]


class Codec(dict):
    """Encodes and decodes with one model; maps a chunk of text to its ids.

    No piece of a usual vocabulary has a blank after another letter, so the best
    segmentation never crosses such a place and each chunk (blanks, then
    letters) is segmented once and remembered; otherwise a text is one chunk.
    Letters that are no piece become their UTF-8 bytes' pieces.
    """

    _loaded: dict[str, Codec] = {}

    def __init__(self, model: str):
        import sentencepiece

        super().__init__()
        source = sentencepiece.SentencePieceProcessor(model_file=model)
        size = source.get_piece_size()
        numbers = range(size)
        plain = [i for i in numbers if not (source.is_control(i) or source.is_unknown(i) or source.is_byte(i) or source.is_unused(i))]
        pieces = {source.id_to_piece(i): (i, source.get_score(i)) for i in plain}
        self.pieces, self._automaton = pieces, None
        self.unknown = min(score for _, score in pieces.values()) - UNKNOWN_PENALTY
        self.bytes_at = {int(source.id_to_piece(i)[1:-1], 16): i for i in numbers if source.is_byte(i)}
        self.unknown_id = source.unk_id()
        self.text_of = {i: source.id_to_piece(i).replace(SPACE, " ").encode() for i in plain} | {i: bytes([b]) for b, i in self.bytes_at.items()}
        feeds = any("\n" in p for p in pieces) or 10 not in self.bytes_at
        self.feed = b"" if feeds else array("I", [self.bytes_at[10]]).tobytes()
        self.after_blank = _AfterBlank(self)
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    @property
    def automaton(self) -> Automaton:
        """Built when first needed: decoding does without."""
        if self._automaton is None:
            self._automaton = Automaton(self.pieces)
        return self._automaton

    @classmethod
    def load(cls, model: str) -> Codec:
        """One instance per Python worker."""
        if model not in cls._loaded:
            cls._loaded[model] = cls(model)
        return cls._loaded[model]

    def __missing__(self, chunk: str) -> bytes:
        ids, at = array("I"), 0
        for number, size in self.automaton.segment(chunk, self.unknown):
            if number >= 0:
                ids.append(number)
            elif self.bytes_at:
                ids.extend(self.bytes_at[b] for b in chunk[at].encode())
            else:
                ids.append(self.unknown_id)
            at += size
        self[chunk] = made = ids.tobytes()
        return made

    def encode(self, text: str) -> bytes:
        """Ids of a text (4 bytes each), a blank put before it. Blanks are kept
        one by one; a literal stand-in for a blank is written as bytes, so
        decoding is exact."""
        if not text:
            return b""
        if len(self) + len(self.after_blank) > CACHED:
            self.clear()
            self.after_blank.clear()
        literal = array("I", [self.bytes_at[b] for b in SPACE.encode()]).tobytes() if SPACE in text else b""
        return literal.join(map(self._plain, (" " + text).split(SPACE)))

    def _plain(self, text: str) -> bytes:
        if not self.splits:
            return self[text.replace(" ", SPACE)] if text else b""
        # A letter of no piece stands alone in any segmentation; of these, the
        # line feed is common enough to split at.
        lines = text.split("\n") if self.feed else [text]
        return self.feed.join(map(self._line, lines))

    def _line(self, line: str) -> bytes:
        first, *words = line.split(" ")
        head = self[first] if first else b""
        if "" not in words:
            return head + b"".join(map(self.after_blank.__getitem__, words))
        parts, blanks = [head], ""
        for word in words:
            blanks += SPACE
            if word:
                parts.append(self[blanks + word])
                blanks = ""
        if blanks:
            parts.append(self[blanks])
        return b"".join(parts)

    def decode(self, ids: list[int]) -> str:
        """The text of some ids (what ``encode`` was given)."""
        text = b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class _AfterBlank(dict):
    """Ids of a word with one blank before it."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        made = self[word] = self.codec.__missing__(SPACE + word)
        del self.codec[SPACE + word]
        return made


def encode_texts(documents: DataFrame, model: str, text: str = "text", name: str = "ids") -> DataFrame:
    """All columns of ``documents`` and the ids of every whole text.

    A null text is empty and has no ids. An existing column of that name is
    replaced; rows are encoded on their own, nothing is shuffled.
    """
    rest = [c for c in documents.columns if c != name]
    schema = documents.select(*rest).schema.add(name, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(model)
        for b in batches:
            made = [codec.encode(t.as_py()) for t in b.column(len(rest))]
            ends = np.cumsum([0] + [len(ids) // 4 for ids in made])
            flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(made))])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], lists], names=[*rest, name])

    return documents.select(*rest, whole_text(text).alias(fresh(documents, "_text"))).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, model: str, ids: str = "ids", name: str = "decoded", checksum: str | None = None) -> DataFrame:
    """All columns of ``encoded`` and the text of every list of ids (null: empty).

    ``checksum`` names a further column for the CRC-32 of the ids as
    little-endian unsigned 32-bit numbers, made in the same pass. Existing
    columns of these names are replaced.
    """
    made = [name, *([checksum] if checksum else [])]
    rest = [c for c in encoded.columns if c not in made]
    schema = encoded.select(*rest).schema.add(name, "string")
    schema = schema.add(checksum, "long") if checksum else schema
    at = rest.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(model)
        for b in batches:
            texts, sums = [], []
            for x in b.column(at):
                numbers = x.values.to_numpy() if x.is_valid else np.zeros(0, np.int32)
                texts.append(codec.decode(numbers.tolist()))
                sums.append(zlib.crc32(numbers.astype("<u4").tobytes()))
            columns = [pa.array(texts, pa.string()), pa.array(sums, pa.int64())][: len(made)]
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=[*rest, *made])

    return encoded.select(*rest).mapInArrow(run, schema)
