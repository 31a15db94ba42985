"""Ids of a word-level BPE tokenizer, each distinct word encoded once per worker."""

from __future__ import annotations

import os
import re

import numpy as np

# A lower-cased word that needs no normalisation: Latin-1 letters, which the
# tokenizer's pattern takes as one word, then other ASCII signs (no apostrophe,
# which may start a contraction), which it takes as a second.
PLAIN = re.compile(r"([a-zà-öø-ÿß]*)([!-&(-/:-@\[-`{-~]*)")
CACHED = 400_000


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    stand_in = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [stand_in[b] for b in range(256)]


class WordBpe(dict):
    """Maps a word without white space to its ids (little-endian, 4 bytes each).

    The tokenizer drops white space and never merges across it, so the ids of a
    text are those of its words. Words are kept between batches, up to a fixed
    number; then the cache starts anew.
    """

    _loaded: dict[str, WordBpe] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # control strings in a text are ordinary text
        self.model = self.tokenizer.model
        self.letters = {chr(b): s for b, s in enumerate(_byte_letters())}
        self.table = str.maketrans(self.letters)
        self.runs: dict[str, bytes] = {"": b""}

    @classmethod
    def load(cls, path: str) -> WordBpe:
        """One instance per Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def encode(self, text: str) -> bytes:
        if len(self) > CACHED:
            self.clear()
        # Only these four are split off here; the tokenizer sees all other white space.
        return b"".join(map(self.__getitem__, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))

    def run(self, run: str) -> bytes:
        """Ids of one word of the tokenizer's pattern."""
        ids = self.runs.get(run)
        if ids is None:
            if len(self.runs) > CACHED:
                self.runs.clear()
                self.runs[""] = b""
            shown = run.encode().decode("latin-1").translate(self.table)
            ids = self.runs[run] = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        return ids

    def __missing__(self, word: str) -> bytes:
        plain = PLAIN.fullmatch(word.lower()) if len(word) < 64 else None
        if plain:
            ids = self.run(plain[1]) + self.run(plain[2])
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids
