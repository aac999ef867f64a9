"""Encoding texts with a ``tokenizers`` file inside tasks.

Both tokenizer files split a text at white space before any merge, so a text may be
cut before white space that follows a visible character: no piece the tokenizer
forms crosses such a cut. Each distinct chunk is encoded once per Python worker and
remembered: text repeats its words, and looking a chunk up costs a small part of
encoding it. The table of remembered chunks is bounded (``MAX_CHUNKS``) and is
started anew when full.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import chain

import numpy as np

# White space, then visible characters; white space that doesn't begin with a
# space or line feed stays inside its chunk.
_CHUNK = re.compile(r"\s*\S+(?:[^\S \n]\s*\S+)*|\s+")
# A line feed, a word of Latin-1 letters, ASCII punctuation but the apostrophe: each
# part present is one piece for both tokenizers, so it can go to the merges at once.
_PLAIN = re.compile(r"(\n)?( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]+)?")
_AS_IS = "\x00"  # in front of a key that is the chunk itself
MAX_CHUNKS = 800_000
MAX_CHUNK_CHARS = 4096  # longer ones are encoded but not remembered


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write each byte as a printable letter: visible
    Latin-1 as it is, the others from 256 on in order."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: 256 + i for i, b in enumerate(rest)}


_LETTER_OF = _byte_letters()

_ENCODERS: dict[str, "Encoder"] = {}


def _letters(part: str) -> str:
    """A part of a chunk as the vocabulary writes its bytes."""
    if part.isascii() and part.isprintable():
        return part.replace(" ", chr(_LETTER_OF[32]))
    return part.encode().decode("latin-1").translate(_LETTER_OF)


class _Numbers(dict):
    """Numbers keys in order of first sight; ``new`` holds those whose ids aren't known yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self._reset()

    def _reset(self) -> None:
        self.index = _Numbers()
        self.sizes = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _keys(self, text: str) -> list[str]:
        """The text's chunks as keys: a chunk in front of which only a space is
        missing, a chunk with its line feed, or a marked chunk as it is."""
        if _AS_IS not in text and text.replace("\n", " ").split(" ") == text.split():
            # Words between single spaces and line feeds: plain splitting is right.
            keys = text.replace("\n", " \n").split(" ")
            keys[0] = _AS_IS + keys[0]
            return keys
        return [_AS_IS + c for c in _CHUNK.findall(text)]

    @staticmethod
    def _chunk(key: str) -> str:
        return key[1:] if key[0] == _AS_IS else key if key[0] == "\n" else " " + key

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk. Plain ones skip the normalizer and the splitting, of
        which they need nothing, and cost a third of a full call."""
        merge, out, other = self.tokenizer.model.tokenize, [], []
        marks: dict[str, list[int]] = {}  # line feed and punctuation repeat more than words
        for i, c in enumerate(chunks):
            plain = _PLAIN.fullmatch(c)
            if not plain:
                out.append([])
                other.append(i)
                continue
            feed, word, mark = plain.groups()
            ids = [t.id for t in merge(_letters(word))]
            for m in filter(None, (feed, mark)):
                if m not in marks:
                    marks[m] = [t.id for t in merge(_letters(m))]
            out.append((marks[feed] if feed else []) + ids + (marks[mark] if mark else []) if feed or mark else ids)
        found = self.tokenizer.encode_batch_fast([chunks[i] for i in other], add_special_tokens=False)
        for i, e in zip(other, found):
            out[i] = e.ids
        return out

    def _learn(self) -> None:
        """Ids of the new chunks, appended in the order of their numbers."""
        ids = self._ids([self._chunk(k) for k in self.index.new])
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])
        self.index.new = []

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids (uint32) of each whole text."""
        if len(self.index) > MAX_CHUNKS:
            self._reset()
        number, numbers, ends = self.index.__getitem__, [], []
        for text in texts:
            numbers.extend(map(number, self._keys(text)))
            ends.append(len(numbers))
        long = any(len(k) > MAX_CHUNK_CHARS for k in self.index.new)
        if self.index.new:
            self._learn()
        at = np.array(numbers, np.int64)
        size = self.sizes[at]
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = self.flat[np.repeat(self.starts[at] - upto[:-1], size) + np.arange(upto[-1])]
        if long:
            self._reset()  # very long chunks aren't kept in memory
        cuts = [0, *upto[ends].tolist()]
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


class WordEncoder(Encoder):
    """For a tokenizer that drops white space: chunks are words."""

    def _keys(self, text: str) -> list[str]:
        # str.split also cuts at \x1c-\x1f, which are no white space to the tokenizer.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return _CHUNK.findall(text)
        return text.split()

    @staticmethod
    def _chunk(key: str) -> str:
        return key

    def _reset(self) -> None:
        super()._reset()
        self.words: dict[str, list[int]] = {}  # a word's ids, whatever its case and the marks around it

    def _ids(self, chunks: list[str]) -> list[list[int]]:
        merge, words, out, other = self.tokenizer.model.tokenize, self.words, [], []
        collecting = gc.isenabled()
        gc.disable()  # millions of small lists and no cycles: collections would only cost time
        try:
            for i, c in enumerate(chunks):
                feed, word, mark = None, c, c[-1]
                if c.isascii() and c.isalpha():  # most words, without the pattern
                    mark = None
                elif c.isascii() and mark in ",.;:!?" and c[:-1].isalpha():
                    word = c[:-1]
                else:
                    plain = _PLAIN.fullmatch(c)
                    if not plain:
                        out.append([])
                        other.append(i)
                        continue
                    feed, word, mark = plain.groups()
                word = word.lower()
                ids = words.get(word)
                if ids is None:
                    ids = words[word] = [t.id for t in merge(_letters(word))]
                if mark:
                    if mark not in words:
                        words[mark] = [t.id for t in merge(_letters(mark))]
                    ids = ids + words[mark]
                out.append([t.id for t in merge(_letters(feed))] + ids if feed else ids)
        finally:
            if collecting:
                gc.enable()
        found = self.tokenizer.encode_batch_fast([chunks[i] for i in other], add_special_tokens=False)
        for i, e in zip(other, found):
            out[i] = e.ids
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        import json
        with open(path) as f:
            words = json.load(f)["model"].get("end_of_word_suffix")
        _ENCODERS[path] = (WordEncoder if words else Encoder)(path)
    return _ENCODERS[path]


def batches(texts: list[str], chars: int = 1 << 20):
    """Runs of neighbouring texts of about ``chars`` characters: (from, to)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
