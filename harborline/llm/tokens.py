"""Token ids of whole texts with the ``tokenizers`` library, one distinct word
at a time.

The word tokenizer drops white space and never merges across it, so a text's
ids are the ids of its white-space-separated chunks, one after the other. Each
Python worker keeps the ids of the chunks it has met (a bounded memory), so
the library encodes a chunk once instead of at each occurrence; texts are split
and their chunks numbered in Arrow, some MB at a time, so that this memory is
asked once for each distinct chunk of those. Chunks of plain Latin letters with trailing punctuation go straight to the library's BPE
model; all others through the whole tokenizer. ``tests/llm`` holds both
against encoding the text in one piece.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from harborline.llm import memory

#: Chunks of a generation. A worker keeps two: when the younger is full, the
#: older goes; what is met again moves to the younger.
MEMORY = 300_000

#: Bytes of text whose chunks are numbered together (one text at least), where
#: a job has the executors to itself: about ten times as many are held meanwhile.
TOGETHER = 24 << 20

# punctuation of which a run at a word's end is one token of its own (without
# what starts a contraction or a special token)
_MARKS = b"!\"#$%&()*+,-./:;=>?@[\\]^_`{}~"
# letters that Unicode normalisation leaves alone
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in that byte-level BPE uses for each byte: itself
    if it is printable in Latin-1, else the next code point from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    table, spare = {}, 256
    for byte in range(256):
        if byte in printable:
            table[byte] = chr(byte)
        else:
            table[byte], spare = chr(spare), spare + 1
    return table


class _Generation(dict):
    """Number of each chunk; the ids of chunk ``i`` are
    ``ids[ends[i]:ends[i + 1]]``. A chunk that is not there is learnt."""

    def __init__(self, learn):
        self.learn = learn
        self.ids, self.ends = array("I"), array("q", [0])

    def of(self, chunk: bytes) -> array:
        i = self[chunk]
        return self.ids[self.ends[i] : self.ends[i + 1]]

    def take(self, older: _Generation, chunks: list[bytes]) -> None:
        """Learn those of ``chunks`` (distinct) that are in ``older``, at once."""
        found = [c for c in chunks if c in older and c not in self]
        if not found:
            return
        numbers = np.fromiter(map(older.__getitem__, found), np.int64, len(found))
        ends = np.frombuffer(older.ends, np.int64)
        sizes = ends[numbers + 1] - ends[numbers]
        stop = np.cumsum(sizes)
        places = np.repeat(ends[numbers] - (stop - sizes), sizes) + np.arange(stop[-1])
        first, before = len(self), len(self.ids)
        self.ids.frombytes(np.frombuffer(older.ids, np.uint32)[places].tobytes())
        self.ends.frombytes((stop + before).tobytes())
        self.update(zip(found, range(first, first + len(found))))

    def __missing__(self, chunk: bytes) -> int:
        ids = self.learn(chunk)
        self.ids.extend(ids)
        self.ends.append(len(self.ids))
        i = self[chunk] = len(self)
        return i


class WordEncoder:
    """``encode(bytes)``: the ids of a UTF-8 text, as ``uint32``."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.memory = memory
        self.letters = _byte_letters()
        self.known, self.older = _Generation(self._learn), {}

    def _bpe(self, word: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def _learn(self, chunk: bytes):
        if chunk in self.older:
            return self.older.of(chunk)
        if chunk.isalpha():  # ASCII letters, which stand for themselves
            return self._bpe(chunk.lower().decode())
        if not (core := chunk.rstrip(_MARKS)):
            return self._bpe(chunk.decode())
        if core.isalpha() or _LETTERS.fullmatch(core.decode("utf-8", "replace")):
            if len(core) < len(chunk):
                return self.known.of(core) + self.known.of(chunk[len(core) :])
            return self._bpe(core.decode().lower().encode().decode("latin-1").translate(self.letters))
        return self.tokenizer.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids

    def encode(self, text: bytes) -> np.ndarray:
        # the tokenizer lower-cases all but its special tokens
        chunks = (text if b"<|" in text else text.lower()).split()
        self._turn()
        return self._ids(chunks, np.arange(len(chunks)))[0]

    def _turn(self) -> None:
        if len(self.known) > self.memory:
            self.known, self.older = _Generation(self._learn), self.known

    def _ids(self, chunks: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``chunks[i]`` for each ``i`` of ``at``, one after the
        other, and where those of each end."""
        known = self.known
        numbers = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        ends = np.frombuffer(known.ends, np.int64)
        first = ends[numbers]
        sizes = (ends[numbers + 1] - first)[at]
        stop = np.cumsum(sizes)
        if not len(stop) or not stop[-1]:
            return np.empty(0, np.uint32), stop
        places = np.repeat(first[at] - (stop - sizes), sizes)
        places += np.arange(stop[-1])
        return np.frombuffer(known.ids, np.uint32)[places], stop

    def encode_all(self, texts: pa.Array, together: int | None = None) -> Iterator[np.ndarray]:
        """The ids of each text of a string array; a null text has none.
        ``together``: bytes whose chunks are numbered together; None: one text
        at a time, which takes longer and the least memory."""
        if together is None:
            yield from (self.encode(text or b"") for text in texts.cast(pa.binary()).to_pylist())
            return
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        upto, start = np.cumsum(sizes), 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + together, "right")))
            yield from self._together(texts.slice(start, stop - start))
            start = stop

    def _together(self, texts: pa.Array) -> Iterator[np.ndarray]:
        special = pc.fill_null(pc.match_substring(texts, "<|"), False)
        split = pc.ascii_split_whitespace(pc.if_else(special, "", pc.fill_null(pc.ascii_lower(texts), "")))
        numbered = split.flatten().dictionary_encode()
        chunks = numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        self._turn()
        if self.older:
            self.known.take(self.older, chunks)
        ids, ends = self._ids(chunks, numbered.indices.to_numpy())
        ends = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        for i, own in enumerate(special.to_pylist()):
            yield self.encode(texts[i].as_buffer().to_pybytes()) if own else ids[ends[i] : ends[i + 1]]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    memory.hold("tokens", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def public_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
