"""Word windows of a text as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from harborline.llm import memory

#: Words a worker remembers (about 200 bytes each) before it starts anew.
MEMORY = 500_000

#: Bytes of text whose words are numbered together (one text at least).
TOGETHER = 8 << 20

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


#: Words of more bytes than this are hashed one by one.
LONG = 64
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Words()


def word_hashes(words: list[bytes]) -> np.ndarray:
    memory.hold("words", _WORDS.clear)
    if len(_WORDS) > MEMORY:
        _WORDS.clear()
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def windows(hashed: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` words, by its first word."""
    n = len(hashed) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = h * _STEP + hashed[i : i + n]
        h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def _mixed(h: np.ndarray) -> np.ndarray:
    """In place; different numbers stay different."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _hashed(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word's bytes, eight at a time, and how many it has."""
    _, at, data = words.buffers()
    at = np.frombuffer(at, np.int64 if pa.types.is_large_string(words.type) else np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    length, at = np.diff(at), at[:-1]
    padded = np.concatenate([np.frombuffer(data or b"", np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    h = _mixed((length.astype(np.uint64) * _STEP) ^ (eight[at] & _MASKS[np.minimum(length, 8)]))
    left = np.flatnonzero((length > 8) & (length <= LONG))
    done = 8
    while len(left):
        h[left] = _mixed(h[left] ^ (eight[at[left] + done] & _MASKS[np.minimum(length[left] - done, 8)]))
        done += 8
        left = left[length[left] > done]
    for i in np.flatnonzero(length > LONG).tolist():
        h[i] = xxhash.xxh3_64_intdigest(padded[at[i] : at[i] + length[i]])
    return h, length


def _parts(texts: pa.Array):
    """``texts``, some at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, start = np.cumsum(sizes), 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + TOGETHER, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def _split(texts: pa.Array) -> pa.Array:
    """The words of each text, A-Z lower-cased, split at blanks and \\x09-\\x0D;
    blanks at an end of a text leave an empty one."""
    return pc.ascii_split_whitespace(pc.fill_null(pc.ascii_lower(texts), ""))


def shingle_sets(texts: pa.Array, k: int = 5):
    """Some texts at a time: the sorted distinct ``k``-word shingles of each,
    one text after the other, and how many each has. A text of fewer words is
    one shingle; one without words has none."""
    memory.release()
    for part in _parts(texts):
        split = _split(part)
        hashed, length = _hashed(split.flatten())
        stops = np.concatenate([[0], np.cumsum(length > 0)])[np.cumsum(pc.list_value_length(split).to_numpy())]
        hashed = hashed[length > 0]
        starts = np.concatenate([[0], stops[:-1]])
        every, some = windows(hashed, k), []
        for i, j in zip(starts.tolist(), stops.tolist()):
            own = every[i : j - k + 1] if j - i >= k else windows(hashed[i:j], max(1, j - i))
            own.sort()
            some.append(own)
        tokens, sizes = np.concatenate(some), np.fromiter(map(len, some), np.int64, len(some))
        fresh = np.ones(len(tokens), bool)
        fresh[1:] = tokens[1:] != tokens[:-1]
        fresh[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        upto = np.concatenate([[0], np.cumsum(fresh)])[np.concatenate([[0], np.cumsum(sizes)])]
        yield tokens[fresh], np.diff(upto)


def numbered(texts: pa.Array):
    """Some texts at a time: the hashes of their distinct words, the last two
    bytes of each as a number, each word's place among them, and the number of
    words of each text."""
    for part in _parts(texts):
        split = _split(part)
        per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        at = coded.indices.to_numpy()
        length = np.fromiter(map(len, words), np.int64, len(words))
        joined = np.frombuffer(b"\0" + b"".join(words), np.uint8)
        last = np.cumsum(length)
        ends = joined[last].astype(np.int64) * 31 + np.where(length > 1, joined[np.maximum(last - 1, 0)], 0)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        if (length == 0).any():  # blanks at an end of a text
            there = (length > 0)[at]
            stops = np.cumsum(per_text)
            kept = np.concatenate([[0], np.cumsum(there)])
            per_text, at = kept[stops] - kept[stops - per_text], at[there]
        yield hashes, ends, at, per_text
