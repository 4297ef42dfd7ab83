"""Texts in batches against the tokenizer, each in one piece."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from harborline.llm import shingles, tokens


@pytest.mark.parametrize("together", [None, 1, 200, 1 << 24])
def test_batches(together):
    path = tokens.public_path("word_bpe_49k.json")
    rng, library, encoder = random.Random(together or 0), Tokenizer.from_file(path), tokens.WordEncoder(path, memory=40)
    parts = ["Word", "wórd", "it's", "I'LL", "don't.", "...", "a1b2", "x_y", "<|endoftext|>", "<|", "|>", "é", "É", "é", "😀", "ß", "ﬁ", "中文", "100,000.5", "C++"]
    spaces = [" ", "\n", "\t ", "\x0b", "\x0c\r", " ", " ", "\x85", "\x1c", "  ", ""]
    texts = ["".join(rng.choice(parts) + rng.choice(spaces) for _ in range(rng.randrange(12))) for _ in range(400)] + ["", " ", "\n", None, "end " * 3000]
    got = list(encoder.encode_all(pa.array(texts, pa.string()).slice(3), together))
    assert len(got) == len(texts) - 3
    for text, ids in zip(texts[3:], got):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert list(encoder.encode_all(pa.array([], pa.string()), together)) == []


def test_a_full_memory_moves_what_is_met_again_at_once(monkeypatch):
    """Not chunk by chunk: with more distinct chunks in some texts than the
    memory holds, all of them would be learnt anew each time."""
    encoder = tokens.WordEncoder(tokens.public_path("word_bpe_49k.json"), memory=20)
    texts = pa.array([" ".join(f"wört{i}, word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)), None, "", "a  b\tA"])
    expected = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert [x.tolist() for x in encoder.encode_all(texts, 1 << 20)] == expected
    learnt, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda chunk: learnt.append(chunk) or learn(chunk))
    for _ in range(3):
        assert [x.tolist() for x in encoder.encode_all(texts, 1 << 20)] == expected
    assert not learnt


def test_a_worker_remembers_one_kind_at_a_time():
    path = tokens.public_path("word_bpe_49k.json")
    shingles.word_hashes([b"some", b"words"])
    assert shingles._WORDS
    assert tokens.encoder(path) is tokens.encoder(path)
    assert not shingles._WORDS
    before = shingles.word_hashes([b"some"])
    assert not tokens._ENCODERS and shingles.word_hashes([b"some"]) == before
    list(shingles.shingle_sets(pa.array(["some words"])))
    assert not shingles._WORDS
