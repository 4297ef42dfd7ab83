"""The stages, each against brute force on what its predecessor kept."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from harborline.llm import decontamination as D, tokens, toxicity
from harborline.llm.common import table

from conftest import SF
from test_decontamination import brute as contained
from test_entropy_secrets import brute as secrets
from test_jaccard_join import brute as groups


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def secretless(text):
    _, spans = secrets(text)
    out, at = [], 0
    for _, a, z in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, z)
    return "".join(out) + text[at:] if spans else text


def test_stages(spark):
    docs = table(spark, SF, "documents")
    names = docs.columns
    model = toxicity.train(docs, table(spark, SF, "labels"))
    clean = P.drop_toxic(spark, docs, SF)
    assert clean.columns == names
    rows = [r for r in rows_of(docs) if model.severity(np.array([model.score(toxicity.features(r[1] or ""))]))[0] < toxicity.REJECT]
    assert rows_of(clean) == rows

    docs = spark.createDataFrame(rows, docs.schema)
    first = {i for i, _, c in groups([r[:2] for r in rows]) if i == c}
    rows = [r for r in rows if r[0] in first]
    assert rows_of(P.drop_near_copies(spark, docs, SF)) == rows

    docs = spark.createDataFrame(rows, docs.schema)
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    gone = {i for i, *_ in contained([r[:2] for r in rows], items)}
    rows = [r for r in rows if r[0] not in gone]
    assert rows_of(P.drop_contaminated(spark, docs, SF)) == rows

    docs = spark.createDataFrame(rows, docs.schema)
    rows = sorted(((i, t := secretless(text), lang, source, len(t)) for i, text, lang, source, _ in rows), key=str)
    assert rows_of(P.redact_secrets(spark, docs, SF)) == rows

    encode = Tokenizer.from_file(tokens.public_path("word_bpe_49k.json")).encode
    want = []
    for i, text, *_ in rows:
        ids = np.array(encode(text, add_special_tokens=False).ids + [1], "<u4")
        want += [(i, k // 4096, k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096])) for k in range(0, len(ids), 4096)]
    got = rows_of(P.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32"))
    assert got == sorted(want, key=str)


@pytest.fixture()
def odd(spark):
    p = " ".join(f"p{i}" for i in range(30))
    rows = [(1, None, "en", "a", None), (None, "no id", "en", None, 5), (2, "", None, "a", 0), (2, "", None, "a", 0), (3, p, "en", "a", 1), (4, p + " end", "en", "a", 1),
            (5, "password = hunter22x and more", "en", "a", 29), (6, "w " * 60000, "en", "a", 120000), (6, "other", "en", "a", 5)]
    return spark.createDataFrame([r + (7,) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, severity int")


@pytest.mark.parametrize("stage", [f for _, f in P.STAGES[:-1]])
def test_odd_rows(spark, odd, stage):
    got = stage(spark, odd, SF)
    assert got.columns == odd.columns
    want = [r for r in rows_of(odd) if not (stage is P.drop_near_copies and r[0] == 4)]
    got = rows_of(got)
    if stage is P.redact_secrets:
        assert [r[0] for r in got] == [r[0] for r in want]
        assert [r[1] for r in got if r[0] == 5] == ["[SECRET] and more"]
    else:
        assert got == want
    assert stage(spark, odd.where("false"), SF).count() == 0


def test_packing_odd_rows(spark, odd):
    got = P.pack_sequences(spark, odd, SF).collect()
    assert sorted(str(r["doc_id"]) for r in got if r["piece"] == 0) == sorted(str(r[0]) for r in odd.collect())
    assert P.pack_sequences(spark, odd.where("false"), SF).count() == 0


def repeated(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_near_copies_of_repeated_ids(spark):
    """Only the linked row of an id goes, and of equal rows one stays."""
    p, q, r = (" ".join(f"{c}{i}" for i in range(40)) for c in "pqr")
    keep = [(1, p, "en", "a", 1), (5, q, "en", "a", 1), (7, r, "en", "a", 2), (7, "", "en", "a", 0), (7, "", "en", "a", 0), (None, p, "en", "a", 1), (None, p, "en", "a", 1)]
    gone = [(5, p + " end", "en", "a", 1), (7, r, "en", "a", 3), (7, r, "en", "b", 2), (1, p, "en", "a", 1), (9, r + " end", "en", "a", 1)]
    assert rows_of(P.drop_near_copies(spark, repeated(spark, keep + gone), SF)) == sorted(keep, key=str)


def test_contaminated_rows_of_repeated_ids(spark):
    item = max((r["text"] for r in table(spark, SF, "benchmark").collect()), key=len)
    keep = [(1, "clean words only, none of them an item of any test", "en", "a", 1), (None, "clean as well", "en", "a", 1), (2, None, "en", "a", None)]
    gone = [(1, f"see {item} here", "en", "a", 1), (None, item, "en", "a", 1), (2, item, "en", "a", 1)]
    assert rows_of(P.drop_contaminated(spark, repeated(spark, keep + gone), SF)) == sorted(keep, key=str)
