"""Encoding and decoding against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from txrisk.llm import queries, sentencepiece_bpe, token_counts

MODEL = token_counts.installed("piece_bpe_32k.model")
PARTS = [
    "a", "aa", "e", " ", "  ", "▁", "\n", "th", "é", "中", "🙂", "0", "\x00", ".", "x", "   ", "the ", "ing", "=", "-",
    "\t", "ab", "<s>", "<0x41>", " " * 17, "=" * 40, "é",
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def words():
    return sentencepiece_bpe.Vocabulary(MODEL)


def test_encodes_as_the_library(library, words):
    encoder, rnd = sentencepiece_bpe.Encoder(words), random.Random(3)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 30))) for _ in range(5000)]
    texts += ["", " ", "a" * 5000, " " * 5000, "ab" * 3000 + " ", "中" * 500, "x" + "=" * 300]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text), text


def test_every_piece_as_a_text(library, words):
    encoder = sentencepiece_bpe.Encoder(words)
    for piece in words.ids:
        text = piece.replace("▁", " ")
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text), piece


def test_kept_units_and_pairs_are_bounded(library, words, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "KEPT_UNITS", 5)
    monkeypatch.setattr(sentencepiece_bpe, "KEPT_PAIRS", 5)
    encoder = sentencepiece_bpe.Encoder(words)
    text = " ".join(f"word{k % 50} and more" for k in range(200))
    assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text)
    assert len(encoder) <= 5


def test_decodes_any_ids_as_the_library(library, words):
    decoder, rnd = sentencepiece_bpe.Decoder(words), random.Random(4)
    for _ in range(5000):
        ids = [rnd.choice([rnd.randrange(words.size), rnd.randrange(260)]) for _ in range(rnd.randint(0, 12))]
        assert decoder.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):  # noqa: B017
        sentencepiece_bpe.Vocabulary(str(tmp_path / "none.model"))


def test_query_equals_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, text in texts.items():
        ids = library.encode(text)
        want[i] = (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
    got = queries.op11_sentencepiece(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert len(got) == len(texts)


def test_odd_rows(spark, library):
    long = "long text, again. " * 60_000
    rows = [(1, None, 7), (2, "", 7), (None, "no id", 7), (3, " \t\n ", 7), (3, " \t\n ", 7), (4, long, None), (5, "🙂\x00", 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(2)
    encoded = sentencepiece_bpe.encode(table, MODEL)
    got = sorted((str(r.doc_id), r.ids, r.text) for r in sentencepiece_bpe.decode(encoded, MODEL).collect())
    want = [(str(i), library.encode(t or ""), t or "") for i, t, _ in rows]
    assert got == sorted(want)
    none = table.limit(0)
    assert sentencepiece_bpe.decode(sentencepiece_bpe.encode(none, MODEL), MODEL).collect() == []
    given = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in sentencepiece_bpe.decode(given, MODEL).collect()] == ["", ""]
