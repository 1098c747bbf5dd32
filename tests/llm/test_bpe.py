"""Ids against the reference tokenizer library, and the way back."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from fraudtide.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def coder(ranks):
    return bpe.Codec(ranks, PATTERN)


@pytest.fixture(scope="module")
def known(ranks):
    pairs = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=pairs, special_tokens={})


def test_perfect_hash_is_minimal_and_sure(ranks):
    pairs = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    table = bpe.PerfectHash(pairs)
    assert all(table.get(k) == v for k, v in pairs.items())
    assert sorted(table.ids) == sorted(pairs.values())
    assert table.get(b"no such entry at all") == -1 and bpe.PerfectHash({}).get(b"a") == -1


def test_same_ids_as_the_library(coder, known):
    rng = random.Random(2)
    letters = "abcdefgh \n\t'sdt.,!éüß漢🙂\x00\x1c\x85  ٣²01  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text in [*texts, "", "a" * 5000, " " * 4000 + "x", "<|endoftext|>"]:
        ids = np.frombuffer(coder.encode(text), dtype="<u4").tolist()
        assert ids == known.encode_ordinary(text)
        assert coder.decode(coder.encode(text)) == text.encode()


def test_parts_join_to_the_same_ids(coder, known, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 10)
    text = "some  words,   with \n\n blanks of all\t\tkinds and averyveryverylongoneinbetween  " * 20
    assert np.frombuffer(coder.encode(text), dtype="<u4").tolist() == known.encode_ordinary(text)


def test_memo_may_be_emptied(ranks, known, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    coder = bpe.Codec(ranks, PATTERN)
    text = "alpha beta gammma delltaa epsilonn alpha beta zetaa etaaa"
    assert np.frombuffer(coder.encode(text), dtype="<u4").tolist() == known.encode_ordinary(text)


def test_documents(documents, odd_documents, no_documents, known):
    for docs in (documents, odd_documents):
        got = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.token_report(docs, PATH, PATTERN).collect())
        want = []
        for r in docs.collect():
            ids = known.encode_ordinary(r.text or "")
            packed = np.array(ids, dtype="<u4").tobytes()
            want.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
        assert got == sorted(want)
        encoded = bpe.encode(docs, PATH, PATTERN)
        back = sorted(bytes(r.decoded).decode() for r in bpe.decode(encoded, PATH, PATTERN).collect())
        assert back == sorted(r.text or "" for r in docs.collect())
    assert bpe.token_report(no_documents, PATH, PATTERN).count() == 0
    assert bpe.encode(no_documents, PATH, PATTERN).count() == 0


def test_rows_are_passed_on_a_few_at_a_time(monkeypatch):
    monkeypatch.setattr(bpe, "OUT_BYTES", 10)
    texts = ["four", None, "fourfour", "", "x" * 50, "end"]
    batch = bpe.pa.RecordBatch.from_arrays([bpe.pa.array(range(6)), bpe.pa.array(texts)], ["doc_id", "text"])
    runs = [(ids.to_pylist(), made) for ids, made in bpe.bounded(batch, lambda text: (text or "").encode())]
    assert runs == [([0, 1, 2], [b"four", b"", b"fourfour"]), ([3, 4], [b"", b"x" * 50]), ([5], [b"end"])]
    assert list(bpe.bounded(batch.slice(0, 0), lambda text: b"")) == []


def test_small_runs_give_the_same_rows(spark, known):
    texts = [None, "", "one two  three\n", "übergrößenträger " * 400, *(f"row {i} " * (i % 7) for i in range(300))]
    docs = spark.createDataFrame([*enumerate(texts), (1, "again"), (None, "no id")], "doc_id long, text string").coalesce(1)
    encoded = bpe.encode(docs, PATH, PATTERN)
    want = {(r.doc_id, tuple(known.encode_ordinary(r.text or ""))) for r in docs.collect()}
    rows = encoded.collect()
    assert len(rows) == len(texts) + 2 and {(r.doc_id, tuple(r.ids)) for r in rows} == want
    assert all(r.n_tokens == len(r.ids) for r in rows)
    assert len(bpe.decode(encoded, PATH, PATTERN).collect()) == len(rows)
