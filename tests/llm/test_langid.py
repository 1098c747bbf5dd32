"""Phrases against a search in the sample itself, and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from fraudtide.llm import langid


def phrases_by_search(text, sample):
    """Longest matches by looking for them in the sample."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample and text[at:end] in sample:
            end += 1
        count, at = count + 1, end
    return count


def test_phrases_are_longest_matches(monkeypatch):
    rng = random.Random(5)
    samples = {k: ["".join(rng.choice(letters) for _ in range(300))] for k, letters in (("x", "aab "), ("y", "abc "), ("z", "cd"))}
    model = langid.Languages(samples, langid.Sample())
    codes = langid.letter_codes(model.alphabet)
    texts = ["".join(rng.choice("abcdq") for _ in range(rng.randint(0, 50))) for _ in range(400)]
    values = [langid.encoded(t, codes) for t in texts]
    own = {k: bytes(sum(([*langid.encoded(t, codes).tolist(), 0] for t in s), [])) for k, s in samples.items()}
    want = [[phrases_by_search(v.tobytes(), own[k]) for k in model.names] for v in values]
    assert model.phrases(values).tolist() == want
    monkeypatch.setattr(langid, "LANES", 4)
    assert model.phrases(values).tolist() == want
    monkeypatch.setattr(langid, "GROUP_CHARS", 100)
    assert model.phrases(values).tolist() == want


def test_held_out_accuracy(documents):
    rows = {r.doc_id: r for r in langid.language_report(documents).collect()}
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    held = [i for i, r in rows.items() if r.held_out]
    assert np.mean([rows[i].lang_pred == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_labels_are_no_input_of_a_prediction(spark, documents):
    model = langid.learn(documents)
    plain = sorted(langid.identify(documents, model).collect())
    other = documents.selectExpr("doc_id", "text", "'xx' lang", "'yy' source")
    assert plain == sorted(langid.identify(other, model).collect())


def test_odd_documents(odd_documents, no_documents):
    rows = langid.language_report(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    none = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {0, 1, 2} <= none and all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert langid.language_report(no_documents).count() == 0
    assert langid.in_a_language(no_documents).count() == 0


def test_stage_rejects_what_has_no_language_only(spark, documents):
    rng = random.Random(1)
    noise = "".join(rng.choice("qxzwkvjy") for _ in range(400))
    extra = spark.createDataFrame([(-1, None), (-2, "123 456"), (-3, noise)], "doc_id long, text string")
    docs = documents.unionByName(extra, allowMissingColumns=True)
    kept = langid.in_a_language(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in documents.collect()}


def test_hardly_any_sample_wins_nothing(spark, documents):
    rows = [r for r in documents.collect() if r.lang]
    samples = {}
    for r in rows:
        samples.setdefault(r.lang, []).append(r.text[:600])
    plain = langid.Languages({k: v[:30] for k, v in samples.items()}, langid.Sample())
    texts = [r.text[:600] for r in rows]
    noise = "".join(random.Random(1).choice("qxzwkvjy") for _ in range(400))
    codes = langid.letter_codes(plain.alphabet)
    want = plain.predict(texts, codes)[0]
    for tiny in (["ok "], [""], [], [" 1 "], ["e t a o n"], ["the quick brown fox jumps over the lazy dog"]):
        model = langid.Languages({**{k: v[:30] for k, v in samples.items()}, "aa": tiny}, langid.Sample())
        assert model.predict(texts, langid.letter_codes(model.alphabet))[0] == want
        assert model.predict([noise], langid.letter_codes(model.alphabet))[2][0] > langid.Rejects().bits


def test_training_rows_that_are_rare_blank_or_without_ids(spark, documents):
    few = documents.where("doc_id < 150").select("doc_id", "text", "lang")
    extra = [(-2, "ok", "aa"), (-4, " \n", "bb"), (-5, "12 34", "bb"), (-6, "", "cc")]
    extra += [(None, f"zq{i} vwxk zzqp hjkq {i}", "dd") for i in range(2000)]
    extra += [(None, "the same row", "ee")] * 3000 + [(None, f"kukri bolang {i} sirap", "ee") for i in range(5)]
    docs = few.unionByName(spark.createDataFrame(extra, few.schema))
    model = langid.learn(docs)
    assert "aa" in model.names and not {"bb", "cc"} & set(model.names)
    codes = langid.letter_codes(model.alphabet)
    told = model.predict(["vwxk zzqp hjkq", "kukri bolang sirap"], codes)[0]
    assert told == ["dd", "ee"]
    plain = langid.learn(few)
    texts = [r.text for r in few.collect()]
    assert model.predict(texts, codes)[0] == plain.predict(texts, langid.letter_codes(plain.alphabet))[0]


def test_tables_of_many_languages_are_bounded():
    assert langid.place_type(8_521_000, 252) is np.int32 and langid.place_type(8_522_000, 252) is np.int64
    samples = {f"l{i}": ["some words of a language " * 20] for i in range(3)}
    wide = langid.Languages(samples, langid.Sample())
    assert wide.table.dtype == np.int32
    with pytest.raises(ValueError, match="bytes"):
        langid.Languages(samples, langid.Sample(size=wide.table.nbytes // 2))


def test_places_of_64_bits_say_the_same(documents, monkeypatch):
    texts = [r.text for r in documents.limit(40).collect()]
    known = {"x": texts[:3], "y": texts[3:6]}
    narrow = langid.Languages(known, langid.Sample())
    monkeypatch.setattr(langid, "place_type", lambda states, width: np.int64)
    wide = langid.Languages(known, langid.Sample())
    codes = langid.letter_codes(wide.alphabet)
    assert wide.table.dtype == np.int64 and narrow.predict(texts, codes) == wide.predict(texts, codes)
