"""Lines that go, against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from fraudtide.llm import linedup

BLANKS = "\t\n\x0b\x0c\r "


def words(line):
    for b in BLANKS[:-1]:
        line = line.replace(b, " ")
    return frozenset(w for w in line.split(" ") if w)


def expected(rows, over=4, under=5):
    """Text by (id, text); a line goes if an earlier one matches it."""
    seen, done = [], {}
    key = lambda r: (r[0] is not None, r[0] or 0)
    flat = sorted(
        {(r[0], r[1] or "", n, line) for r in rows for n, line in enumerate((r[1] or "").split("\n"))},
        key=lambda x: (*key(x), x[2]),
    )
    for doc_id, text, n, line in flat:
        own = words(line)
        gone = own and any(under * len(own & w) >= over * len(own | w) for w in seen)
        if own:
            seen.append(own)
        done.setdefault((doc_id, text), [])
        if not gone:
            done[doc_id, text].append((n, line))
    return {k: "\n".join(line for _, line in sorted(v)) for k, v in done.items()}


def variants(spark, copies=60):
    """A hot line in many variants, unrelated lines, repeats in other orders, short lines."""
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(400)]
    base = rng.sample(pool, 40)
    rows = []
    for i in range(copies):
        hot = [rng.choice(pool) if rng.random() < 0.06 else w for w in base]
        rng.shuffle(hot)
        own = [" ".join(rng.choice(pool[:40]) for _ in range(rng.randint(1, 8))) for _ in range(3)]
        rows.append((i * 3, "\n".join([*own[:2], " ".join(hot), "", own[2], "the same line everywhere", "same the line everywhere"])))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("few", [2, 1000])
def test_all_pairs(spark, monkeypatch, few):
    monkeypatch.setattr(linedup, "FEW", few)
    docs = variants(spark)
    got = {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in linedup.line_report(docs).collect()}
    for (doc_id, text), left in expected([tuple(r) for r in docs.collect()]).items():
        assert got[doc_id][0] == left
        assert got[doc_id][1] == 7


@pytest.mark.parametrize("few", [2, 1000])
def test_documents(documents, monkeypatch, few):
    monkeypatch.setattr(linedup, "FEW", few)
    docs = documents.where("doc_id < 60")
    got = {r.doc_id: r.text for r in linedup.line_report(docs).collect()}
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert got == {doc_id: text for (doc_id, _), text in want.items()}


def test_odd_documents(odd_documents, no_documents):
    docs = odd_documents.where("doc_id is null or doc_id not in (3, 5, 9, 10)")
    got = {r.doc_id: r.text for r in linedup.line_report(docs.where("doc_id is not null")).collect()}
    assert got == {k[0]: v for k, v in expected([(r.doc_id, r.text) for r in docs.where("doc_id is not null").collect()]).items()}
    assert linedup.line_report(odd_documents).count() == odd_documents.select("doc_id", F.coalesce("text", F.lit(""))).distinct().count()
    assert linedup.line_report(no_documents).count() == 0


def test_stage_keeps_columns_and_drops_emptied_documents(odd_documents, spark):
    kept = linedup.without_repeats(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {0, 1, 2} <= set(ids)  # had no words to begin with
    assert ids.count(5) == 1 and 6 not in ids  # a copy is gone, rows alike are one
    assert kept.where("n_chars <> length(text)").count() == 0


def test_repeated_rows_keep_the_columns_of_one_row(spark):
    rows = [(1, "some words", f"lang{i}", f"src{i}") for i in range(20)]
    kept = [linedup.without_repeats(spark.createDataFrame(rows[i:] + rows[:i], "doc_id long, text string, lang string, source string").repartition(3)).collect() for i in (0, 7)]
    assert kept[0] == kept[1] and len(kept[0]) == 1
    assert kept[0][0].lang[4:] == kept[0][0].source[3:]


def test_repeated_rows_with_blank_lines(spark):
    rows = [(1, "")] * 2 + [(2, "one two\n\n \nthree four")] * 3 + [(3, None), (3, ""), (None, "\n"), (None, "\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text): (r.n_lines, r.n_kept) for r in linedup.line_report(docs).collect()}
    assert got == {(1, ""): (1, 1), (2, "one two\n\n \nthree four"): (4, 4), (3, ""): (1, 1), (None, "\n"): (2, 2)}


def test_plans_of_the_join_stay_short(spark):
    docs = variants(spark, 5)
    levels = linedup.word_levels(docs)
    groups = linedup.classes(linedup.lines(docs))
    plan = linedup.prefixes(groups, levels, linedup.Similar())._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 100_000  # not the levels of all classes, 2 MB of digits


def test_long_lines_do_not_fill_the_parities(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"v{j}" for j in rng.sample(range(300), 150))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = linedup.classes(linedup.lines(docs))
    sets = linedup.prefixes(groups, linedup.word_levels(docs), linedup.Similar())
    one = sets.where(sets["shape"].bitwiseAND((1 << 32) - 1) == 0)
    pairs = one.alias("a").crossJoin(one.alias("b")).where("a.key < b.key")
    assert pairs.count() == 40 * 39 // 2
    assert pairs.where(linedup._may_match("a", "b", linedup.Similar())).count() < 8


def test_lines_of_unlike_sizes(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        line = [f"x{rng.randint(0, 200)}" for _ in range(rng.randint(8, 40))]
        rows.append((2 * i, " ".join(line)))
        more = line + [f"y{rng.randint(0, 9)}" for _ in range(rng.randint(0, 2 + len(line) // 4))]
        rows.append((2 * i + 1, "  ".join(rng.sample(more, len(more))) + "\t\x0b\x0c \r"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in linedup.line_report(docs).collect()}
    want = {k[0]: v for k, v in expected(rows).items()}
    assert got == want
    assert 0 < sum(v == "" for v in want.values()) < 60


def test_lines_without_words_are_not_looked_up_apart(spark):
    docs = spark.createDataFrame([(1, "a b\n\n\t\nc d"), (2, "a b\n "), (3, "\n\n")], "doc_id long, text string")
    kept = linedup.kept_lines(docs, linedup.Similar())
    assert "Generate" not in kept._jdf.queryExecution().executedPlan().toString()
    got = {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in linedup.line_report(docs).collect()}
    assert got == {1: ("a b\n\n\t\nc d", 4, 4), 2: (" ", 2, 1), 3: ("\n\n", 3, 3)}


def test_words_are_sorted_as_numbers_rarest_first(spark):
    docs = spark.createDataFrame([(i, f"often seldom{i // 2} once{i}") for i in range(64)], "doc_id long, text string")
    levels = linedup.word_levels(docs)
    words = docs.select(linedup._ordered(linedup._hashes(docs["text"]), levels).alias("words"))
    assert not words.schema["words"].dataType.containsNull  # else they are sorted as objects
    got = words.select(F.transform("words", lambda w: F.shiftright(w, linedup.HASH_BITS)).alias("at")).collect()
    assert all(r.at == [0, 3, 18] for r in got)
