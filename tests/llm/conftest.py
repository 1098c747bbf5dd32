from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use themselves; they must not mind.
CLASHING = ("spans", "size", "place", "bucket", "key", "version", "component", "digest", "row", "part", "blob", "line")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing extra columns."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    long = "\n".join(" ".join(rng.choice(words) for _ in range(12)) for _ in range(900))
    prose = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(6)]
    texts = [None, "", " \n\t\r\n ", "one", "one two", prose[0], prose[0], prose[1], prose[1] + " more", long, long + " end", "🙂 ünï\x00 ﬁ 漢字"]
    rows = [(i, t, "en" if i % 3 else None, None if i % 4 == 0 else f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(5, texts[5], "en", "s1", 1), (5, texts[5], "en", "s1", 1), (3, "another three", "en", "s1", 1)]
    rows += [(None, "no id at all", "en", "s0", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit(-7) for name in CLASHING})


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
