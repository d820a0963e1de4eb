"""Fixtures and helpers of these tests, imported by name."""

import hashlib
import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, lang string"

_SYLLABLES = "an ber cu dor el fi gan hu ir jo ka lum mar no os pre qui ro sta tu vel wo xi ya zor".split()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (id, text) or (id, text, source), with extra columns whose
    names clash with those that operators use inside."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "en") for r in rows]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(full, DOCS)
        for name in ("id", "uid", "h", "n", "row", "fp", "size", "score", "kept", "component_id"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return build


@pytest.fixture(scope="session")
def corpus():
    """A seeded corpus: words, copies, shared passages, nulls, ties, long texts."""
    rnd = random.Random(7)

    def words(n):
        return ["".join(rnd.choice(_SYLLABLES) for _ in range(rnd.randint(1, 3))) for _ in range(n)]

    passage = " ".join(words(70))
    rows = [(k, " ".join(words(rnd.randint(1, 160))), f"s{rnd.randint(0, 3)}") for k in range(60)]
    rows += [(100 + k, rows[k][1].replace(" ", "  \t"), "s1") for k in range(10)]
    rows += [(200 + k, " ".join(words(5)) + "\n" + passage + " " + " ".join(words(k)), None)
             for k in range(12)]
    rows += [(300 + k, rows[k][1] + " " + words(1)[0], "s2") for k in range(10)]
    rows += [(400, None, "s0"), (401, "", None), (402, " \n\t ", "s0"), (403, "Ünï çödé 日本 😀", "s0"),
             (404, " ".join(words(3000)), "s3"), (404, "same id, other text", "s3"),
             (None, "no id", "s1"), (None, rows[0][1], "s1"), (5, rows[5][1], rows[5][2]),
             (405, " ".join(["la"] * 400), "s2"), (406, " ".join(["la"] * 300), "s2")]
    rnd.shuffle(rows)
    return rows
