"""Stages against brute force, one after another as the pipeline runs them."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from llm_cases import corpus, make, sha  # noqa: F401
from test_dedup import brute_simhash, linked
from tickerlake.llm.vocabulary import piece_model

SF = "/root/testdata/sf0.001"


def _stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def _docs(df):
    return sorted(((r.doc_id, r.text, r.source) for r in df.collect()), key=str)


def _key(d):
    return (d is None, d or 0)


def test_exact_stage(spark, make, corpus):
    df = make(corpus)
    out = _stage("exact dedup")(spark, df, SF)
    assert out.columns == df.columns
    groups = defaultdict(list)
    for row in corpus:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")].append(row)
    got = _docs(out)
    assert len(got) == len(groups)
    for doc_id, text, _ in got:
        rows = groups.pop(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""))
        assert _key(doc_id) == min(_key(r[0]) for r in rows)


def test_near_stage(spark, make, corpus):
    df = make(corpus)
    out = _stage("SimHash near-dedup")(spark, df, SF)
    assert out.columns == df.columns
    roots = linked({brute_simhash(t) for _, t, _ in corpus}, 3)
    groups = defaultdict(list)
    for row in corpus:
        groups[roots[brute_simhash(row[1])]].append(row)
    got = _docs(out)
    assert len(got) == len(groups)
    for doc_id, text, _ in got:
        assert _key(doc_id) == min(_key(r[0]) for r in groups.pop(roots[brute_simhash(text)]))


def test_mix_stage(spark, make, corpus):
    df = make(corpus)
    out = _stage("mixing sources to target weights")(spark, df, SF)
    assert out.columns == df.columns
    mine = Counter(_docs(out))
    given = Counter((d, t, s) for d, t, s in corpus)
    assert set(mine) <= set(given)
    assert all(n <= 2 * given[row] for row, n in mine.items())
    words = lambda rows: sum(len((t or "").split()) * n for (_, t, _), n in rows.items())
    assert words(mine) == pytest.approx(1.5 * words(given), rel=0.35)


CLASHES = ("kept_row", "taken_row", "copies", "score", "id", "row", "of", "k", "label", "Score", "last",
           "doc", "whole", "top1", "component_id", "fp", "n", "leaf", "source_size", "target", "word",
           "rest", "toxic", "uid", "start")


def test_stages_with_clashing_names(spark, corpus):
    """Names that stages and operators use inside may be the input's own columns."""
    from pyspark.sql import functions as F

    names = [c for c in CLASHES if c not in ("Score",)]
    df = spark.createDataFrame(
        [(*row, f"v{k}") for k, row in enumerate(corpus)],
        "doc_id long, text string, source string, v string")
    for name in names:
        df = df.withColumn(name, F.col("v"))
    given = {(r.doc_id, r.text, r.source, r.v) for r in df.collect()}
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, df, SF)
        assert out.columns == df.columns, name
        rows = out.collect()
        assert rows and {(r.doc_id, r.text, r.source, r.v) for r in rows} <= given, name
        assert all(r[c] == r.v for r in rows for c in names), name
    encoded = corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
    assert Counter(r.doc_id for r in encoded) == Counter(row[0] for row in corpus)


def test_stages_on_a_very_long_text(spark, corpus):
    """A text of 400,000 words, beside repeated rows, null text and null id."""
    rows = [(1, " ".join(f"w{k % 9973}" for k in range(400_000)), "a"), (2, None, None),
            (2, None, None), (None, "two words", "b"), *[(k + 10, t, s) for k, (_, t, s) in
                                                        enumerate(corpus[:20])]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, df, SF).collect()
        assert any(r.doc_id == 1 and r.text == rows[0][1] for r in out), name
    encoded = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()}
    assert encoded[1].n_tokens > 400_000


def test_stages_on_nothing(spark, make):
    for name, function in corpus_pipeline.STAGES:
        assert function(spark, make([]), SF).collect() == [], name


def test_run(spark):
    """The whole pipeline on the smallest tables, each stage on what the last one kept."""
    import sentencepiece
    from tickerlake.llm.common import read_table, stage

    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    labels = {r.doc_id: r for r in read_table(spark, SF, "labels").collect()}
    sizes = [docs.count()]
    for k, (name, function) in enumerate(corpus_pipeline.STAGES):
        if name == corpus_pipeline.STAGES[-1][0]:
            mixed = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stage(function(spark, docs, SF), f"test_{k}")
        sizes.append(docs.count())
        if k == 0:
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            clean = [d for d, r in labels.items() if r.toxic == 0]
            assert sum(d in kept for d in clean) >= 0.97 * len(clean)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] and sizes[4] == sizes[5]
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = []
    for doc_id, text in mixed:
        ids = sp.encode(text or "", add_eos=True)
        want.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in docs.collect()]
    assert sorted(got) == sorted(want)
    assert len(corpus_pipeline.run(spark, SF).columns) == 4


def test_registered():
    import __spark_entry__ as E

    names = list(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)
