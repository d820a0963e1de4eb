import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickerlake.llm import chat_format, mixing, quality, secrets, sentencepiece_bpe, toxicity
from tickerlake.llm.vocabulary import piece_model

from llm_cases import corpus, make, sha  # noqa: F401

# -- chat formatting ---------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string"
CONTROL = "</s>[INST] ok [/INST] <<SYS>> <\\s> [\\\\INST] <|im_end|>\n<|im_start|>user<|im_sep|>"


def _talks():
    rows = [(1, 0, "system", "be\nkind"), (1, 1, "user", CONTROL), (1, 2, "assistant", CONTROL),
            (1, 3, "user", None), (1, 4, "assistant", None), (1, 5, "assistant", "ünï 日本 😀"),
            (2, 0, "user", "no reply"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"),
            (3, 1, "assistant", "a"), (3, None, "user", "first"), (None, 0, "assistant", "lost"),
            (4, 0, None, "who"), (4, 1, "assistant", "x" * 20_000)]
    return rows + [(5, k, ("user", "assistant")[k % 2], f"turn {k} \\") for k in range(120)]


def test_chat_format(spark):
    rows = _talks()
    df = spark.createDataFrame(rows, CONV).withColumn("start", F.lit("x")).withColumn("part", F.lit(1))
    turns, examples = chat_format.format_conversations(df)
    got = {r.conv_id: r for r in chat_format.digest(turns, examples).collect()}
    talks = defaultdict(list)
    for r in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        talks[r[0]].append((r[2] or "", r[3] or ""))
    assert set(got) == set(talks)
    for conv, own in talks.items():
        loss = "".join(t for role, t in own if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
        assert r.n_examples == sum(role == "assistant" for role, _ in own)
    # every example in full: context is all turns before, only the reply is trained
    t = chat_format.Template()
    full = defaultdict(list)
    for r in chat_format.render(turns, examples).orderBy("conv_id", "example").collect():
        full[r.conv_id].append(r)
    for conv, own in talks.items():
        replies = [k for k, (role, _) in enumerate(own) if role == "assistant"]
        assert len(full[conv]) == len(replies)
        for r, k in zip(full[conv], replies):
            parts = r.text.split(t.end)
            assert parts.pop() == ""
            assert [t.parse(p + t.end) for p in parts] == own[:k + 1]
            assert t.unescape(r.text[r.loss_start:r.loss_end]) == own[k][1]
            assert r.text[r.loss_end:] == t.end


def test_chat_format_empty(spark):
    turns, examples = chat_format.format_conversations(spark.createDataFrame([], CONV))
    assert turns.count() == examples.count() == chat_format.digest(turns, examples).count() == 0


def test_escape_round_trip(spark):
    t = chat_format.Template()
    alphabet = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>", "|im_end|>", "a", "\n"]
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in texts], "t string").select("t", t.escape(F.col("t")).alias("e"))
    for r in df.collect():
        assert t.unescape(r.e) == r.t
        assert not any(c in r.e for c in t.controls)


# -- sentencepiece -----------------------------------------------------------

CODER = sentencepiece_bpe.encoder(piece_model())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from(list(" \n\t▁.,!?'\"()<>/saeithn$%&0123é日")), st.characters(codec="utf-8")), max_size=60))
def test_encode_is_the_library(text):
    ids, said = CODER.encode(text)
    assert ids == CODER.sp.encode(text, add_eos=True)
    assert said == " ".join(map(str, ids))


@pytest.mark.parametrize("text", [" " * 300, "a" * 700, "the " * 500, "\n \n" * 50, "日本" * 200,
                                  "Donaudampfschifffahrt" * 40, "  x  y", "<s></s><unk><0x0A>"])
def test_encode_long(text):
    assert CODER.encode(text)[0] == CODER.sp.encode(text, add_eos=True)


def test_encode_small_memory(monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "KEPT_CHUNKS", 4)
    monkeypatch.setattr(sentencepiece_bpe, "KEPT_PAIRS", 2)
    own = sentencepiece_bpe.Encoder(piece_model())
    text = "many different words, again many different words"
    assert own.encode(text)[0] == own.sp.encode(text, add_eos=True)


def test_encode_decode(make, corpus):
    got = sentencepiece_bpe.encode_decode(make(corpus), piece_model(), with_ids=True).collect()
    sp = CODER.sp
    want = []
    for d, t, _ in corpus:
        ids = sp.encode(t or "", add_eos=True)
        want.append((str(d), len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))))
    assert sorted((str(r.id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert sentencepiece_bpe.encode_decode(make([]), piece_model()).collect() == []


# -- mixing ------------------------------------------------------------------

def _targets(sizes, weights, share, ceiling):
    """Round by round, as the contract says it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        above = {s for s in free if unit * weight[s] >= ceiling * sizes[s]}
        if not above:
            target |= {s: unit * weight[s] for s in free}
            break
        target |= {s: ceiling * sizes[s] for s in above}
        left -= sum(ceiling * sizes[s] for s in above)
        free -= above
    return target


@pytest.mark.parametrize("leaf", [mixing.ROWS_PER_LEAF, 3])
def test_mix(make, corpus, leaf):
    df = make(corpus)
    got = mixing.mix(df, rows_per_leaf=leaf, fan_in=2).collect()
    again = mixing.mix(df.repartition(5), rows_per_leaf=leaf, fan_in=2).collect()
    key = lambda r: (str(r.id), r.size, str(r.source), r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes = defaultdict(int)
    for _, t, s in corpus:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert len(got) == len(corpus)
    target = _targets(sizes, mixing.WEIGHTS, mixing.SHARE, mixing.CEILING)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        most = max(r.size for r in got if r.source == s)
        assert abs(taken[s] - target[s]) <= most


def test_exchange_keeps_mass_and_expectation():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (("a", int(rng.integers(1, 50)), rng.uniform(0.01, 0.99)),
                ("b", int(rng.integers(1, 50)), rng.uniform(0.01, 0.99)))
        mean = {"a": 0.0, "b": 0.0}
        up, down = min(a[1] * (1 - a[2]), b[1] * b[2]), min(a[1] * a[2], b[1] * (1 - b[2]))
        for draw, p in ((0.0, down / (up + down)), (1 - 1e-12, up / (up + down))):
            done, left = mixing.exchange(a, b, draw)
            x = dict(done) | ({left[0]: left[2]} if left else {})
            assert done and x["a"] * a[1] + x["b"] * b[1] == pytest.approx(a[1] * a[2] + b[1] * b[2])
            for k in x:
                mean[k] += p * x[k]
        assert mean["a"] == pytest.approx(a[2]) and mean["b"] == pytest.approx(b[2])


def test_mix_edges(make):
    assert mixing.mix(make([])).collect() == []
    got = mixing.mix(make([(1, None, None), (2, " ", "a")])).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 2


# -- secrets -----------------------------------------------------------------

def _brute_secrets(text):
    kinds = [
        ("assign", r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    spans = [(m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(kinds)
             for m in re.finditer(p, text) if ok(m)]
    return sorted(spans)


def test_secrets(make):
    h = "0123456789abcdef"
    texts = [
        None, "", "plain text", "password = 'hunter2hunter2'", "PassWord:short token=secret:abcdefghij",
        "api_key: ABCDEFGH api-key=nothing1 APIKEY='x.y=z/w+1_2-3'", "passwordpasswd=\"12345678\"",
        f"é日 {h}{h} {h}{h}{h}x AKIA{'A' * 12} AKIA{'B' * 11} xAKIAAKIA{'C9' * 9}",
        f"token:{h * 3}", "secret=" * 3 + "abcdefgh", "token  =  " + "q" * 50_000,
        " ".join(f"token={k:08d}" for k in range(2000)), "😀" * 100 + f"AKIA{'Z' * 16}",
        "-----BEGIN RSA PRIVATE KEY-----", "TOKEN:\n12345678", "toKen= \"12345678\"",
    ]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[3]), (3, texts[3]), (3, "secret:zzzzzzzzz")]
    got = secrets.report(secrets.find_secrets(make(rows))).collect()
    want = []
    for d, t in rows:
        spans = _brute_secrets(t or "")
        said = ",".join(f"{n}:{a}:{z}" for a, _, n, z in spans)
        more = ",private_key:0:31" if "BEGIN" in (t or "") else ""
        count = [sum(s[1] == k for s in spans) for k in range(3)]
        want.append((str(d), *count, sha(said), (said + more).strip(",")))
    assert sorted((str(r.id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in got) \
        == sorted(want)
    assert secrets.find_secrets(make([])).collect() == []


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]{32,}") is None
    assert secrets.trigram_query("abcd") == [frozenset({"abc", "bcd"})]
    assert secrets.trigram_query("(?:abc|x)") is None
    assert secrets.trigram_query("abc(?:de)?") == [frozenset({"abc"})]
    # single characters as alternatives are a class to the parser, and end a run
    assert secrets.trigram_query("abc(?:d|e)fg") == [frozenset({"abc"})]
    assert set(secrets.trigram_query("abc(?:dd|e.)fg")) == {
        frozenset({"abc", "bce"}), frozenset({"abc", "bcd", "cdd", "ddf", "dfg"})}
    assert secrets.trigram_query("AB[xy]CDE+") == [frozenset({"cde"})]


@settings(max_examples=100)
@given(st.data())
def test_trigram_query_is_necessary(data):
    """Whatever matches a rule has the trigrams of one clause."""
    for rule in secrets.BASE + secrets.MORE:
        text = data.draw(st.from_regex(re.compile(rule.pattern, re.ASCII), fullmatch=True))
        query = secrets.trigram_query(rule.pattern)
        low = text.lower()
        assert query is None or any(all(t in low for t in clause) for clause in query)


# -- toxicity and quality ----------------------------------------------------

def _marked(make, spark, n=400):
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(list("aeioulnrst"), rng.integers(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for k in range(n):
        words = list(rng.choice(plain, rng.integers(5, 80)))
        bad = k % 4 == 0
        if bad:
            for _ in range(3):
                words.insert(int(rng.integers(0, len(words))), "grumpf" + str(rng.choice(["", "el", "ix"])))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(bad)))
    labels += [(0, 1, 1), (None, 1, 1), (1, None, None), (10 ** 9, 0, 1)]
    return make(rows + [(n, None), (n + 1, ""), (None, rows[0][1]), (2, rows[2][1])]), \
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_toxicity(make, spark):
    docs, labels, truth = _marked(make, spark)
    model = toxicity.train(docs, labels)
    out = toxicity.score(docs, model, out_col="toxicity")
    assert out.columns == docs.columns + ["toxicity"]
    got = out.withColumn("fold", toxicity.fold(F.col("doc_id"))).collect()
    known = {d: t for d, _, t in truth if d is not None and t is not None}
    held = [(r.toxicity >= 0.5, known[r.doc_id]) for r in got if r.fold == 0 and r.doc_id in known]
    assert len(held) > 50 and np.mean([a == bool(b) for a, b in held]) > 0.97
    by = {r.doc_id: r.toxicity for r in got}
    assert by[400] == by[401] < 0.5
    assert all(0 <= r.toxicity <= 1 for r in got)
    # the score is a function of the text
    assert by[None] == by[0]


def test_toxicity_without_labels(make, spark):
    docs = make([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, none)
    assert all(r.score < 1e-6 for r in toxicity.score(docs.drop("score"), model).collect())
    empty = toxicity.train(make([]), none)
    assert toxicity.score(make([]).drop("score"), empty).collect() == []


def test_toxicity_model_has_every_ngram(make, spark):
    """No n-gram or context is lost to another, and every word has all of its own."""
    rng = np.random.default_rng(8)
    rows = [(k, " ".join("".join(rng.choice(list("abcdefghijklmnop"), 9)) for _ in range(40)))
            for k in range(100)]
    labels = spark.createDataFrame([(k, k % 3 == 0) for k, _ in rows], "doc_id long, toxic boolean")
    model = toxicity.train(make(rows), labels.withColumn("toxic", F.col("toxic").cast("int")))
    folds = {r.k: r.f for r in spark.range(100).select(
        F.col("id").alias("k"), toxicity.fold(F.col("id")).alias("f")).collect()}
    seen = {g for k, text in rows if folds[k] not in (0, 4) for w in text.split() for g in toxicity.ngrams(w)}
    gain = {r.gram: r.v for r in model.grams.collect()}
    back = {r.ctx: r.v for r in model.contexts.collect()}
    assert len(seen) > 10_000 and set(gain) == seen and set(back) == {g[:-1] for g in seen}
    got = {r.word: r.rate for r in toxicity.word_rates(make(rows), model).collect()}
    assert set(got) == {w for _, text in rows for w in text.split()}
    for word, rate in got.items():
        own = [gain.get(g, back.get(g[:-1], 0.0)) for g in toxicity.ngrams(word)]
        assert rate == pytest.approx(sum(own) / len(own))


def test_toxicity_scores_the_whole_text(make, spark):
    """Every word counts by its characters, and an ordinary one lowers the score."""
    docs, labels, _ = _marked(make, spark)
    model = toxicity.train(docs, labels)
    plain = docs.filter("doc_id = 1").first().text
    texts = [plain, "grumpf grumpfel grumpfix", "grumpf grumpfel grumpfix " + " ".join([plain] * 20)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rates = {r.word: r.rate for r in toxicity.word_rates(rows, model).collect()}
    whole = {r.doc_id: r.whole for r in toxicity._features(rows, model).collect()}
    for k, text in enumerate(texts):
        own = text.split()
        want = sum(rates[w] * (len(w) + 1) for w in own) / sum(len(w) + 1 for w in own)
        assert whole[k] == pytest.approx(want)
    assert whole[1] > whole[2] > whole[0]


def test_toxicity_counts_all_but_the_calibration_rows(make, spark):
    """Of the calibration fold only the sampled documents give no counts."""
    rows = [(k, f"word{k} again") for k in range(100)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int")
    folds = {r.id: r.f for r in spark.range(100).select("id", toxicity.fold(F.col("id")).alias("f")).collect()}
    rest = [k for k, f in folds.items() if f == toxicity.CALIBRATION_FOLD]
    model = toxicity.train(make(rows), labels, calibration_rows=3)
    grams = {r.gram for r in model.grams.collect()}
    counted = {k for k in folds if any(g.endswith(f"d{k}\x03") for g in grams)}
    assert len(rest) > 5 and len(counted & set(rest)) == len(rest) - 3
    assert counted - set(rest) == {k for k, f in folds.items() if f not in (0, toxicity.CALIBRATION_FOLD)}


def test_toxicity_joined_words_score_as_broadcast_ones(make, spark):
    docs, labels, _ = _marked(make, spark, 120)
    model = toxicity.train(docs, labels, broadcast_grams=0)
    assert model.tables is None

    def scores(model, **limit):
        out = toxicity.score(docs, model, out_col="toxicity", **limit)
        assert out.columns == docs.columns + ["toxicity"]
        return sorted((r.text or "", str(r.doc_id), r.toxicity) for r in out.collect())

    joined = scores(model, broadcast_words=0)
    assert scores(model) == joined == scores(model, broadcast_words=50)
    whole = toxicity.train(docs, labels)
    assert whole.tables is not None
    for a, b in zip(scores(whole), joined, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-6)


def test_backoff_probabilities_sum_to_one(spark):
    """The shared lower orders are distributions over the characters seen."""
    words = "abba baba abc cab bac aab".split()
    grams = defaultdict(int)
    for w in words:
        for g in toxicity.ngrams(w):
            grams[g] += 1
    top = spark.createDataFrame([(g, n, 0) for g, n in grams.items()], "gram string, n0 long, n1 long")
    p = {r.back: r.p for r in toxicity._shared_backoff(top).collect()}
    letters = [g for g in p if len(g) == 1]
    assert sum(p[c] for c in letters) == pytest.approx(1)

    def prob(ctx, c):
        return p.get(ctx + c, None)

    for ctx in {g[:-1] for g in p if len(g) == 2}:
        seen = [c for c in letters if ctx + c in p]
        # the seen continuations have more than their discounted share, at most all
        assert 0.2 < sum(prob(ctx, c) for c in seen) <= 1 + 1e-9


def test_quality_recovers_junk(make):
    rng = np.random.default_rng(3)
    plain = ["".join(rng.choice(list("aeioulnrst"), rng.integers(2, 8))) for _ in range(500)]
    rows, junk = [], set()
    for k in range(400):
        words = [w.capitalize() if i % 9 == 0 else w for i, w in enumerate(rng.choice(plain, 60))]
        if k % 8 == 0:
            junk.add(k)
            words = [[w.upper() + "!!" for w in words], [w + "$$$" for w in words],
                     [x for w in words for x in (w, "|")], [w for w in words[:9] for _ in range(9)]
                     ][k // 8 % 4]
        rows.append((k, " ".join(words) + "."))
    rows += [(None, rows[1][1]), (1000, None), (1001, "short one."), (1, rows[1][1])]
    got = {r.id: r for r in quality.classify(make(rows)).collect()}
    assert sum(got[k].keep == (k not in junk) for k in range(400)) >= 396
    assert got[None].score == got[1].score and got[1001].keep
    assert quality.classify(make([])).collect() == []


def test_fit_labellers_known_rates():
    """Good texts with false alarms, and a kind of junk for every heuristic."""
    rng = np.random.default_rng(1)
    alarm = np.array([0.02, 0.01, 0.005, 0.015])
    kind = rng.choice(5, 20_000, p=[0.8, 0.05, 0.05, 0.05, 0.05])
    rate = np.where(kind[:, None] == 0, alarm, 0.3)
    rate[kind > 0, kind[kind > 0] - 1] = 0.97
    votes = np.where(rng.random(rate.shape) < rate, quality.JUNK, quality.GOOD)
    patterns, where, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    good, says = quality.fit_labellers(patterns, n.astype(float))
    assert says[0, :, 1] == pytest.approx(alarm, abs=0.02)
    assert np.mean((good[where.ravel()] >= 0.5) == (kind == 0)) > 0.95


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_quality_any_text(text):
    own = text.split()
    table = quality.Words().table(own)
    seen = quality.measures(text, own, table)
    assert seen["words"] == len(own) and len(quality.votes(seen)) == len(quality.LABELLERS)
    slots, vals = quality.vector(own, table)
    assert len(slots) == len(vals) and (slots < quality.DIM).all() and np.isfinite(vals).all()


def test_quality_fits_all_rounds():
    assert quality.ROUNDS == 60


def test_quality_shape_reads_the_whole_word():
    head = "a1-" * 20
    assert quality.shape(head + "b") != quality.shape(head + "?")


def test_smallest(spark):
    """The rows with the smallest hashes, through a bounded number of rows."""
    from pyspark.sql import functions as F

    from tickerlake.llm.common import smallest

    df = spark.range(20_000).withColumn("h", F.xxhash64("id"))
    got = [r.id for r in smallest(df, F.col("h"), ["id"], 300).collect()]
    assert got == [r.id for r in df.orderBy("h", "id").limit(300).collect()]
    assert smallest(df, F.col("h"), ["id"], 50_000).count() == 20_000
    same = spark.range(3000).withColumn("h", F.lit(5))  # all tie
    assert [r.id for r in smallest(same, F.xxhash64("h"), ["id"], 10).collect()] == list(range(10))
    assert smallest(df.limit(0), F.col("h"), ["id"], 5).collect() == []


def test_score_replaces_a_column(spark, make, corpus):
    """A frame may have a column of the score's name, in whatever case."""
    from pyspark.sql import functions as F

    from tickerlake.llm import toxicity
    from tickerlake.llm.common import read_table

    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    model = toxicity.train(docs, read_table(spark, "/root/testdata/sf0.001", "labels"))
    df = make(corpus).drop("score").withColumn("Score", F.lit("x"))
    out = toxicity.score(df, model)
    assert [c for c in out.columns if c.lower() == "score"] == ["score"]
    plain = toxicity.score(df.select("doc_id", "text"), model)
    assert sorted(r.score for r in out.collect()) == sorted(r.score for r in plain.collect())
    with pytest.raises(ValueError):
        toxicity.score(df, model, out_col="TEXT")
