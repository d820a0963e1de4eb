"""Periodic runs, importance resampling and the Jaccard join against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerlake.llm import importance, jaccard_rtree, periodic_runs
from tickerlake.llm.queries import QUERIES, repeated_tail

from llm_cases import SF, corpus, make, sha  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -- periodic runs -----------------------------------------------------------
def plain_runs(words, least=12):
    """Every maximal stretch of every period; of equal stretches the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def described(words, runs):
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return (
        len(words), len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=60), st.integers(1, 14), st.integers(4, 20))
def test_fragments_stitch_to_runs(words, least, stride):
    ids = periodic_runs.word_ids([w.encode() for w in words])
    held = defaultdict(list)
    for q, s, e in periodic_runs.fragments(ids, least, stride):
        held[q].append((s, e))
    runs = []
    for q, parts in held.items():
        whole = []
        for s, e in sorted(parts):
            if whole and s <= whole[-1][1] - q:
                whole[-1][1] = max(whole[-1][1], e)
            else:
                whole.append([s, e])
        runs += [(s, e - s, q) for s, e in whole]
    assert sorted(runs) == plain_runs(words, least)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_z_function(s):
    want = [0] * len(s)
    for i in range(1, len(s)):
        while i + want[i] < len(s) and s[want[i]] == s[i + want[i]]:
            want[i] += 1
    assert periodic_runs.z_function(s) == want


@pytest.fixture(scope="module")
def repeating(corpus):
    rnd = random.Random(3)
    rows = list(corpus)
    for k in range(30):
        unit = " ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 50)))
        rows.append((1000 + k, f"x y {unit} " * rnd.randint(2, 9) + "z", "s"))
    rows += [(1100, "w " * 5000, "s"), (1101, ("u v " * 40 + "k ") * 60, "s"), (1100, "w " * 13, "s")]
    return rows


@pytest.mark.parametrize("tight", [False, True])
def test_periodic_runs(make, repeating, tight):
    small = dict(stride=16, spread=100) if tight else {}
    got = periodic_runs.periodic_runs(make(repeating), with_text=True, **small).collect()
    want = []
    for i, text, _ in repeating:
        words = WORDS.findall(text or "")
        want.append((str(i), *described(words, plain_runs(words))))
    assert Counter((str(r[0]), *r[1:9]) for r in got) == Counter(want)
    assert all(sha(r.collapsed) == r.collapsed_sha256 for r in got)
    assert all(len(r.runs) == r.n_runs for r in got)


def test_periodic_runs_empty(make):
    assert periodic_runs.periodic_runs(make([])).collect() == []


def test_op11(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    edited = 0
    for r in rows:
        words = WORDS.findall(r.text or "")
        if len(words) > 2500:  # the plain version is cubic on these
            continue
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and words:
            edited += 1
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + math.floor((n - a) / (3 + g % 8))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert [w.decode() for w in repeated_tail(
            (r.text or "").encode().split(), r.doc_id)] == words
        assert tuple(got[r.doc_id][1:9]) == described(words, plain_runs(words)), r.doc_id
    assert edited > 5


# -- importance resampling ---------------------------------------------------
def plain_draw(rows, target, share=(10, 100), least=20, grams=(1, 1), buckets=10_000, seed=2024):
    def feats(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return len(words), [
            zlib.crc32(" ".join(words[k:k + n]).encode()) % buckets
            for n in range(grams[0], grams[1] + 1) for k in range(len(words) - n + 1)]

    own = [(i, *feats(text)) for i, text, *_ in rows]
    s, t = Counter(b for _, _, f in own for b in f), Counter(b for x in target for b in feats(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets))))
            for b in s}
    out = []
    for i, n, f in own:
        weight, score = sum(gain[b] for b in f), None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n, len(f), weight, score])
    able = sorted((-r[4], r[0]) for r in out if r[1] >= least and r[4] is not None)
    drawn = able[:share[0] * len(able) // share[1]]
    ranks = defaultdict(list)
    for k, key in enumerate(drawn):
        ranks[key].append(k + 1)
    final = Counter()
    for i, n, m, weight, score in out:
        held = ranks.get((-score, i), []) if score is not None and n >= least else []
        final[i, m, weight, score, held.pop(0) if held else None] += 1
    return final


@pytest.mark.parametrize("case", [
    {}, {"share": (60, 100), "least_words": 1, "segment_rows": 7}, {"grams": (1, 3), "buckets": 64}])
def test_resample(spark, make, corpus, case):
    target = [corpus[0][1], corpus[7][1], None, "", "Ünï la la"]
    of = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(make(corpus), of, **case).collect()
    plain = {"least": case.get("least_words", 20)} | {
        k: v for k, v in case.items() if k in ("share", "grams", "buckets")}
    assert Counter(tuple(r) for r in got) == plain_draw(corpus, target, **plain)


def test_resample_empty(spark, make, corpus):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(make([]), none).collect() == []
    got = importance.resample(make(corpus), none).collect()
    assert Counter(tuple(r) for r in got) == plain_draw(corpus, [])


def test_ranks_of_ties(spark):
    rnd = random.Random(5)
    rows = [(k, rnd.randint(0, 40), rnd.randint(-3, 3)) for k in range(3000)]
    df = spark.createDataFrame(rows, "row long, id long, score long").repartition(5)
    got = {r.row: r.rank for r in importance.ranks(df, 100).collect()}
    order = sorted(rows, key=lambda r: (-r[2], r[1], r[0]))
    assert got == {r[0]: k + 1 for k, r in enumerate(order)}


def test_op12(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = QUERIES["op12_importance"](spark, SF).collect()
    assert Counter(tuple(r) for r in got) == plain_draw(docs, target)


# -- Jaccard join ------------------------------------------------------------
def plain_sets(text, words=4):
    found = WORDS.findall(lower(text))
    if not found:
        return frozenset()
    k = min(words, len(found))
    return frozenset(" ".join(found[i:i + k]) for i in range(len(found) - k + 1))


def plain_components(sets, num=85, den=100):
    """Smallest position reachable, by all pairs."""
    up = list(range(len(sets)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and den * both >= num * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [root(k) for k in range(len(sets))]


def plain_join(rows, words=4, num=85, den=100):
    sets = [plain_sets(r[1], words) for r in rows]
    roots = plain_components(sets, num, den)
    low = {}
    for r, k in zip(rows, roots):
        if r[0] is not None:
            low[k] = min(low.get(k, r[0]), r[0])
    return Counter((r[0], len(s), r[0] if not s else low.get(k))
                   for r, s, k in zip(rows, sets, roots))


@pytest.fixture(scope="module")
def near(corpus):
    """Besides the corpus: families whose members lose or change some words each, so
    that similarities lie on both sides of the threshold, and chains of them."""
    rnd = random.Random(11)
    rows = list(corpus)
    for family in range(6):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([9, 20, 60, 150]))]
        for k in range(25):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                own[rnd.randrange(len(own))] = f"V{rnd.randint(0, 9)}"
            rows.append((2000 + 100 * family + k, " ".join(own), "s"))
        for k in range(20):  # a chain
            own = base[k * len(base) // 30:] + [f"t{j}" for j in range(k * len(base) // 30)]
            rows.append((4000 + 100 * family + k, " ".join(own), "s"))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("case", [
    {}, {"most_sets": 4, "most_shingles": 500}, {"most_sets": 4, "most_points": 6}, {"num": 1, "den": 2}, {"num": 60, "den": 100, "words": 2,
                                                                    "most_sets": 9, "groups": 8}])
def test_jaccard_join(make, near, case):
    got = jaccard_rtree.jaccard_join(make(near), **case).collect()
    plain = {k: v for k, v in case.items() if k in ("words", "num", "den")}
    assert Counter(tuple(r) for r in got) == plain_join(near, **plain)


def test_jaccard_join_empty(make):
    assert jaccard_rtree.jaccard_join(make([])).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=18), min_size=2, max_size=150),
       st.sampled_from([(85, 100), (1, 2), (3, 4)]), st.data())
def test_tree(sets, ratio, data):
    """The tree's links connect what all pairs connect; a linked pair shares a key."""
    rnd = np.random.default_rng(0).integers(0, 1 << 64, 26, dtype=np.uint64)
    held = [np.sort(rnd[list(s)]) for s in sets]
    found = jaccard_rtree.Links(held, list(range(len(held))), *ratio, 4).find()
    up = list(range(len(sets)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in found:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    assert [root(k) for k in range(len(sets))] == plain_components(sets, *ratio)
    keys = [set(jaccard_rtree.segment_keys(h, *ratio).tolist()) for h in held]
    for i, a in enumerate(sets):
        for j in range(i):
            if a != sets[j] and ratio[1] * len(a & sets[j]) >= ratio[0] * len(a | sets[j]):
                assert keys[i] & keys[j]
    # only those that ask look for links: with those of the rest they connect all
    asks = np.array(data.draw(st.lists(st.booleans(), min_size=len(sets), max_size=len(sets))))
    some = jaccard_rtree.Links(held, list(range(len(held))), *ratio, 4).find(asks)
    rest = [k for k in range(len(sets)) if not asks[k]]
    more = jaccard_rtree.Links([held[k] for k in rest], rest, *ratio, 4).find() if rest else []
    up[:] = range(len(sets))
    for a, b in [*some, *((rest[a], rest[b]) for a, b in more)]:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    assert [root(k) for k in range(len(sets))] == plain_components(sets, *ratio)


def test_op13(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op13_jaccard_join"](spark, SF).collect()
    assert Counter(tuple(r) for r in got) == plain_join(docs)
