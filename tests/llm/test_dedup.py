import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tickerlake.llm import exact_dedup as exact
from tickerlake.llm import simhash, substring_dedup, winnowing
from tickerlake.llm.components import components

from llm_cases import corpus, make, sha  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@given(st.text(alphabet=" \t\n\r\x0b\x0cab  ", max_size=40))
def test_normalise(text):
    assert exact.normalise(text.encode()).decode() == re.sub(r"[\x20\x09-\x0D]+", " ", text)


@given(st.lists(st.binary(max_size=6), max_size=200), st.integers(0, 3))
def test_table_compares_content(contents, bits):
    table, known = exact.ContentTable(slots=2), {}
    for c in contents:  # few hash bits: nearly all collide
        hashed = xxhash.xxh64_intdigest(c) & ((1 << bits) - 1)
        entry = table.find(c, hashed)
        if c in known:
            assert entry == known[c]
        else:
            assert entry < 0
            known[c] = table.add(c, hashed, entry)


@pytest.mark.parametrize("tight", [False, True])
def test_exact_dedup(make, corpus, tight):
    small = dict(table_bytes=3000, bucket_bytes=1 << 30, combine_rows=7, most_buckets=3)
    got = exact.exact_dedup(make(corpus), **(small if tight else {})).collect()
    groups = defaultdict(list)
    for doc_id, text, _ in corpus:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    want = sorted((
        (str(d), str(min((x for x in ids if x is not None), default=None)), len(ids), sha(text))
        for text, ids in groups.items() for d in ids))
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups)
    assert all(r.id == r.keep_id for r in kept)


def test_exact_dedup_empty(make):
    assert exact.exact_dedup(make([])).collect() == []


def brute_simhash(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORDS.findall(low)
    if not words:
        return 0
    grams = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, most):
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    order = sorted(fps)
    for k, a in enumerate(order):
        for b in order[k + 1:]:
            if (a ^ b).bit_count() <= most:
                up[root(a)] = root(b)
    return {f: root(f) for f in fps}


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_simhash_dedup(make, corpus, bucket):
    fps = [brute_simhash(t) for _, t, _ in corpus]
    roots = linked(set(fps), 3)
    low = {}
    for (doc_id, _, _), f in zip(corpus, fps):
        if doc_id is not None:
            low[roots[f]] = min(low.get(roots[f], doc_id), doc_id)
    want = sorted((str(d), format(f, "016x"), str(low.get(roots[f]))) for (d, _, _), f in zip(corpus, fps))
    got = simhash.simhash_dedup(make(corpus), bucket=bucket).collect()
    assert sorted((str(r.id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_simhash_dedup_empty(make):
    assert simhash.simhash_dedup(make([])).collect() == []


@pytest.mark.parametrize("most,bucket", [(3, 10_000), (3, 20), (1, 10), (0, 10), (5, 30)])
def test_hamming_links_brute(spark, most, bucket):
    """Dense clusters and noise: same components as all pairs."""
    rng = np.random.default_rng(most)
    centres = [int(x) for x in rng.integers(0, 1 << 63, 4)]
    fps = {int(x) for x in rng.integers(0, 1 << 63, 60)} | {0, (1 << 64) - 1, 1, 3 << 62}
    for c in centres:
        for _ in range(60):
            flips = rng.choice(64, size=rng.integers(0, 5), replace=False)
            fps.add(c ^ sum(1 << int(b) for b in flips))
    nodes = spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long")
    links = simhash.hamming_links(nodes, most_bits=most, bucket=bucket)
    got = {r.node % (1 << 64): r.label for r in components(links).collect()}
    roots = linked(fps, most)
    mine, brute = defaultdict(set), defaultdict(set)
    for f in fps:
        mine[got.get(f, ("alone", f))].add(f)
        brute[roots[f]].add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, brute.values()))


@given(st.integers(0, (1 << 64) - 1), st.sets(st.integers(0, 63), max_size=3))
def test_pigeonring_never_misses(fp, flips):
    other = fp ^ sum(1 << b for b in flips)
    assert any(
        (fp & mask) == (other & mask)
        and all(((fp ^ other) & m).bit_count() <= q for m, q in simhash.quotas(3, start))
        for start, mask in simhash.index_masks(3))


def test_components_long_chain(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100 + k, 100) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100 + k: 100 for k in range(30)}


def brute_substring(rows, least):
    first = {}
    big = float("inf")
    split = [(big if d is None else d, d, WORDS.findall(t or "")) for d, t, _ in rows]
    for own, _, words in split:
        for k in range(len(words) - least + 1):
            key = tuple(words[k:k + least])
            first[key] = min(first.get(key, big), own)
    out = []
    for own, d, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - least + 1):
            if first[tuple(words[k:k + least])] < own:
                gone[k:k + least] = [True] * least
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((str(d), len(words), sum(gone), sha(kept)))
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"sent": 4, "held": 3}, {"held": 0}])
def test_substring_dedup(make, corpus, limits):
    got = substring_dedup.substring_dedup(make(corpus), **limits).collect()
    assert sorted((str(r.id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == \
        brute_substring(corpus, 50)
    assert sum(r.n_removed for r in got) > 500


def test_substring_factors(make):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(55))
    rows = [(1, a), (2, f"x {a} y"), (3, f"{a} {b}"), (4, f"{b} z {a}")]
    got = {r.id: r for r in substring_dedup.substring_dedup(make(rows), with_text=True).collect()}
    assert got[2].factors == [[1, 60, 1]] and got[2].kept == "x y"
    assert got[3].factors == [[0, 60, 1]] and got[3].kept == b
    assert got[4].factors == [[0, 55, 3], [56, 60, 1]] and got[4].kept == "z"
    assert substring_dedup.substring_dedup(make([])).collect() == []


@settings(deadline=None)
@given(st.text(alphabet="abc 日", max_size=120), st.integers(1, 5), st.integers(1, 9))
def test_winnow_brute(text, k, window):
    hashes, places = winnowing.winnow(text, k, window)
    if not text:
        assert len(places) == 0
        return
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    k = min(k, len(text))
    grams = [int(winnowing.gram_hashes(codes[i:i + k], k)[0]) for i in range(len(text) - k + 1)]
    window = min(window, max(1, len(grams) // winnowing.PART))
    want = set()
    for i in range(len(grams) - window + 1):
        low = min(grams[i:i + window])
        want.add(max(j for j in range(i, i + window) if grams[j] == low))
    assert places.tolist() == sorted(want)
    assert hashes.tolist() == [grams[j] for j in sorted(want)]


def test_winnow_blocks_and_guarantee(monkeypatch):
    text = "".join(chr(97 + (k * k) % 23) for k in range(3000))
    whole = winnowing.winnow(text)
    monkeypatch.setattr(winnowing, "BLOCK", 100)
    cut = winnowing.winnow(text)
    assert whole[0].tolist() == cut[0].tolist() and whole[1].tolist() == cut[1].tolist()
    shared = "exactly this passage of the text is shared by both"[:winnowing.GRAM + winnowing.WINDOW - 1]
    one, two = "q" * 400 + shared + "w" * 400, "e" * 333 + shared + "r" * 512
    assert set(winnowing.winnow(one)[0].tolist()) & set(winnowing.winnow(two)[0].tolist())


def test_fingerprint_documents(make, corpus):
    rows = [(d, t) for d, t, _ in corpus]
    got = winnowing.fingerprint_documents(make(rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for k, (d, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        want.append((str(d), len(t), sha(t[:len(t) - half] + after[:half])))
    assert sorted((str(r.id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)
    by_text = defaultdict(set)
    fps = defaultdict(list)
    for r in got:
        fps[r.id].append(r.fingerprint)
    for d, t in rows:
        by_text[t or ""].update(fps[d] if len(fps[d]) == 1 else ())
    assert all(len(v) <= 1 for v in by_text.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = winnowing.fingerprint_documents(make([(9, "alone in the world")])).collect()
    assert one[0].near_next == 1.0
    assert winnowing.fingerprint_documents(make([])).collect() == []
