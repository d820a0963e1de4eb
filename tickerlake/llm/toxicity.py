"""Toxicity by class-conditional Kneser-Ney models.

Two character models, of the labelled toxic documents and of the other labelled
documents, give every word a log-likelihood: its characters between two word
marks, each after at most ``ORDER - 1`` characters of the same word.  The
highest order has counts of its own class (documents that have the word); all
lower orders are Kneser-Ney continuation counts over both classes together, so
an expression that is rare in both backs off to the same probabilities.  A
document's score is the difference of its toxic and ordinary log-likelihoods,
summed over all its words, per character; a few toxic words are little in a long
text, so its most toxic word and the mean of its three most toxic words (per
character of the word) stand beside it.  A logistic curve over the three, fitted
on documents that gave no counts, makes them a probability.

In the difference the shared part cancels wherever an n-gram is unseen, so a
model is two tables: the difference of every seen n-gram and that of every
context's backoff weight.  Counts, continuation counts and probabilities are
joins and aggregates over all labelled documents.  Tables below a checked size
are broadcast whole.  Larger ones stay tables: scoring gathers the distinct words
of the texts, joins their n-grams with the tables once, and brings the words'
scores back to the texts, those of the words in most texts by a broadcast of
bounded size, those of all other words by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nlargest
from math import nan, sumprod

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, smallest, stage, values

ORDER = 6
DISCOUNT = 0.75
#: Most n-grams that are broadcast (16 bytes each, as many contexts); more are joined.
BROADCAST_GRAMS = 2_000_000
#: Most words whose scores are broadcast (16 bytes each); others are joined.
BROADCAST_WORDS = 2_000_000
#: Characters of distinct words that one group of the n-gram lookup has.
GROUP_CHARS = 400_000
#: Most documents of the calibration fold that the curve is fitted on (lowest
#: hashes); only these give no counts.
CALIBRATION_ROWS = 20_000
#: Words and n-grams a worker holds before it hands counts on, or forgets.
HELD = 200_000
#: Most labels that are broadcast to the documents (about 32 MB); more are joined
#: by a shuffle.
BROADCAST_LABELS = 2_000_000
#: Texts scored together, which shares the work on words not seen before.
TOGETHER = 500
#: Marks that are not part of a word.
_MARKS = ".,;:!?\"()"
FOLDS = 5
HELD_OUT_FOLD, CALIBRATION_FOLD = 0, 4
_FIRST, _LAST = "\x02", "\x03"


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; a null id counts as empty text."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)).cast("int")


def words(text: str | None) -> list[str]:
    text = (text or "").lower()
    for mark in _MARKS:
        if mark in text:
            text = text.replace(mark, " ")
    return text.split()


def ngrams(word: str) -> list[str]:
    """The n-gram that ends at each character of a marked word."""
    marked = _FIRST + word + _LAST
    return [marked[max(0, k - ORDER):k] for k in range(2, len(marked) + 1)]


_COUNTS = pa.schema([("gram", pa.string()), ("n0", pa.int64()), ("n1", pa.int64())])


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task side: n-gram counts by class over (text, toxic) rows, combined in
    tables of bounded size."""

    def flush(by_word: dict[str, list[int]]) -> Iterator[tuple]:
        grams: dict[str, list[int]] = {}
        for word, (n0, n1) in by_word.items():
            for gram in ngrams(word):
                n = grams.setdefault(gram, [0, 0])
                n[0] += n0
                n[1] += n1
            if len(grams) >= HELD:
                yield from ((g, *n) for g, n in grams.items())
                grams = {}
        yield from ((g, *n) for g, n in grams.items())

    def rows() -> Iterator[tuple]:
        by_word: dict[str, list[int]] = {}
        for batch in parts:
            for text, toxic in zip(values(batch, "text"), values(batch, "toxic")):
                for word in set(words(text)):
                    by_word.setdefault(word, [0, 0])[toxic] += 1
                if len(by_word) >= HELD:
                    yield from flush(by_word)
                    by_word = {}
        yield from flush(by_word)

    yield from batches(rows(), _COUNTS)


def _prefix(c: str = "gram") -> Column:
    return F.expr(f"substring({c}, 1, char_length({c}) - 1)")


def _suffix(c: str = "gram") -> Column:
    return F.expr(f"substring({c}, 2)")


def _shared_backoff(top: DataFrame) -> DataFrame:
    """``back, p``: Kneser-Ney probability of the last character of every n-gram
    of a lower order, from continuation counts over both classes."""
    level = top.select("gram")
    tables = []
    for _ in range(ORDER - 1):
        level = stage(
            level.filter("char_length(gram) > 1").select(_suffix().alias("gram"))
            .groupBy("gram").agg(F.count("gram").alias("n")), "kn_level")
        tables.append(level)
        level = level.select("gram")
    # an n-gram of any length has its continuation counts of all levels
    counts = tables[0]
    for t in tables[1:]:
        counts = counts.unionByName(t)
    counts = stage(counts.groupBy("gram").agg(F.sum("n").alias("n"))
                   .withColumn("size", F.char_length("gram")), "kn_counts")
    contexts = counts.groupBy(_prefix().alias("ctx")).agg(
        F.sum("n").alias("all"), F.count("n").alias("kinds"))
    own = stage(
        counts.join(contexts, _prefix() == F.col("ctx")).select(
            "gram", "size", (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("all")).alias("own"),
            (DISCOUNT * F.col("kinds") / F.col("all")).alias("rest")), "kn_own")
    characters = own.filter("size = 1").count()
    done = own.filter("size = 1").select(
        "gram", (F.col("own") + F.col("rest") / max(1, characters)).alias("p"))
    every = [done]
    for size in range(2, ORDER):
        shorter = done.select(F.col("gram").alias("back"), F.col("p").alias("q"))
        done = stage(
            own.filter(F.col("size") == size)
            .join(shorter, _suffix() == F.col("back"))
            .select("gram", (F.col("own") + F.col("rest") * F.col("q")).alias("p")), "kn_p")
        every.append(done)
    out = every[0]
    for t in every[1:]:
        out = out.unionByName(t)
    return out.select(F.col("gram").alias("back"), "p")


def _find(table: tuple, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is in a table of hashes, in order, and values, and its value."""
    hashes, vals = table
    wanted = np.fromiter((xxhash.xxh64_intdigest(k.encode(), 42) for k in keys),
                         dtype=np.uint64, count=len(keys)).view(np.int64)
    if not len(hashes):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return hashes[at] == wanted, vals[at]


def _hashed(table: DataFrame, key: str, value: str) -> tuple:
    """All rows of a table as hashes, in order, and values."""
    got = table.select(F.xxhash64(key).alias("h"), F.col(value).alias("v")).toArrow()
    h = got.column("h").to_numpy()
    order = np.argsort(h)
    return h[order], got.column("v").to_numpy()[order]


@dataclass
class Tables:
    """Broadcast part of a model below the checked size: all n-grams and contexts."""

    grams: tuple
    contexts: tuple

    def find(self, some: list[str]) -> list[float]:
        """The rate of each word."""
        out = []
        for k in range(0, len(some), 10_000):
            parts = [ngrams(w) for w in some[k:k + 10_000]]
            grams = [g for p in parts for g in p]
            seen, value = _find(self.grams, grams)
            back, other = _find(self.contexts, [g[:-1] for g in grams])
            gains = np.where(seen, value, np.where(back, other, 0.0))
            sizes = np.array([len(p) for p in parts])
            out += (np.add.reduceat(gains, np.cumsum(sizes) - sizes) / sizes).tolist()
        return out


@dataclass
class Model:
    """Differences of all seen n-grams (``gram, v``) and of all contexts (``ctx, v``)
    as staged tables, the same for broadcast where they are few, and the curve."""

    grams: DataFrame
    contexts: DataFrame
    tables: Tables | None
    weights: list[float]


def _distinct(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task side: distinct words of texts and the number of texts that have each,
    combined in tables of bounded size."""

    def rows() -> Iterator[tuple]:
        held: dict[str, int] = {}
        for batch in parts:
            for text in values(batch, "text"):
                for word in set(words(text)):
                    held[word] = held.get(word, 0) + 1
                if len(held) >= HELD:
                    yield from held.items()
                    held = {}
        yield from held.items()

    yield from batches(rows(), pa.schema([("word", pa.string()), ("n", pa.int64())]))


def _own_grams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task side: the n-grams of words, each once for a group of words and a batch."""

    def rows() -> Iterator[tuple]:
        for batch in parts:
            held = set()
            for part, word in zip(values(batch, "part"), values(batch, "word")):
                held.update((part, gram) for gram in ngrams(word))
                if len(held) >= HELD:
                    yield from held
                    held = set()
            yield from held

    yield from batches(rows(), pa.schema([("part", pa.int64()), ("gram", pa.string())]))


def _rates(own: pa.Table, gains: pa.Table) -> pa.Table:
    """Difference per character of each word of a group, from the group's n-grams."""
    gain = dict(zip(gains.column("gram").to_pylist(), gains.column("v").to_pylist()))
    parts = map(ngrams, own.column("word").to_pylist())
    rates = [sum(map(gain.__getitem__, p)) / len(p) for p in parts]
    return pa.table({"word": own.column("word"), "n": own.column("n"), "rate": pa.array(rates, pa.float64())})


def word_rates(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``word, n, rate``: every distinct word of the texts, the number of texts that
    have it, and its toxic less ordinary log-likelihood per character.

    Words are dealt in groups, and an n-gram is looked up once for each group, so
    an n-gram of many words is no large key of the joins.
    """
    own = stage(
        df.select(df[text_col].cast("string").alias("text")).mapInArrow(_distinct, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")), "kn_words")
    chars = own.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    own = own.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(1 + chars // GROUP_CHARS)))
    wanted = own.mapInArrow(_own_grams, "part long, gram string").distinct()
    gains = (
        wanted.join(model.grams.withColumnsRenamed({"gram": "seen", "v": "value"}),
                    F.col("gram") == F.col("seen"), "left")
        .join(model.contexts.withColumnRenamed("v", "other"), _prefix() == F.col("ctx"), "left")
        .select("part", "gram", F.coalesce("value", "other", F.lit(0.0)).alias("v"))
    )
    return stage(
        own.groupBy("part").cogroup(gains.groupBy("part"))
        .applyInArrow(_rates, "word string, n long, rate double"), "kn_rates")


@dataclass
class Known:
    """Broadcast part: hashes, in order, and rates of the words in most texts."""

    rates: tuple

    def find(self, some: list[str]) -> list[float]:
        """The rate of each word, NaN where it isn't here."""
        known, rate = _find(self.rates, some)
        return np.where(known, rate, nan).tolist()


def _known(rates: DataFrame, most: int) -> tuple[Known, DataFrame | None]:
    """The words to broadcast, at most ``most``, and the table of all others if any.

    The first are all words in at least some power of two of texts, so a word
    left to the join is in fewer texts than those.
    """
    power = F.floor(F.log2("n")).cast("int")
    sizes = sorted(rates.groupBy(power.alias("p")).count().collect(), reverse=True)
    least, taken = 64, 0
    for p, n in sizes:
        taken += n
        if taken > most:
            break
        least = p
    rest = rates.filter(power < least) if taken > most else None
    return Known(_hashed(rates.filter(power >= least), "word", "rate")), rest


class Scorer:
    """A worker's use of the words: remembers the rates of a bounded number of them."""

    def __init__(self, known: Known | Tables):
        self.known, self.young, self.old = known, {}, {}

    def rates(self, texts: list[list[str]]) -> Iterator[list[float]]:
        """The rate of each word of each text, NaN where it wasn't broadcast."""
        found: dict[str, float] = {}
        missing = {w for own in texts for w in own if w not in self.young}
        if missing:
            found = {w: g for w in missing if (g := self.old.get(w)) is not None}
            new = [w for w in missing if w not in found]
            found.update(zip(new, self.known.find(new)))
        for own in texts:
            got = list(map(self.young.get, own))
            if None in got:
                got = [found[w] if g is None else g for w, g in zip(own, got)]
            yield got
        if found:
            if len(self.young) >= 2 * HELD:
                self.old, self.young = self.young, {}
            self.young.update((w, g) for w, g in found.items() if len(w) <= 48)


def _text_features(own: list[str], rates: list[float]) -> tuple[float, float, float]:
    """Difference per character of the whole text, most toxic word and mean of the
    three most toxic (0 where there are fewer)."""
    if not own:
        return 0.0, 0.0, 0.0
    sizes = list(map(len, own))  # and one for the mark at a word's end
    whole = (sumprod(rates, sizes) + sum(rates)) / (sum(sizes) + len(own))
    high = nlargest(3, rates)
    return whole, max(high[0], 0.0), sum(max(x, 0.0) for x in high) / 3


def _curve(x: np.ndarray, y: np.ndarray) -> list[float]:
    """Logistic regression by Newton steps, lightly regularised."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        size = np.abs(step).max()
        w += step * min(1.0, 5.0 / size) if size else 0.0
        if size < 1e-6:
            break
    return w.tolist()


def train(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", calibration_rows: int = CALIBRATION_ROWS,
    broadcast_grams: int = BROADCAST_GRAMS,
) -> Model:
    """Fit on the labelled rows of ``df`` outside the held-out fold.

    ``labels`` has ``id_col`` and ``label_col`` (0 or 1); rows with a null in
    either are not used, and an id labelled more than once counts as toxic if
    one of its labels is.  Without labels of both kinds the model's score is the
    share of toxic labels for every text (0 without any).
    """
    marks = (
        labels.select(labels[id_col].cast("long").alias("of"), labels[label_col].cast("int").alias("toxic"))
        .filter("of is not null and toxic in (0, 1)")
        .groupBy("of").agg(F.max("toxic").alias("toxic"))
        .filter(fold(F.col("of")) != HELD_OUT_FOLD)
    )
    marks = stage(marks, "kn_labels")
    few = marks.count() <= BROADCAST_LABELS
    rows = df.select(df[id_col].cast("long").alias("id"), df[text_col].cast("string").alias("text"))
    sample = stage(  # a bounded number of ids, so their texts are found by a broadcast
        marks.filter(fold(F.col("of")) == CALIBRATION_FOLD)
        .transform(lambda d: smallest(d, F.xxhash64("of"), ["of"], calibration_rows)),
        "kn_held_back")
    counted = marks.join(F.broadcast(sample.select("of")), "of", "left_anti")
    top = stage(
        rows.filter(fold(F.col("id")) != HELD_OUT_FOLD)
        .join(F.broadcast(counted) if few else counted, F.col("id") == F.col("of"))
        .select("text", "toxic")
        .mapInArrow(_count, "gram string, n0 long, n1 long")
        .groupBy("gram").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "kn_top")
    contexts = stage(
        top.groupBy(_prefix().alias("ctx")).agg(
            *[F.sum(f"n{c}").alias(f"all{c}") for c in (0, 1)],
            *[F.count_if(F.col(f"n{c}") > 0).alias(f"kinds{c}") for c in (0, 1)]), "kn_contexts")

    def rest(c: int) -> Column:  # weight of the shared backoff; all of it in an unseen context
        return F.when(F.col(f"all{c}") > 0, DISCOUNT * F.col(f"kinds{c}") / F.col(f"all{c}")
                      ).otherwise(F.lit(1.0))

    def own(c: int) -> Column:
        return F.when(F.col(f"all{c}") > 0, F.greatest(F.col(f"n{c}") - DISCOUNT, F.lit(0.0))
                      / F.col(f"all{c}")).otherwise(F.lit(0.0))

    ratio = F.log((own(1) + rest(1) * F.col("p")) / (own(0) + rest(0) * F.col("p")))
    seen = (
        top.join(contexts, _prefix() == F.col("ctx"))
        .join(_shared_backoff(top), _suffix() == F.col("back"))
        .select("gram", ratio.alias("v"))
    )
    backed = contexts.select("ctx", F.log(rest(1) / rest(0)).alias("v"))
    model = Model(stage(seen, "kn_gains"), stage(backed, "kn_backed"), None, [])
    if max(model.grams.count(), model.contexts.count()) <= broadcast_grams:
        model.tables = Tables(_hashed(model.grams, "gram", "v"), _hashed(model.contexts, "ctx", "v"))
    found = stage(
        rows.join(F.broadcast(sample), F.col("id") == F.col("of")).select("text", "toxic"), "kn_sample")
    got = _features(found, model).select("toxic", "whole", "top1", "top3").toArrow()
    y = got.column("toxic").to_numpy().astype(float)
    if len(y) and 0 < y.mean() < 1:
        model.weights = _curve(
            np.column_stack([got.column(c).to_numpy() for c in ("whole", "top1", "top3")]), y)
    else:  # nothing to fit on: the share of toxic labels
        n, toxic = marks.agg(F.count("toxic"), F.sum("toxic")).first()
        share = toxic / n if n else 0.0
        odds = 30.0 if share >= 1 else -30.0 if share <= 0 else float(np.log(share / (1 - share)))
        model.weights = [odds, 0.0, 0.0, 0.0]
    return model


_SCORERS: dict[str, Scorer] = {}


def _scorer(key: str, shared) -> Scorer:
    """The worker's scorer for broadcast words; one set at a time is kept."""
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = Scorer(shared.value)
    return _SCORERS[key]


_KEY, _REST = "__toxicity_text_digest", "__toxicity_joined_words"


def _appended(
    df: DataFrame, model: Model, add, ddl: str, fields: list[pa.Field], text: str,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """``df`` with columns computed from a text column, all others passed on as they are.

    Words that aren't broadcast are joined with their rates for each distinct text
    that has them, and the rates are handed to the text as a list.
    """
    if model.tables is not None:
        known, rest = model.tables, None
    else:
        known, rest = _known(word_rates(df, model, text), broadcast_words)
    shared = df.sparkSession.sparkContext.broadcast(known)
    key = str(id(shared)) + str(shared._jbroadcast.id())
    columns, joined = df.columns, rest is not None

    def left(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            scorer = _scorer(key, shared)
            for whole in parts:
                for k in range(0, whole.num_rows, TOGETHER):
                    batch = whole.slice(k, TOGETHER)
                    own = [words(t) for t in values(batch, "text")]
                    for digest, some, got in zip(values(batch, _KEY), own, scorer.rates(own)):
                        for word in {w for w, g in zip(some, got) if g != g}:
                            yield digest, word

        yield from batches(rows(), pa.schema([(_KEY, pa.string()), ("word", pa.string())]))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, shared)
        for whole in parts:
            for k in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(k, TOGETHER)
                own = [words(t) for t in values(batch, text)]
                got = list(scorer.rates(own))
                if joined:
                    for j, pairs in enumerate(values(batch, _REST)):
                        if pairs:
                            more = {p["word"]: p["rate"] for p in pairs}
                            got[j] = [more[w] if g != g else g for w, g in zip(own[j], got[j])]
                    batch = batch.select(columns)
                new = [pa.array(c, f.type) for c, f in zip(zip(*map(add, own, got)), fields)]
                yield pa.RecordBatch.from_arrays(
                    batch.columns + new, schema=pa.schema(list(batch.schema) + fields))

    old = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
    if joined:
        digest = F.sha2(F.coalesce(df[text].cast("string"), F.lit("")).cast("binary"), 256)
        lists = (
            df.select(digest.alias(_KEY), df[text].cast("string").alias("text"))
            .mapInArrow(left, f"{_KEY} string, word string").distinct()
            .join(rest.select("word", "rate"), "word")
            .groupBy(_KEY).agg(F.collect_list(F.struct("word", "rate")).alias(_REST))
        )
        df = df.withColumn(_KEY, digest).join(lists, _KEY, "left").drop(_KEY)
    return df.mapInArrow(run, f"{old}, {ddl}")


def _features(df: DataFrame, model: Model) -> DataFrame:
    return _appended(
        df, model, _text_features, "whole double, top1 double, top3 double",
        [pa.field(c, pa.float64()) for c in ("whole", "top1", "top3")], "text")


def score(
    df: DataFrame, model: Model, text_col: str = "text", out_col: str = "score",
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """``df`` with ``out_col``: the probability that the text is toxic (0 to 1).

    The score depends on the text alone.  Null and empty texts score like a
    text without any toxic word; a very long text is one row like any other.
    Every input row gives one row, repeated ones too.  A column of the name
    ``out_col``, in whatever case, is replaced; it can't be the text.  Where the
    model's tables are joined, the texts are read for their words at once.
    """
    if out_col.lower() == text_col.lower():
        raise ValueError("the score can't replace the text")
    df = df.select(*[df[f"`{c.replace('`', '``')}`"] for c in df.columns
                     if c.lower() != out_col.lower()])
    w0, *rest = model.weights

    def add(own: list[str], rates: list[float]) -> tuple[float]:
        z = min(max(w0 + sumprod(rest, _text_features(own, rates)), -30.0), 30.0)
        return (float(1 / (1 + np.exp(-z))),)

    return _appended(df, model, add, f"{out_col} double", [pa.field(out_col, pa.float64())], text_col,
                     broadcast_words)
