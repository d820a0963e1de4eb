"""Quality classifier from weak labels.

Ten heuristics look at every whole text; each says junk, good, or nothing.
They overlap and none is right alone.  Expectation-maximisation estimates, for
good texts and for kinds of junk, how often each heuristic gives each answer,
from the numbers of texts with each pattern of answers (an aggregate of at most
``3 ** len(LABELLERS)`` rows, so it is small for any corpus and covers all of
it).  The posterior of a text's pattern is its label, and a linear scorer over
hashed word shapes and pairs of shapes learns these labels, so it also ranks
texts on which no heuristic speaks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, id_text, smallest, stage, values

ABSTAIN, GOOD, JUNK = 0, 1, 2
DIM = 1 << 16
#: Most rows that the linear scorer is fitted on (lowest hashes of the id).
FIT_ROWS = 20_000
FIT_TASKS = 8
ROUNDS = 60
#: Words whose shape a worker remembers.
HELD = 200_000
BLOCK = 50

_DOUBLED = re.compile(r"([^\w\s])\1")


def shape(word: str) -> str:
    """Letters as a or A, digits as 0, marks as they are; runs as one or two."""
    kinds = ["0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in word]
    return "".join(c for k, c in enumerate(kinds) if kinds[max(0, k - 2):k] != [c, c])


#: What is known of a word: slot of its shape, letters, capitals, marks, whether a
#: mark is doubled, whether it is marks only, characters.
SLOT, LETTERS, UPPER, MARKS, DOUBLED, BARE, LENGTH = range(7)


def look(word: str) -> tuple[int, ...]:
    letters = sum(map(str.isalpha, word))
    alnum = sum(map(str.isalnum, word))
    return (xxhash.xxh32_intdigest(shape(word).encode()) % DIM, letters,
            sum(map(str.isupper, word)), len(word) - alnum, bool(_DOUBLED.search(word)),
            not alnum, len(word))


class Words:
    """A worker's looks of a bounded number of words, and texts seen through them."""

    def __init__(self):
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _missed(self, word: str) -> tuple:
        got = self.old.get(word) or look(word)
        if len(word) <= 48:
            if len(self.young) >= HELD:
                self.old, self.young = self.young, {}
            self.young[word] = got
        return got

    def table(self, own: list[str]) -> np.ndarray:
        """A row for each word."""
        got = list(map(self.young.get, own))
        if None in got:
            got = [g or self._missed(w) for w, g in zip(own, got)]
        return np.array(got, dtype=np.int64).reshape(-1, LENGTH + 1)


def measures(text: str, own: list[str], table: np.ndarray) -> dict[str, float | None]:
    """What the heuristics look at; None where a text is too short to tell."""
    n = len(own)
    total = table.sum(axis=0)
    letters, solid = int(total[LETTERS]), max(1, int(total[LENGTH]))
    lines = [x for x in text.split("\n") if x]
    blocks = [own[k:k + BLOCK] for k in range(0, n, BLOCK)]
    full = [b for b in blocks if len(b) >= 10]
    return {
        "upper": total[UPPER] / letters if letters >= 20 else None,
        "doubled": total[DOUBLED] / n if n >= 5 else None,
        "bare": total[BARE] / n if n >= 5 else None,
        "repeat": sum(map(eq, own, own[1:])) / n if n >= 5 else None,
        "marks": total[MARKS] / solid if n >= 5 else None,
        "variety": sum(len(set(b)) / len(b) for b in full) / len(full) if full else None,
        "letters": letters / solid if n >= 5 else None,
        "same_lines": 1 - len(set(lines)) / len(lines) if len(lines) >= 4 else None,
        "word_length": solid / n if n >= 5 else None,
        "words": float(n),
    }


#: name: (good from, good to, junk below, junk above); between them no answer.
LABELLERS: dict[str, tuple[float, float, float, float]] = {
    "upper": (0.0, 0.15, -1.0, 0.3),
    "doubled": (0.0, 0.03, -1.0, 0.1),
    "bare": (0.0, 0.05, -1.0, 0.15),
    "repeat": (0.0, 0.05, -1.0, 0.15),
    "marks": (0.0, 0.06, -1.0, 0.1),
    "variety": (0.75, 1.0, 0.65, 2.0),
    "letters": (0.93, 1.0, 0.88, 2.0),
    "same_lines": (0.0, 0.2, -1.0, 0.5),
    "word_length": (3.0, 9.0, 1.5, 25.0),
    "words": (50.0, float("inf"), 1.0, float("inf")),
}


def votes(seen: dict[str, float | None]) -> list[int]:
    """The answer of every heuristic to its measure."""
    out = []
    for name, (low, high, below, above) in LABELLERS.items():
        v = seen[name]
        out.append(ABSTAIN if v is None else JUNK if v < below or v > above
                   else GOOD if low <= v <= high else ABSTAIN)
    return out


def fit_labellers(patterns: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple:
    """EM over answer patterns and their counts.

    Gives each pattern's probability of being good, and the table of answer
    probabilities (class, labeller, good or junk).  Class 0 is good text; junk
    has one class for each heuristic, begun with the texts that it calls junk,
    because one kind of junk escapes the heuristics for another and they would
    outvote its own.  A heuristic that abstains tells nothing, so a text on
    which all do has the prior.
    """
    junk = (patterns == JUNK).astype(float)
    said = junk.sum(axis=1, keepdims=True)
    if not n.sum():
        return np.ones(len(patterns)), np.zeros((junk.shape[1] + 1, junk.shape[1], 2))
    # start: heuristics are mostly right, and a junk answer weighs more than a good one
    good = 1 / (1 + np.exp(2.0 * said[:, 0] - 0.5 * (patterns == GOOD).sum(axis=1)))
    kinds = np.where(said > 0, junk / np.maximum(1, said), 1 / junk.shape[1])
    post = np.concatenate([good[:, None], (1 - good)[:, None] * kinds], axis=1)
    answers = np.eye(3)[patterns][:, :, [GOOD, JUNK]]
    for _ in range(rounds):
        weight = (post * n[:, None]).T
        says = np.einsum("cp,pla->cla", weight, answers) + 0.5
        says /= says.sum(axis=2, keepdims=True)
        prior = (weight.sum(axis=1) + 0.5) / (weight.sum() + 0.5 * len(weight))
        logs = np.log(prior) + np.einsum("pla,cla->pc", answers, np.log(says))
        new = np.exp(logs - logs.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        moved = np.abs(new - post).max()
        post = new
        if moved < 1e-9:
            break
    return post[:, 0], says


def vector(own: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values (of length one) of a text's shapes and pairs of shapes;
    slots 0 and 1 are a constant and the share of repeated words."""
    one = table[:, SLOT]
    two = (one[:-1] * 0x9E3779B1 + one[1:] * 31 + 7) % DIM
    slots, counts = np.unique(np.concatenate([one, two]), return_counts=True)
    same = sum(map(eq, own, own[1:])) / max(1, len(own))
    values_ = counts / max(1.0, float(np.sqrt((counts ** 2.0).sum())))
    return np.concatenate([[0, 1], slots]), np.concatenate([[0.3, same], values_])


_WORDS = Words()  # one per worker process

_VOTED = pa.schema([("id", pa.int64()), ("pattern", pa.int64()), ("key", pa.int64()),
                    ("slots", pa.list_(pa.int32())), ("vals", pa.list_(pa.float32()))])


def pattern_code(answers: list[int]) -> int:
    return sum(a * 3 ** k for k, a in enumerate(answers))


def pattern_answers(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // 3 ** k % 3 for k in range(len(LABELLERS))], axis=1).astype(int)


def _voted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in parts:
            for doc_id, text in zip(values(batch, "id"), values(batch, "text")):
                own = text.split()
                table = _WORDS.table(own)
                slots, vals = vector(own, table)
                key = xxhash.xxh64_intdigest(f"{doc_id}".encode()) >> 1
                code = pattern_code(votes(measures(text, own, table)))
                yield doc_id, code, key, slots.tolist(), vals.tolist()

    yield from batches(rows(), _VOTED)


def _margins(batch: pa.RecordBatch, weights: np.ndarray) -> tuple:
    """Row, slot and value of every entry of a batch, and each row's weighted sum."""
    slots, vals = (batch.column(batch.schema.get_field_index(c)) for c in ("slots", "vals"))
    row = np.repeat(np.arange(batch.num_rows), np.diff(slots.offsets.to_numpy()))
    at = slots.flatten().to_numpy()
    v = vals.flatten().to_numpy().astype(float)
    z = np.bincount(row, weights=weights[at] * v, minlength=batch.num_rows)
    return row, at, v, np.clip(z, -30, 30)


def _fit_scorer(sample: DataFrame, rounds: int) -> np.ndarray:
    """Logistic regression on soft labels: the gradient is a sum over tasks."""
    weights, speed = np.zeros(DIM), np.full(DIM, 1e-8)

    def gradient(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIM), 0
        for batch in parts:
            if not batch.num_rows:
                continue
            row, at, v, z = _margins(batch, weights)
            good = batch.column(batch.schema.get_field_index("good")).to_numpy()
            miss = 1 / (1 + np.exp(-z)) - good
            total += np.bincount(at, weights=miss[row] * v, minlength=DIM)
            n += batch.num_rows
        yield pa.RecordBatch.from_pydict({"n": [n], "g": [total.astype(np.float64).tobytes()]})

    for _ in range(rounds):
        got = sample.mapInArrow(gradient, "n long, g binary").toArrow()
        n = max(1, sum(got.column("n").to_pylist()))
        g = sum(np.frombuffer(b, dtype=np.float64) for b in got.column("g").to_pylist()) / n
        g = g + 1e-5 * weights
        speed += g ** 2
        weights = weights - 1.0 * g / np.sqrt(speed)
    return weights


def classify(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    fit_rows: int = FIT_ROWS, rounds: int = ROUNDS,
) -> DataFrame:
    """One row per input row: id, posterior, score, keep.

    ``posterior`` is the probability that the text is good given all the
    heuristics' answers, ``score`` the linear scorer's (0 to 1), ``keep`` is
    ``score >= 0.5``.  No given label is read.  Null text counts as empty; rows
    with equal texts get equal results, whatever their ids, nulls and
    repetitions included.  Other columns are not read; an empty table gives no
    rows.
    """
    voted = stage(
        id_text(df, id_col, text_col).mapInArrow(
            _voted, "id long, pattern long, key long, slots array<int>, vals array<float>"),
        "quality_votes")
    counts = voted.groupBy("pattern").count().toArrow()
    codes = counts.column("pattern").to_numpy().astype(np.int64)
    post, _ = fit_labellers(pattern_answers(codes), counts.column("count").to_numpy().astype(float))
    # at most 3 ** labellers rows, in practice a few hundred
    table = df.sparkSession.createDataFrame(
        list(zip(codes.tolist(), post.tolist())), "code long, posterior double")
    fitted = stage(
        # keys are 63 bits from the id; rows of one id are told apart by what they hold
        smallest(voted, (F.col("key") - F.lit(1 << 62)) * 2, ["id", "pattern", "slots", "vals"],
                 fit_rows)
        .join(F.broadcast(table), F.col("pattern") == F.col("code"))
        .select(F.col("posterior").alias("good"), "slots", "vals").repartition(FIT_TASKS),
        "quality_fit")
    weights = _fit_scorer(fitted, rounds)
    out = pa.schema([("id", pa.int64()), ("pattern", pa.int64()), ("score", pa.float64())])

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            z = _margins(batch, weights)[-1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in ("id", "pattern")),
                 pa.array(1 / (1 + np.exp(-z)))], schema=out)

    return (
        voted.mapInArrow(scored, "id long, pattern long, score double")
        .join(F.broadcast(table), F.col("pattern") == F.col("code"))
        .select("id", "posterior", "score", (F.col("score") >= 0.5).alias("keep"))
    )
