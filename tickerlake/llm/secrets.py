"""Secret scan over a trigram inverted index.  DataFrame functions only.

From every rule's regular expression a Boolean query over trigrams is derived:
an OR of ANDs of trigrams that any match must contain (case folded).  The index
has a posting ``(trigram, document)`` for every trigram that some query asks
for.  A document's postings, intersected per query, make it a candidate of a
rule; only candidates are verified with the rule's regular expression.  A rule
without mandatory trigrams scans every document.

Spans come from splitting a text at its matches: the lengths of the pieces
between and of the matches, summed up in order.  The sums run as a window over
one row per match, so texts with very many matches stay linear.
"""

from __future__ import annotations

import re._parser as regex_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, stage


@dataclass(frozen=True)
class Rule:
    """``pattern`` must read the same in Java and Python; a match counts if its
    ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed rules, in the order of the contract.  The last two state the length in
#: the pattern: the characters a too short match takes up hold no other match.
BASE = (
    Rule("assign",
         r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
         r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
#: What the scan adds to the base rules.
MORE = (Rule("private_key", r"-----BEGIN[A-Z ]{0,32}PRIVATE KEY-----"),)

MOST_ALTERNATIVES = 256


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of ANDs of lower-case trigrams that every match contains; None if some
    match need not contain any."""
    done = _walk(regex_parser.parse(pattern), [("", frozenset())])
    if done is None:
        return None
    clauses = {grams for _, grams in done}
    if frozenset() in clauses:
        return None
    # a clause that asks for more than another adds nothing
    return sorted((c for c in clauses if not any(o < c for o in clauses)), key=sorted)


def _walk(items, states: list[tuple[str, frozenset]]) -> list[tuple[str, frozenset]] | None:
    """States after ``items``: the literal run so far (its end) and the trigrams seen."""
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            states = [_add(run, grams, chr(arg).lower()) for run, grams in states]
        elif name == "SUBPATTERN":
            states = _walk(arg[3], states)
        elif name == "BRANCH":
            parts = [_walk(branch, states) for branch in arg[1]]
            states = None if None in parts else [s for part in parts for s in part]
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg
            once = _walk(inner, states)
            if once is None:
                states = None
            elif (low, high) == (0, 1):
                states = states + once
            elif low == 0:
                states = [("", grams) for _, grams in states]
            elif (low, high) == (1, 1):
                states = once
            else:  # at least one, then anything
                states = [("", grams) for _, grams in once]
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        else:  # a class or anything else that is not one character
            states = [("", grams) for _, grams in states]
        if states is None:
            return None
        states = list(dict.fromkeys(states))
        if len(states) > MOST_ALTERNATIVES:
            return None
    return states


def _add(run: str, grams: frozenset, c: str) -> tuple[str, frozenset]:
    run = run + c
    return run[-2:], grams | {run[-3:]} if len(run) >= 3 else grams


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings ``trigram, id, h`` over (id, text, h), for the trigrams asked for."""
    low = docs.select("id", "h", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*[
        F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("id", "h", F.explode(found).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """``id, h, rules``: bit k of ``rules`` says that query k holds."""
    trigrams = sorted({t for q in queries.values() for c in q for t in c})
    has = {t: F.max(F.col("trigram") == t) for t in trigrams}
    flags = postings.groupBy("id", "h").agg(*[
        has[t].alias(f"t{k}") for k, t in enumerate(trigrams)])
    at = {t: F.col(f"t{k}") for k, t in enumerate(trigrams)}

    def all_of(clause: frozenset[str]) -> Column:
        out = F.lit(True)
        for t in sorted(clause):
            out = out & at[t]
        return out

    rules = F.lit(0)
    for k, query in queries.items():
        holds = F.lit(False)
        for clause in query:
            holds = holds | all_of(clause)
        rules = rules + F.when(holds, F.lit(1 << k)).otherwise(F.lit(0))
    return flags.select(F.col("id").alias("c_id"), F.col("h").alias("c_h"),
                        rules.alias("rules")).filter("rules <> 0")


def find_secrets(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = BASE + MORE,
) -> DataFrame:
    """One row per input row: id, found (array of (start, kind index, kind, end)).

    Spans are code points, end exclusive, sorted by start, then by the order of
    ``rules``; a rule's matches don't overlap, those of different rules may.
    Null text counts as empty.  Null and repeated ids are fine: a posting names
    a document by its id and a hash of its text, and spans are gathered per row.
    Other columns are not read; an empty table gives no rows.
    """
    docs = id_text(df, id_col, text_col).withColumn("h", F.xxhash64("text"))
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not None}
    known = docs
    if queries:
        trigrams = sorted({t for q in queries.values() for c in q for t in c})
        postings = stage(build_index(docs, trigrams), "secret_postings")
        some = stage(candidates(postings, queries), "secret_candidates")
        known = docs.join(
            some.hint("shuffle_hash"),
            F.col("id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")), "left")
    else:
        known = docs.withColumn("rules", F.lit(0))
    # lengths of pieces, matches and measured groups, per rule; the text ends here
    columns = {}
    for k, r in enumerate(rules):
        wanted = (F.col("rules").bitwiseAND(F.lit(1 << k)) != 0) if k in queries else F.lit(True)
        pattern = F.lit(r.pattern)
        lengths = lambda x: F.transform(x, lambda s: F.char_length(s))
        zipped = F.arrays_zip(
            lengths(F.split("text", r.pattern, -1)).alias("piece"),
            lengths(F.regexp_extract_all("text", pattern, F.lit(0))).alias("match"),
            lengths(F.regexp_extract_all("text", pattern, F.lit(r.group))).alias("value"),
        )
        columns[f"r{k}"] = F.when(wanted & F.regexp_like("text", pattern), zipped)
    measured = stage(
        known.select("id", F.monotonically_increasing_id().alias("uid"),
                     *[c.alias(n) for n, c in columns.items()]),
        "secret_lengths")
    matches = None
    for k, r in enumerate(rules):
        one = measured.filter(F.col(f"r{k}").isNotNull()).select(
            "uid", F.lit(k).alias("k"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"),
            F.posexplode(f"r{k}").alias("i", "m")).select("uid", "k", "kind", "least", "i", "m.*")
        matches = one if matches is None else matches.unionByName(one)
    w = Window.partitionBy("uid", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("piece") + F.coalesce("match", F.lit(0))).over(w)
    spans = (
        matches.withColumn("end", end)
        # the piece behind the last match has no match
        .filter("match is not null and value >= least")
        .groupBy("uid")
        .agg(F.array_sort(F.collect_list(F.struct(
            (F.col("end") - F.col("match")).alias("start"), "k", "kind", "end"))).alias("found"))
    )
    return (
        measured.select("id", "uid").join(spans, "uid", "left")
        .select("id", F.coalesce(
            "found", F.array().cast("array<struct<start:bigint,k:int,kind:string,end:bigint>>")
        ).alias("found"))
    )


def report(found: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, and all spans as text."""

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def only(test) -> Column:
        return F.filter("found", test)

    def number(kind: str) -> Column:
        return F.size(only(lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "id",
        *[number(r.kind).alias(f"n_{r.kind}") for r in base],
        F.sha2(said(only(lambda s: s["k"] < len(base))), 256).alias("base_sha256"),
        said(F.col("found")).alias("spans"),
    )


def report_sql(rules: tuple[Rule, ...] = BASE + MORE, base: tuple[Rule, ...] = BASE) -> str:
    """The report as SQL over ``documents`` (no index: every rule scans)."""
    scans = " UNION ALL ".join(
        f"""SELECT doc_id, {k} AS k, '{r.kind}' AS kind, {r.least} AS least,
                   regexp_split_to_array(t, '{p}') AS pieces,
                   regexp_extract_all(t, '{p}', 0) AS ms,
                   regexp_extract_all(t, '{p}', {r.group}) AS vs
            FROM d WHERE regexp_matches(t, '{p}')"""
        for k, r in enumerate(rules) for p in [r.pattern.replace("'", "''").replace('\\"', '"')])
    counts = ", ".join(
        f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in base)
    said = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k)"
    return f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        m AS ({scans}),
        x AS (SELECT *, unnest(range(len(ms))) AS i FROM m),
        y AS (
            SELECT doc_id, k, kind, least, length(vs[i + 1]) AS v, length(ms[i + 1]) AS n,
                   list_sum(list_transform(pieces[1:i + 1], lambda p: length(p)))
                   + coalesce(list_sum(list_transform(ms[1:i], lambda p: length(p))), 0) AS s0
            FROM x
        ),
        z AS (SELECT doc_id, k, kind, s0::BIGINT AS s, (s0 + n)::BIGINT AS e FROM y WHERE v >= least),
        g AS (
            SELECT doc_id, {counts},
                   sha256(coalesce({said} FILTER (WHERE k < {len(base)}), '')) AS base_sha256,
                   {said} AS spans
            FROM z GROUP BY doc_id
        )
        SELECT d.doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in base)},
               coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN g ON d.doc_id = g.doc_id"""
