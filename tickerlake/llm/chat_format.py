"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only its text is trainable.  The examples of a conversation are
prefixes of one formatted text, so that text is stored once, turn by turn
(``turns``), and an example is a row of offsets into it (``examples``): the
expansion is complete, while its size grows with the number of turns and not
with their square.  ``render`` writes examples out in full.

Turns are put in order by a range partitioning on (conversation, turn), so one
conversation with a third of all rows is spread over many tasks; offsets carry
over from partition to partition by a sum per (conversation, partition).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, shuffle_partitions, stage, values


@dataclass(frozen=True)
class Template:
    """Marks around a turn's role and text, and the strings that texts must not forge.

    A control string inside a role or text gets one backslash after its first
    character, and one that has k backslashes there gets k + 1; reading takes
    one away.  So no text holds a control string once written, and every text
    reads back exactly.
    """

    begin: str = "<|im_start|>"
    between: str = "<|im_sep|>"
    end: str = "<|im_end|>\n"
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_sep|>", "<|im_end|>",
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    )
    trained_role: str = "assistant"

    def _pattern(self, least: str) -> str:
        """First character, backslashes, rest of any control string (Java and Python)."""
        special = re.compile(r"([^A-Za-z0-9_])")
        heads = "".join(sorted({special.sub(r"\\\1", c[0]) for c in self.controls}))
        rests = "|".join(special.sub(r"\\\1", c[1:]) for c in self.controls)
        return rf"([{heads}])({least})({rests})"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\*"), r"$1\\$2$3")

    def unescape(self, text: str) -> str:
        """Task-side inverse of ``escape``."""
        return re.sub(self._pattern(r"\\+"), lambda m: m[1] + m[2][1:] + m[3], text)

    def format(self, role: Column, text: Column) -> Column:
        return F.concat(F.lit(self.begin), self.escape(role), F.lit(self.between),
                        self.escape(text), F.lit(self.end))

    def parse(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        inner = formatted[len(self.begin):-len(self.end)]
        role, _, text = inner.partition(self.between)
        return self.unescape(role), self.unescape(text)


def format_conversations(
    df: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``(turns, examples)``.

    ``turns``: conv_id, position (0-based), formatted, start, end, trained,
    loss_start, loss_end -- one row per input row, offsets in code points of
    the conversation's formatted text (the turns joined by position).

    ``examples``: conv_id, example (0-based), position, context_end, loss_start,
    loss_end, end -- one row per assistant turn.  The example's text is the
    conversation's text up to ``end``; ``[0, context_end)`` is the context, and
    exactly ``[loss_start, loss_end)``, the (escaped) reply, is trainable.

    Turns go by turn number, nulls first; equal numbers by role, then text (code
    points).  Null roles and texts count as empty, rows with a null conversation
    are one conversation.  Repeated rows are turns of their own; an assistant
    turn with an empty text is an example with an empty loss span.  A
    conversation without assistant turns has no example.  Other columns are not
    read, so their names don't matter; an empty table gives two empty ones.
    """
    spark = df.sparkSession
    t = template
    role = F.coalesce(df[role_col].cast("string"), F.lit(""))
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    rows = df.select(df[conv_col].cast("long").alias("conv_id"),
                     df[turn_col].cast("long").alias("turn"),
                     role.alias("role"), text.alias("text"))
    formatted = t.format(F.col("role"), F.col("text"))
    before = F.char_length(t.escape(F.col("role"))) + len(t.begin) + len(t.between)
    ordered = stage(
        rows.repartitionByRange(shuffle_partitions(spark), "conv_id", "turn")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select(
            "conv_id", (F.col("role") == t.trained_role).alias("trained"),
            formatted.alias("formatted"),
            before.cast("long").alias("before"),
            F.monotonically_increasing_id().alias("rid"),
            F.spark_partition_id().alias("part"),
        )
        .withColumn("chars", F.char_length("formatted").cast("long")),
        "chat_turns",
    )
    # offsets inside (conversation, partition), then those of the partitions before
    own = Window.partitionBy("conv_id", "part").orderBy("rid").rowsBetween(
        Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)

    def before_row(c: Column | str, w) -> Column:
        return F.coalesce(F.sum(c).over(w), F.lit(0))

    one = F.lit(1).cast("long")
    trained = F.col("trained").cast("long")
    carried = (
        ordered.groupBy("conv_id", "part")
        .agg(F.sum("chars").alias("c"), F.count(one).alias("n"), F.sum(trained).alias("e"))
        .select(F.col("conv_id").alias("conv"), F.col("part").alias("of"),
                before_row("c", earlier).alias("c0"), before_row("n", earlier).alias("n0"),
                before_row("e", earlier).alias("e0"))
    )
    placed = (
        ordered
        .withColumns({"c1": before_row("chars", own), "n1": before_row(one, own),
                      "e1": before_row(trained, own)})
        .join(carried, F.col("conv_id").eqNullSafe(F.col("conv"))
              & (F.col("part") == F.col("of")))
    )
    start = F.col("c0") + F.col("c1")
    turns = stage(
        placed.select(
            "conv_id", (F.col("n0") + F.col("n1")).alias("position"),
            (F.col("e0") + F.col("e1")).alias("example"), "formatted",
            start.alias("start"), (start + F.col("chars")).alias("end"), "trained",
            F.when(F.col("trained"), start + F.col("before")).alias("loss_start"),
            F.when(F.col("trained"), start + F.col("chars") - len(t.end)).alias("loss_end"),
        ),
        "chat_formatted",
    )
    examples = turns.filter("trained").select(
        "conv_id", "example", "position", F.col("start").alias("context_end"),
        "loss_start", "loss_end", "end")
    return turns.drop("example"), examples


def render(turns: DataFrame, examples: DataFrame) -> DataFrame:
    """Examples in full: conv_id, example, text, loss_start, loss_end.

    Every example repeats its context, so the output is as large as the sum of
    their lengths; pass the examples that are to be written.
    """
    # the cut that makes it a prefix is part of the join, so only own turns travel
    e = examples.select(F.col("conv_id").alias("conv"), "example", F.col("position").alias("last"),
                        "loss_start", "loss_end")
    t = turns.select("conv_id", "position", "formatted")
    return (
        e.join(t, F.col("conv").eqNullSafe(F.col("conv_id")) & (F.col("position") <= F.col("last")))
        .groupBy(F.col("conv").alias("conv_id"), "example", "loss_start", "loss_end")
        .agg(F.array_sort(F.collect_list(F.struct("position", "formatted"))).alias("p"))
        .select("conv_id", "example", F.array_join("p.formatted", "").alias("text"),
                "loss_start", "loss_end")
    )


_DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ("n_examples", pa.int64()), ("examples_chars", pa.int64()),
])
DIGEST_DDL = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_examples long, examples_chars long"
)


def digest(turns: DataFrame, examples: DataFrame, template: Template = Template()) -> DataFrame:
    """What a reader finds in formatted turns and their examples, one row per conversation.

    Loss text, number and lengths of the examples are read through the examples:
    each one's offsets are looked up in the turn that its context ends at.  A
    reader streams the turns of a conversation in order and keeps running
    hashes, so memory doesn't depend on the conversation's length.  An example
    whose context doesn't end where its turn starts, or that is out of order, is
    an error.
    """
    t = template
    of = examples.select(
        F.col("conv_id").alias("conv"), F.col("position").alias("last"), "context_end",
        F.col("example").alias("number"), F.col("loss_start").alias("lo"),
        F.col("loss_end").alias("hi"), F.col("end").alias("whole"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            conv, state = None, None
            for batch in parts:
                for conv_id, formatted, start, number, context, lo, hi, end in zip(*(
                    values(batch, c) for c in ("conv_id", "formatted", "start", "number",
                                               "context_end", "lo", "hi", "whole")
                )):
                    if state is None or conv_id != conv:
                        if state:
                            yield done(conv, state)
                        conv, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                    role, text = t.parse(formatted)
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if number is not None:
                        if context != start or number != state[5]:
                            raise ValueError(f"example {number} of {conv_id} is misplaced")
                        loss = t.unescape(formatted[lo - context:hi - context])
                        state[2] += len(loss)
                        state[3].update(loss.encode())
                        state[5] += 1
                        state[6] += end
                    state[4] += len(formatted)
            if state:
                yield done(conv, state)

        def done(conv, s) -> tuple:
            return conv, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5], s[6]

        yield from batches(rows(), _DIGEST)

    spark = turns.sparkSession
    return (
        turns.select("conv_id", "position", "formatted", "start")
        .join(of, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("position") == F.col("last")),
              "left")
        .repartition(shuffle_partitions(spark), "conv_id")
        .sortWithinPartitions("conv_id", "position")
        .mapInArrow(run, DIGEST_DDL)
    )
