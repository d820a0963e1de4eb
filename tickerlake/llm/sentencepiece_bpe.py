"""Exact SentencePiece BPE encoding by backtracking, and decoding.

A merge-type encoding of a text is the one sequence of pieces in which every
adjacent pair is compatible: merging the two pieces' characters anew gives the
same two pieces.  So the encoder needs no merge queue: it takes the longest
piece that an Aho-Corasick automaton finds at the position, checks it against
the piece before, tries shorter pieces, and steps back when none fits; a
bitfield marks the positions from which no encoding continues, so each is tried
once.

A text is cut into chunks first at places no piece reaches across (before a
run of spaces, around line breaks, around characters that no piece has and
that therefore become bytes).  Chunks repeat, so each worker keeps a bounded
table of encoded ones.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import batches, id_text, values

SPACE = "▁"
#: Chunks and pairs a worker remembers; a bound on memory, not on results.
KEPT_CHUNKS = 600_000
KEPT_PAIRS = 400_000


class Encoder:
    """Encoder for one model.  ``longest`` and ``compatible`` hold the method."""

    def __init__(self, model: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        sp = self.sp
        self.eos = sp.eos_id()
        self.byte_ids = {}
        self.rank: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.rank[piece] = -sp.get_score(i)
                self.id_of[piece] = i
        for piece in self.id_of:
            if any(b == SPACE != a for a, b in zip(piece, piece[1:])):
                raise ValueError("a piece holds a space after another character")
        self.alphabet = {c for piece in self.id_of for c in piece}
        self.pieces = {i: p for p, i in self.id_of.items()}
        # only pieces that merging their own characters gives can be in an encoding
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[str, list[str]] = {}
        usable = [p for p in self.id_of if self.remerge(p) == [p]]
        known = set(usable)
        for p in usable:
            self.automaton.add_word(p, p)
            #: the piece and its prefixes that are pieces, longest first
            self.shorter[p] = [p[:n] for n in range(len(p), 0, -1) if p[:n] in known]
        self.automaton.make_automaton()
        self.cut = re.compile(self._cuts())
        self.pairs: dict[tuple[str, str], bool] = {}
        # encoded chunks (decimal ids) in two generations: a full young one becomes
        # the old one, and what is met again moves back, so frequent chunks stay
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def _cuts(self) -> str:
        """Pattern of the chunks.  No piece reaches from one chunk into the next:
        white space that no piece has is cut out, and a word of letters ends
        before a punctuation character that no piece has after a letter."""
        breaks = "".join(re.escape(c) for c in "\n\t\r" if c not in self.alphabet)
        letter = r"[^\W\d_]"
        ends = [f"[{SPACE}{breaks}]", "$"]
        for c in string.punctuation:  # behind letters that no piece has before it
            joined = {a for piece in self.id_of for a, b in zip(piece, piece[1:])
                      if b == c and re.match(letter, a)}
            ends.append((f"(?<![{''.join(sorted(joined))}])" if joined else "") + re.escape(c))
        cuts = [
            f"{SPACE}*{letter}+(?={'|'.join(ends)})",
            f"{SPACE}*[^{SPACE}{breaks}]+",
            f"{SPACE}+",
        ]
        return "|".join(cuts + [f"[{breaks}]"] * bool(breaks))

    def remerge(self, text: str) -> list[str]:
        """Characters merged step by step: best-ranked pair first, leftmost of equals."""
        parts = list(text)
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                r = rank.get(parts[k] + parts[k + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging both pieces' characters anew gives these two pieces."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.remerge(left + right) == [left, right]
        return known

    def longest(self, chunk: str) -> list[str | None]:
        """The longest piece starting at each position."""
        found: list[str | None] = [None] * len(chunk)
        for end, piece in self.automaton.iter(chunk):
            found[end + 1 - len(piece)] = piece  # later ends come later: longer
        return found

    def backtrack(self, chunk: str) -> list[str]:
        """Pieces of a chunk of known characters."""
        longest, pairs, size = self.longest(chunk), self.pairs, len(chunk)
        failed = 0  # bit set: no encoding continues from that position
        done: list[str] = []
        last, at, piece = None, 0, longest[0]
        while at < size:
            # from `piece` on: the longest prefix of it that fits
            options = self.shorter[piece] if piece else ()
            for piece in options:
                end = at + len(piece)
                if not failed >> end & 1 and (
                    last is None or pairs.get((last, piece)) or self.compatible(last, piece)
                ):
                    done.append(piece)
                    last, at = piece, end
                    piece = longest[at] if at < size else None
                    break
            else:
                if last is None:
                    raise ValueError(f"no encoding of {chunk!r}")
                failed |= 1 << at
                piece = done.pop()  # its end is marked now, so a shorter one comes next
                at -= len(piece)
                last = done[-1] if done else None
        return done

    def encode_chunk(self, chunk: str) -> list[int]:
        id_of, known = self.id_of, self.alphabet
        if known.issuperset(chunk):
            return [id_of[p] for p in self.backtrack(chunk)]
        ids: list[int] = []
        start = 0
        for k, c in enumerate(chunk):
            if c not in known:
                if start < k:
                    ids += [id_of[p] for p in self.backtrack(chunk[start:k])]
                ids += [self.byte_ids[b] for b in c.encode()]
                start = k + 1
        if start < len(chunk):
            ids += [id_of[p] for p in self.backtrack(chunk[start:])]
        return ids

    def _missed(self, chunk: str) -> str:
        got = self.old.get(chunk) or " ".join(map(str, self.encode_chunk(chunk)))
        if len(chunk) <= 48:
            if 2 * len(self.young) >= KEPT_CHUNKS:
                self.old, self.young = self.young, {}
            self.young[chunk] = got
        return got

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids with the end id last, and the decimal ids joined by a space."""
        # the model puts a space before the text and marks spaces
        chunks = self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []
        said = list(map(self.young.get, chunks))
        if None in said:
            said = [g or self._missed(c) for g, c in zip(said, chunks)]
        said.append(str(self.eos))
        joined = " ".join(said)
        return list(map(int, joined.split())), joined

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(model: str) -> Encoder:
    """The worker's encoder for a model file, built once per worker process."""
    if model not in _ENCODERS:
        _ENCODERS[model] = Encoder(model)
    return _ENCODERS[model]


def _run(model: str, ids_too: bool, schema: pa.Schema):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)

        def rows() -> Iterator[tuple]:
            for batch in parts:
                for doc_id, text in zip(values(batch, "id"), values(batch, "text")):
                    ids, said = coder.encode(text)
                    decoded = coder.decode(ids)
                    yield (
                        doc_id, len(ids), hashlib.sha256(said.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest(),
                        *((ids, decoded) if ids_too else ()),
                    )

        yield from batches(rows(), schema, most_rows=5_000)

    return run


def encode_decode(
    df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256.

    With ``with_ids`` also the ids themselves and the decoded text.  The ids
    are those of the library for the model, with the end id and without
    sampling; null text counts as empty (the end id alone).  A row depends on
    its own text only, so repeated rows, ties and null ids pass through; an
    empty table gives no rows, and columns beside the two named are not read.
    The model is a file that every executor has (the installed vocabulary).
    """
    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())]
    ddl = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
        ddl += ", ids array<int>, decoded string"
    return id_text(df, id_col, text_col).mapInArrow(
        _run(model, with_ids, pa.schema(fields)), ddl)
