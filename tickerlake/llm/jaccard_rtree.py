"""N-gram Jaccard join through an R-tree over count vectors.

A document is the set of its distinct word shingles.  The 64-bit hashes of the
shingles are dealt to equal ranges, more of them for larger sets, and the counts
per range are a point.  Two sets share at most the sum of the coordinate minima of their points,
and a set shares with any set below a node of the tree at most the sum of the
minima of its point and the node's largest counts.  Pairs that pass are verified
on the sets themselves.

Which points meet in one tree is decided without loss.  Of two linked sets the
smaller has n shingles, so they differ in at most ``d = n * (1 - t) / t`` of
them; the hash range cut into d + 1 segments has a segment in which they are
equal.  A set's segments are keys, all sets that share a key with the smallest
set of the key are a cell, and a cell has a tree.  Two sets of one component
needn't meet again, so a tree passes over nodes that hold nothing but the
asking set's component, and a cell yields a spanning forest, not its pairs.

The points alone go through a cell's tree first, and the content of a set is only
fetched where a candidate is left.  A cell above ``most_sets`` sets or
``most_shingles`` shingles is cut into blocks.  Where such a cell still has
several components afterwards, the sets outside its largest component meet each
block once more, so that no link between blocks is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import binary, id_text, shuffle_partitions, stage, values
from .components import components

WORDS = 4
#: Least similarity as a fraction: shared * DEN >= united * NUM.
NUM, DEN = 85, 100
#: Coordinates of a small set's point, and of the largest set's.
GROUPS = 32
FINEST = 4_096
LEAF = 64
#: Sets and shingles of one tree; larger cells are cut into blocks.
MOST_SETS = 4_000
MOST_SHINGLES = 2_000_000
#: Points of one tree without content; the sets of larger cells all go on.
MOST_POINTS = 50_000
#: Bits of the filter that tells which sets have a cell (16 MB, whatever the input).
FILTER_BITS = 1 << 27

_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xBF58476D1CE4E5B9)
_K3 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of words, kept while a task runs, up to a number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles (bytes.lower and split are ASCII)."""
    found = text.lower().split()
    n = len(found)
    if not n:
        return np.empty(0, dtype=np.uint64)
    own = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=n)
    long = min(words, n)
    with np.errstate(over="ignore"):
        h = np.full(n - long + 1, long, dtype=np.uint64)
        for k in range(long):
            h = h * _K1 + own[k:n - long + 1 + k]
        return np.unique(mix(h))


def set_id(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def bounds(most: int, num: int, den: int) -> list[int]:
    """First sizes of the size classes, up to ``most``: sets that link are in the
    same class or in neighbouring ones."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * den // num + 1)
    return out


def segment_keys(shingles: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Keys of a set: the segments of its own size class and of the class below."""
    n = len(shingles)
    if not n:
        return np.empty(0, dtype=np.int64)
    first = bounds(n, num, den)
    own = len(first) - 2
    mixed = np.concatenate([[np.uint64(0)], mix(shingles + _K1)])
    out = []
    with np.errstate(over="ignore"):
        sums = np.cumsum(mixed, dtype=np.uint64)
        for of in (own, own - 1):
            if of < 0:
                continue
            cuts = (first[of + 1] - 1) * (den - num) // num + 1
            if cuts == 1:  # only equal sets are linked, and those are one already
                continue
            starts = np.array([(k << 64) // cuts for k in range(1, cuts)], dtype=np.uint64)
            at = np.concatenate([[0], np.searchsorted(shingles, starts), [n]])
            content = sums[at[1:]] - sums[at[:-1]]
            place = np.uint64((of << 40) + 1) + np.arange(cuts, dtype=np.uint64)
            out.append(mix(content + mix(place * _K1)))
    return np.concatenate(out).view(np.int64) if out else np.empty(0, dtype=np.int64)


def point(shingles: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Counts of a set's hashes in equal ranges of the hash space: ``groups`` of
    them, doubled until a range holds eight hashes or less (at most ``FINEST``
    ranges), since the counts of large ranges are all alike."""
    while groups < FINEST and len(shingles) > 8 * groups:
        groups *= 2
    starts = np.array([(k << 64) // groups for k in range(1, groups)], dtype=np.uint64)
    at = np.searchsorted(shingles, starts)
    return np.diff(at, prepend=0, append=len(shingles)).astype(np.int32)


def alike(points: list[np.ndarray]) -> np.ndarray:
    """Points as rows; neighbouring counts are added up to the coarsest point's ranges."""
    groups = min(map(len, points))
    return np.stack([p.reshape(groups, -1).sum(axis=1) for p in points])


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int(np.count_nonzero(b[at] == a))


class Tree:
    """R-tree over the points of some sets.

    Leaves hold ``LEAF`` points, packed by size and then along their counts;
    every level above takes ``LEAF`` nodes into one.  A node has the largest
    counts and the least and largest size of what is below.
    """

    def __init__(self, at: np.ndarray, num: int = NUM, den: int = DEN):
        size = at.sum(axis=1, dtype=np.int64)
        self.order = np.lexsort((*at.T[:4], size))
        self.num, self.den = num, den
        self.size, self.at = size[self.order], at[self.order]
        self.levels = []
        high, low, top = self.at, self.size, self.size
        while True:
            cut = np.arange(0, len(low), LEAF)
            high = np.maximum.reduceat(high, cut)
            low, top = np.minimum.reduceat(low, cut), np.maximum.reduceat(top, cut)
            self.levels.append((high, low, top))
            if len(low) == 1:
                break

    def need(self, own, other):
        """Fewest shared shingles of linked sets of these sizes."""
        return -(-self.num * (own + other) // (self.num + self.den))

    def leaves(self, k: int) -> np.ndarray:
        """Leaves that may hold a set linked with ``k``."""
        nodes = np.zeros(1, dtype=np.int64)
        own, at = self.size[k], self.at[k]
        least, most = -(-own * self.num // self.den), own * self.den // self.num
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low, top = self.levels[depth]
            nodes = nodes[(top[nodes] >= least) & (low[nodes] <= most)]
            reach = np.minimum(high[nodes], at).sum(axis=1)
            nodes = nodes[reach >= self.need(own, np.maximum(low[nodes], least))]
            if depth:
                below = len(self.levels[depth - 1][1])
                nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
                nodes = nodes[nodes < below]
        return nodes

    def members(self, leaf: int) -> np.ndarray:
        return np.arange(leaf * LEAF, min(len(self.size), leaf * LEAF + LEAF))

    def near(self, k: int, j: np.ndarray) -> np.ndarray:
        """Those of ``j`` whose coordinate minima with ``k`` sum up to enough."""
        reach = np.minimum(self.at[j], self.at[k]).sum(axis=1)
        return j[reach >= self.need(self.size[k], self.size[j])]

    def candidates(self) -> np.ndarray:
        """Which of the given points have another one that passes the bound."""
        found = np.zeros(len(self.size), dtype=bool)
        for k in range(len(found)):
            if found[k]:
                continue
            for leaf in self.leaves(k):
                j = self.members(leaf)
                j = self.near(k, j[j != k])
                if len(j):
                    found[j] = found[k] = True
                    break
        out = np.empty(len(found), dtype=bool)
        out[self.order] = found
        return out


class Links(Tree):
    """The links found among some sets through their tree."""

    def __init__(self, sets: list[np.ndarray], labels: list[int], num: int = NUM,
                 den: int = DEN, groups: int = GROUPS):
        super().__init__(alike([point(s, groups) for s in sets]), num, den)
        self.sets = [sets[k] for k in self.order]
        # sets that come with one label are connected already
        _, first, same = np.unique(
            np.array(labels)[self.order], return_index=True, return_inverse=True)
        self.up = first[same.ravel()].astype(np.int64)

    def root(self, k: int) -> int:
        up = self.up
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    def roots(self) -> np.ndarray:
        at = self.up
        while (above := at[at]).tobytes() != at.tobytes():
            at = above
        self.up = at.copy()
        return at

    def find(self, asking: np.ndarray | None = None) -> list[tuple[int, int]]:
        """Links that connect what the sets' links connect, as positions of the
        given list.  ``asking``: only links of these sets are looked for."""
        out = []
        n = len(self.sets)
        cut = np.arange(0, n, LEAF)
        asks = np.ones(n, dtype=bool) if asking is None else asking[self.order]
        for start in cut:
            roots = self.roots()
            low, top = np.minimum.reduceat(roots, cut), np.maximum.reduceat(roots, cut)
            for k in range(start, min(n, start + LEAF)):
                if not asks[k]:
                    continue
                leaves = self.leaves(k)
                # what holds nothing but the component of k is passed over
                for leaf in leaves[(low[leaves] != roots[k]) | (top[leaves] != roots[k])]:
                    j = self.members(leaf)
                    # two that ask are looked at once
                    j = self.near(k, j[(roots[j] != roots[k]) & (~asks[j] | (j > k))])
                    for other in j.tolist():
                        a, b = self.root(k), self.root(other)
                        if a == b:
                            continue
                        both = shared(self.sets[k], self.sets[other])
                        united = len(self.sets[k]) + len(self.sets[other]) - both
                        if both * self.den >= united * self.num:
                            self.up[max(a, b)] = min(a, b)
                            out.append((int(self.order[k]), int(self.order[other])))
        return out


def _sets(words: int, kind: str, num: int, den: int, groups: int,
          wanted: np.ndarray | None = None):
    """Task side over ``id, text``.  ``docs``: size, set and point of every row;
    ``keys``: keys of every set; ``sets``: content of sets that the filter lets through."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()

        def new(uid: int) -> bool:
            """Copies nearby are left out already here; all others are later."""
            if uid in seen:
                return False
            if len(seen) > 200_000:
                seen.clear()
            seen.add(uid)
            return True

        for batch in parts:
            out: list[list] = [[], [], [], []]
            held = 0
            for doc_id, text in zip(values(batch, "id"), binary(batch, "text")):
                s = shingle_set(text, hashes, words)
                uid = set_id(s) if len(s) else None
                if kind == "docs":
                    counts = point(s, groups).tobytes() if len(s) else None
                    for col, v in zip(out, (doc_id, len(s), uid, counts)):
                        col.append(v)
                    continue
                if uid is None or not new(uid):
                    continue
                if kind == "keys":
                    keys = segment_keys(s, num, den)
                    out[0].append(keys)
                    out[1].append(np.full(len(keys), uid, dtype=np.int64))
                    held += len(keys)
                elif wanted is None or wanted[(at := uid % FILTER_BITS) >> 3] >> (at & 7) & 1:
                    out[0].append(uid)
                    out[1].append(s.tobytes())
                    held += len(s)
                if held > 2_000_000:
                    yield packed(out)
                    out, held = [[], [], [], []], 0
            yield packed(out)

    def packed(out: list[list]) -> pa.RecordBatch:
        if kind == "docs":
            return pa.RecordBatch.from_pydict({
                "id": pa.array(out[0], pa.int64()), "n": pa.array(out[1], pa.int64()),
                "uid": pa.array(out[2], pa.int64()), "point": pa.array(out[3], pa.binary())})
        if kind == "keys":
            key, uid = (np.concatenate(c) if c else np.empty(0, dtype=np.int64) for c in out[:2])
            return pa.RecordBatch.from_pydict({"key": pa.array(key), "uid": pa.array(uid)})
        return pa.RecordBatch.from_pydict({
            "uid": pa.array(out[0], pa.int64()), "content": pa.array(out[1], pa.binary())})

    return run


def _stars(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, uid): every set with the smallest one of its key, where
    it is another.  Only the last row's key and its smallest set are kept."""
    last_key = last_uid = None
    for batch in parts:
        key = batch.column(0).to_numpy()
        uid = batch.column(1).to_numpy()
        if not len(key):
            continue
        start = np.concatenate([[True], key[1:] != key[:-1]])
        start[0] = key[0] != last_key
        at = np.maximum.accumulate(np.where(start, np.arange(len(key)), -1))
        cell = np.where(at >= 0, uid[np.maximum(at, 0)], 0 if last_uid is None else last_uid)
        other = cell != uid
        last_key, last_uid = key[-1], cell[-1]
        pairs = np.unique(np.stack([cell[other], uid[other]]), axis=1)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(pairs[0]), "uid": pa.array(pairs[1])})


def cells(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``cell, uid``: the sets of every cell; a cell is named by its smallest set."""
    spark = docs.sparkSession
    found = (
        docs.mapInArrow(_sets(words, "keys", num, den, GROUPS), "key long, uid long")
        .repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", "uid")
        .mapInArrow(_stars, "cell long, uid long").distinct()
    )
    return stage(found, "jaccard_cells")


def membership_filter(uids: DataFrame) -> np.ndarray:
    """One bit per set id, of a fixed number of bits; sets beside those asked for
    may pass, none is lost."""
    at = F.pmod(F.col("uid"), F.lit(FILTER_BITS)) + 1  # buckets count from one
    rows = (
        uids.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    )
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in rows:
        bits = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
        start = (r["bucket"] - 1) * len(bits)
        out[start:start + len(bits)] = bits
    return out


def _link(num: int, den: int, groups: int):
    """Task side: rows sorted by ``tree`` (a struct's three numbers); of every tree
    the links found among its sets."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(held: list[tuple]) -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            uid, content, label, asks = zip(*held)
            sets = [np.frombuffer(c, dtype=np.uint64) for c in content]
            asking = np.array(asks)
            tree = Links(sets, list(label), num, den, groups)
            return [(uid[a], uid[b]) for a, b in tree.find(None if asking.all() else asking)]

        def packed(found: list) -> pa.RecordBatch:
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()),
                                               "b": pa.array(b, pa.int64())})

        group, held = None, []
        for batch in parts:
            found: list = []
            for cell, block, *row in zip(*(values(batch, c) for c in (
                    "cell", "block", "uid", "content", "label", "asks"))):
                if (cell, block) != group:
                    found += linked(held)
                    group, held = (cell, block), []
                held.append(tuple(row))
            yield packed(found)
        yield packed(linked(held))

    return run


def _in_trees(rows: DataFrame, num: int, den: int, groups: int, name: str) -> DataFrame:
    """Links ``a, b`` of rows ``cell, block, uid, content, label, asks``."""
    return stage(
        rows.repartition(shuffle_partitions(rows.sparkSession), "cell", "block")
        .sortWithinPartitions("cell", "block", "uid")
        .mapInArrow(_link(num, den, groups), "a long, b long"), name)


def _mark(num: int, den: int):
    """Task side: rows ``cell, uid, point`` sorted by cell; of every cell the sets
    that have a candidate in it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def marked(cell: int, held: list[tuple]) -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            at = alike([np.frombuffer(p, dtype=np.int32) for _, p in held])
            kept = Tree(at, num, den).candidates()
            return [(cell, held[k][0]) for k in np.flatnonzero(kept)]

        def packed(found: list) -> pa.RecordBatch:
            cell, uid = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int64()),
                                               "uid": pa.array(uid, pa.int64())})

        group, held = None, []
        for batch in parts:
            found: list = []
            for cell, uid, point in zip(*(values(batch, c) for c in ("cell", "uid", "point"))):
                if cell != group:
                    found += marked(group, held)
                    group, held = cell, []
                held.append((uid, point))
            yield packed(found)
        yield packed(marked(group, held))

    return run


def surviving(member: DataFrame, nodes: DataFrame, num: int, den: int,
              most_points: int) -> DataFrame:
    """The sets of every cell that the tree over the cell's points leaves a
    candidate; of a cell above ``most_points`` points all its sets."""
    sizes = member.groupBy("cell").agg(F.count("uid").alias("sets"))
    sized = stage(member.join(sizes.filter("sets > 1"), "cell"), "jaccard_members")
    few = sized.filter(F.col("sets") <= most_points).select("cell", "uid").join(
        nodes.select("uid", "point"), "uid")
    kept = (
        few.repartition(shuffle_partitions(member.sparkSession), "cell")
        .sortWithinPartitions("cell").mapInArrow(_mark(num, den), "cell long, uid long")
    )
    return stage(kept.unionByName(
        sized.filter(F.col("sets") > most_points).select("cell", "uid")), "jaccard_surviving")


def links(docs: DataFrame, nodes: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN,
          groups: int = GROUPS, most_sets: int = MOST_SETS, most_shingles: int = MOST_SHINGLES,
          most_points: int = MOST_POINTS) -> DataFrame:
    """Links ``a, b`` between distinct sets of ``docs`` (``id``, ``text``); two sets
    are connected by them exactly when a chain of linked sets connects them.
    ``nodes``: the distinct sets, as ``uid, n, point``."""
    member = cells(docs, words, num, den)
    member = member.unionByName(member.select("cell", F.col("cell").alias("uid")).distinct())
    member = surviving(member, nodes, num, den, most_points)
    wanted = docs.sparkSession.sparkContext.broadcast(
        membership_filter(member.select("uid").distinct()).tobytes())

    def chosen(parts):
        passes = np.frombuffer(wanted.value, dtype=np.uint8)
        return _sets(words, "sets", num, den, groups, passes)(parts)

    sets = stage(docs.mapInArrow(chosen, "uid long, content binary").groupBy("uid").agg(
        F.first("content").alias("content")), "jaccard_sets")
    member = member.join(nodes.select("uid", "n"), "uid")
    sizes = member.groupBy("cell").agg(F.count("uid").alias("sets"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("sets") / most_sets),
                        F.ceil(F.col("shingles") / most_shingles)).cast("long")
    sized = stage(member.join(sizes.select("cell", blocks.alias("blocks")), "cell"),
                  "jaccard_sized")
    dealt = F.pmod(F.xxhash64("uid", "cell"), F.col("blocks"))
    found = _in_trees(
        sized.select("cell", dealt.alias("block"), "uid").join(sets, "uid").select(
            "cell", "block", "uid", "content", F.col("uid").alias("label"),
            F.lit(True).alias("asks")),
        num, den, groups, "jaccard_links")
    large = sized.filter("blocks > 1")
    if large.isEmpty():
        return found
    return found.unionByName(
        _between_blocks(large, sets, found, num, den, groups, most_sets, most_shingles))


def _between_blocks(large: DataFrame, sets: DataFrame, found: DataFrame, num: int, den: int,
                    groups: int, most_sets: int, most_shingles: int) -> DataFrame:
    """Links between the blocks of large cells that still have several components.

    The sets outside a cell's largest component ask: they are dealt to askers'
    blocks, and each of these meets every block of the cell and every other
    askers' block."""
    labels = components(found).withColumnsRenamed({"node": "of", "label": "known"})
    now = stage(
        large.join(labels, F.col("uid") == F.col("of"), "left")
        .select("cell", "uid", "n", F.coalesce("known", "uid").alias("label")), "jaccard_open")
    parts = now.groupBy("cell", "label").agg(F.count("uid").alias("sets"), F.sum("n").alias("n"))
    best = Window.partitionBy("cell").orderBy(F.desc("sets"), "label")
    ranked = parts.withColumn("rank", F.row_number().over(best)).withColumn("main", F.col("rank") == 1)

    def blocks(of) -> F.Column:
        n = F.greatest(F.ceil(F.sum(F.when(of, F.col("sets")).otherwise(0)) * 2 / most_sets),
                       F.ceil(F.sum(F.when(of, F.col("n")).otherwise(0)) * 2 / most_shingles))
        return n.cast("long")

    plan = ranked.groupBy("cell").agg(
        F.max(F.when(F.col("main"), F.col("label"))).alias("main"),
        blocks(F.col("main")).alias("mains"), blocks(~F.col("main")).alias("others"),
    ).filter("others > 0")
    rows = now.join(plan, "cell").withColumn("asks", F.col("label") != F.col("main"))
    i = F.pmod(F.xxhash64("uid"), F.when(F.col("asks"), F.col("others")).otherwise(F.col("mains")))
    zero = F.lit(0).cast("long")
    others = F.sequence(zero, F.col("others") - 1)

    # trees of a cell: (asker's block, main block) and (asker's block, a later asker's block)
    def tree(x, y) -> F.Column:
        return x * (F.col("mains") + F.col("others")) + y

    as_asker = F.concat(
        F.transform(F.sequence(zero, F.col("mains") - 1), lambda m: tree(i, m)),
        F.transform(others, lambda o: tree(F.least(i, o), F.col("mains") + F.greatest(i, o))))
    placed = rows.withColumn("block", F.explode(
        F.when(F.col("asks"), as_asker).otherwise(F.transform(others, lambda o: tree(o, i)))))
    return _in_trees(
        placed.join(sets.select("uid", "content"), "uid").select(
            "cell", "block", "uid", "content", "label", "asks"),
        num, den, groups, "jaccard_between")


def jaccard_join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    num: int = NUM,
    den: int = DEN,
    groups: int = GROUPS,
    most_sets: int = MOST_SETS,
    most_shingles: int = MOST_SHINGLES,
    most_points: int = MOST_POINTS,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Documents link when ``den`` * shared >= ``num`` * united over their sets of
    distinct shingles of ``words`` words (fewer words: the whole sequence is the
    one shingle); ``component_id`` is the smallest id reachable over links, the
    row's own included.  Shingles and sets are compared by 64-bit hashes.  Null,
    empty and wordless texts have no shingles and link with nothing.  A very
    long text is one set, and its words are held by one task.  A null id takes
    part, and is the component's id only where all its ids are null.  Repeated
    rows and ids give a row each.  Other columns, whatever their names, are not
    read; an empty table gives no rows.
    """
    rows = id_text(df, id_col, text_col)
    docs = stage(rows.mapInArrow(_sets(words, "docs", num, den, groups),
                                 "id long, n long, uid long, point binary"), "jaccard_docs")
    nodes = stage(docs.filter("uid is not null").groupBy("uid").agg(
        F.min("id").alias("low"), F.min("n").alias("n"), F.min("point").alias("point")),
        "jaccard_nodes")
    labels = components(links(rows, nodes, words, num, den, groups, most_sets, most_shingles,
                              most_points)).select(F.col("node").alias("of"), "label")
    low = stage(nodes.join(labels, F.col("uid") == F.col("of"), "left").select(
        F.col("uid").alias("of"), "low", F.coalesce("label", "uid").alias("label")), "jaccard_low")
    least = low.groupBy("label").agg(F.min("low").alias("least"))
    named = stage(low.join(least, "label").select("of", "least"), "jaccard_named")
    return docs.join(named, F.col("uid") == F.col("of"), "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.when(F.col("uid").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))
