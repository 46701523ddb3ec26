"""Rows that share a key: compared inside bounded groups, only links leave.

Used by every operator that finds similar rows by shared keys. Rows are
(key, part, member, payload...); a group is the rows of one (key, part), and a
comparison turns groups into links (key, a, b) between members. Small keys are one part.
The rows of a hot key are dealt into parts of about ``block`` weight (a row's
weight is its payload's bytes, or one) and linked there; then one representative of every component found so far is dealt anew,
until a key's representatives fit one part or fall by less than half, when
they are compared each with each, part by part. What is left are rows outside
a key's largest component, which are compared with all rows of the key. So a key that a third of all rows share, most
of which are alike, costs little more than its rows, and no link is lost.

A group emits its close pairs where it is very small, and else a spanning
forest of them (fewer links than members), never all its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, components, discard, materialize, prepare, spread_join

#: Bytes of payloads in a part of a hot key, and the least that a row counts.
BLOCK = 4 << 20
LEAST = 1 << 10
#: Groups of at most so many rows are compared as pairs at growing distance, all groups of a batch at once.
FEW = 16

Relation = Callable[[list], Callable[[int], np.ndarray]]
Comparison = Callable[[DataFrame], DataFrame]


class Forest:
    """Union-find over positions 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def whole_groups(batches: Iterator) -> Iterator[tuple]:
    """(table, starts): rows of whole groups, which a partition sorted by (key, part) holds as runs, and where they start."""
    import pyarrow as pa

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        key, part = table.column(0).to_numpy(), table.column(1).to_numpy()
        change = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        if len(change):
            yield table.slice(0, int(change[-1])), np.concatenate([[0], change[:-1]])
            table = table.slice(int(change[-1]))
        held = table.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks(), np.zeros(1, np.int64)


def forest(member: np.ndarray, leading: int, linked: Callable[[int], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links from the least member of each tree that the ``leading`` members' links span."""
    n = len(member)
    trees, joined = Forest(n), 0
    for i in range(min(leading, n - 1)):
        if joined == n - 1:  # all are linked
            break
        for j in np.flatnonzero(linked(i)):
            joined += trees.join(i, i + 1 + int(j))
    tops = np.array([trees.find(i) for i in range(n)])
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, tops, member)
    a = least[tops]
    return a[a != member], member[a != member]


def _led(member: np.ndarray, stray: np.ndarray) -> tuple[np.ndarray, int]:
    """Positions of a group's distinct members, strays first, and how many are strays."""
    order = np.lexsort((~stray, member))
    order = order[np.concatenate([[True], member[order][1:] != member[order][:-1]])]
    order = order[np.argsort(~stray[order], kind="stable")]
    return order, int(stray[order].sum())


def _dealt(rows: DataFrame, payload: list[str]) -> DataFrame:
    prepare(rows.sparkSession)
    return rows.select("key", "part", "member", "stray", *payload).repartition("key", "part").sortWithinPartitions("key", "part")


def sketch_comparison(words: list[str], radius: int, few: int = FEW) -> Comparison:
    """Links between rows whose ``words`` (long columns, a fingerprint) differ in at most ``radius`` bits; as stars in groups of more than ``few``."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            n = table.num_rows
            member, stray = table.column(2).to_numpy(), table.column(3).to_numpy(zero_copy_only=False)
            bits = np.column_stack([table.column(4 + i).to_numpy() for i in range(len(words))]).view(np.uint64)
            sizes = np.diff(np.append(starts, n))
            group = np.repeat(np.arange(len(starts)), sizes)
            small = sizes <= few
            left = np.flatnonzero(small[group])
            k, a, b = [], [], []
            key = table.column(0).to_numpy()
            for far in range(1, few):
                left = left[left < n - far]
                left = left[group[left] == group[left + far]]
                if not len(left):
                    break
                near = (np.bitwise_count(bits[left] ^ bits[left + far]).sum(axis=1) <= radius) & (stray[left] | stray[left + far])
                k.append(key[left[near]])
                a.append(member[left[near]])
                b.append(member[left[near] + far])
            for g in np.flatnonzero(~small & (sizes > 1)):
                own = slice(starts[g], starts[g] + sizes[g])
                order, leading = _led(member[own], stray[own])
                mine = bits[own][order]
                x, y = forest(member[own][order], leading, lambda i, mine=mine: np.bitwise_count(mine[i + 1 :] ^ mine[i]).sum(axis=1) <= radius)
                k.append(np.full(len(x), key[starts[g]]))
                a.append(x)
                b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (k, a, b)], names=["key", "a", "b"])

    return lambda rows: _dealt(rows, words).mapInArrow(run, "key long, a long, b long").where("a <> b")


def payload_comparison(relate: Relation) -> Comparison:
    """Links between rows by their ``payload``: ``relate(payloads)`` says for number i which later ones are linked to it."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches):
            member, stray, payload = table.column(2).to_numpy(), table.column(3).to_numpy(zero_copy_only=False), table.column(4)
            k, a, b = [], [], []
            key = table.column(0).to_numpy()
            for start, stop in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
                if stop - start < 2:
                    continue
                order, leading = _led(member[start:stop], stray[start:stop])
                x, y = forest(member[start:stop][order], leading, relate([payload[int(start + i)].as_buffer() for i in order]))
                k.append(np.full(len(x), key[start]))
                a.append(x)
                b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (k, a, b)], names=["key", "a", "b"])

    return lambda rows: _dealt(rows, ["payload"]).mapInArrow(run, "key long, a long, b long").where("a <> b")


def as_groups(rows: DataFrame) -> DataFrame:
    """Rows of keys that are small enough to be one group each."""
    return rows.withColumns({"part": F.lit(0).cast("long"), "stray": F.lit(True)})


def _weights(rows: DataFrame) -> DataFrame:
    """(key, n, rows): every key's weight and number of rows."""
    return rows.groupBy("key").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("rows"))


def _parted(rows: DataFrame, sizes: DataFrame, block: int, salt: int) -> DataFrame:
    """Rows of the keys in ``sizes`` (key, n), dealt into parts by a hash."""
    part = F.pmod(F.xxhash64("member", F.lit(salt)), F.ceil(F.col("n") / block))
    return spread_join(rows, sizes.select("key", "n"), "key").withColumns({"part": part, "stray": F.lit(True)}).drop("n")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (key, label, ...) after stars (key, a, b) between labels: the star's centre instead of ``b``."""
    moved = links.select("key", F.col("b").alias("label"), F.col("a").alias("to")).distinct()
    return spread_join(labels, moved, ["key", "label"], "left").withColumn("label", F.coalesce("to", "label")).drop("to")


def _crossed(rows: DataFrame, block: int, salt: int) -> DataFrame:
    """Parts in which every stray of a key meets every row of the key; ``rows`` have a flag ``stray``."""
    strayed = F.sum(F.when(F.col("stray"), F.col("weight")).otherwise(0))
    sizes = rows.groupBy("key").agg(F.ceil(F.sum("weight") / block).alias("all_parts"), F.ceil(strayed / block).alias("stray_parts")).where("stray_parts > 0")
    sized = spread_join(rows, sizes, "key")
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    strays = sized.where("stray").withColumns({"i": upto("all_parts"), "j": F.pmod(F.xxhash64("member", F.lit(salt)), "stray_parts")})
    others = sized.withColumns({"i": F.pmod(F.xxhash64("member", F.lit(salt + 1)), "all_parts"), "j": upto("stray_parts"), "stray": F.lit(False)})
    return strays.unionByName(others).withColumn("part", F.col("j") * F.col("all_parts") + F.col("i"))


def hot_links(rows: DataFrame, payload: list[str], compare: Comparison, block: int = BLOCK) -> DataFrame:
    """Links (key, a, b) that connect what pairwise comparison of every key's rows (key, member, weight, payload) connects.

    ``compare`` gives stars around a tree's least member. As long as parts have
    no rows in common, a star's centre is the label of its rows.
    """
    rows = materialize(rows.select("key", "member", "weight", *payload), "hot")
    links = new = materialize(compare(_parted(rows, _weights(rows), block, 0)), "hot-links")
    labels, salt, before, last = rows.withColumn("label", F.col("member")), 0, None, False
    while True:
        salt += 1
        stale, labels = labels, materialize(_relabelled(labels, new), "labels")
        discard(rows if salt == 1 else stale)
        if last:
            break
        reps = labels.where("member = label").drop("label")
        sizes = materialize(_weights(reps).where("rows > 1"), "sizes")
        most, left = sizes.agg(F.max("n"), F.sum("n")).first()
        if most is None:  # every key is one component
            discard(labels)
            return links
        # while representatives fall by half, a part of them at a time; at last each with each
        last = most <= block or (before is not None and left > before / 2)
        before = left
        if last and most > block:
            found = materialize(compare(_crossed(reps.join(sizes.select("key"), "key").withColumn("stray", F.lit(True)), block, salt)), "hot-links")
            joined = components(found)
            new = reps.select("key", F.col("member").alias("b")).join(joined, F.col("b") == joined.node).select("key", F.col("component").alias("a"), "b")
        else:
            found = new = materialize(compare(_parted(reps, sizes, block, salt)), "hot-links")
        links = links.unionByName(found)
    counts = labels.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    main = counts.groupBy("key").agg(F.max(F.struct("c", "label")).alias("main"), F.sum("c").alias("n")).where("main.c < n").select("key", F.col("main.label").alias("main"))
    main = materialize(main, "main")
    if main.isEmpty():
        discard(labels)
        return links
    apart = labels.join(main, "key").withColumn("stray", F.col("label") != F.col("main")).drop("label", "main")
    found = materialize(compare(_crossed(apart, block, salt + 2)), "hot-links")
    discard(labels)
    return links.unionByName(found)


def counted(rows: DataFrame) -> DataFrame:
    """Distinct (key, member) rows of keys with two members or more."""
    return spread_join(rows, rows.groupBy("key").count().where("count > 1").select("key"), "key")


def key_links(rows: DataFrame, compare: Comparison, payloads: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links of ``rows`` (key, member), a table, whose payloads (member, payload) come by a join."""
    weight = F.greatest(F.octet_length("payload"), F.lit(LEAST)).cast("long")
    heavy = _weights(rows.join(payloads.select("member", weight.alias("weight")), "member")).where(F.col("n") > block).select("key")
    heavy = materialize(heavy, "hot-keys")
    if heavy.isEmpty():
        return compare(as_groups(rows.join(payloads, "member")))
    cold = compare(as_groups(rows.join(heavy, "key", "left_anti").join(payloads, "member")))
    hot = rows.join(heavy, "key", "left_semi").join(payloads.withColumn("weight", weight), "member")
    return cold.unionByName(hot_links(hot, ["payload"], compare, block))


def payload_links(rows: DataFrame, compare: Comparison, block: int = BLOCK) -> DataFrame:
    """Links of ``rows`` (key, member, payload), a table: payloads are shuffled once, to their groups. Rows may occur twice."""
    sized = rows.withColumn("weight", F.greatest(F.octet_length("payload"), F.lit(LEAST)).cast("long"))
    heavy = materialize(_weights(sized).where(F.col("n") > block).select("key"), "hot-keys")
    if heavy.isEmpty():
        return compare(as_groups(rows))
    maybe, sure = IdFilter(heavy, "key").split(sized, "key")
    cold = compare(as_groups(sure.unionByName(maybe.join(heavy, "key", "left_anti"))))
    hot = maybe.join(heavy, "key", "left_semi").dropDuplicates(["key", "member"])
    return cold.unionByName(hot_links(hot, ["payload"], compare, block))
