"""SimHash near-duplicates, searched by the generalised pigeonhole principle.

A text's fingerprint has a bit set where over half of its word shingles'
hashes have it set. Equal fingerprints collapse first. The bits are grouped
into partitions of correlated bits; partition i gets its own threshold t_i
with sum(t_i) = tau - partitions + 1, so two fingerprints within ``tau`` bits
differ by at most t_i bits in some partition i. Thresholds (and the number of
partitions) are allotted by dynamic programming on candidate counts estimated
from a bounded sample of fingerprints; the sample steers cost, never results.
Fingerprints are probed with every key within t_i of their partition's bits,
and verified by their full distance. Links go to connected components.

Rows travel with their fingerprint (or 128 bits of a longer one), so groups of
a key are compared where they meet. Keys that a task meets often are hot: they
are dealt into bounded parts, as :mod:`neighbours` says.

Edge cases: null, empty and wordless texts have fingerprint zero and link as
any other; texts of fewer words than a shingle are one shingle; rows that
occur twice share their id's class; rows with a null id keep their fingerprint
and have no class; an empty table gives an empty result; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import IdFilter, components, discard, materialize, only, pick, plain, prepare, release, sliced, spread_join
from .neighbours import as_groups, hot_links, payload_comparison, payload_links, sketch_comparison
from .paragraphs import jaccard
from .words import Words

#: Odd multipliers for fingerprints of more than 64 bits come from this stream (splitmix64).
_GOLDEN = 0x9E3779B97F4A7C15
SAMPLE = 2048
#: Keys that are counted together in a task, and how often a key must occur among them to count as frequent there.
COUNTED_KEYS = 1 << 22
FREQUENT = 8
#: Words of a long fingerprint that travel with its keys, and the most bits in which they may differ.
SKETCH, SKETCH_RADIUS = 2, 40
#: Rows of a group of a key: 40 bytes each.
GROUP = 4096


def _expanders(words: int) -> np.ndarray:
    """The ``words`` odd constants that turn a 64-bit hash into further words."""
    mask, out = (1 << 64) - 1, []
    for i in range(words):
        z = (_GOLDEN * (i + 1)) & mask
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append((z ^ (z >> 31)) | 1)
    return np.array(out, np.uint64)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``size`` lower-cased words, repeats included."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([digest(joined, 42)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *(ends[: len(words) - size]).tolist()]
    return np.array([digest(joined[a:z], 42) for a, z in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64)


def fingerprint(hashes: np.ndarray, expanders: np.ndarray | None = None) -> bytes:
    """Majority bits as little-endian bytes: 8, or 8 for each expander."""
    width = 64 if expanders is None else 64 * len(expanders)
    ones = np.zeros(width, np.int64)
    for at in range(0, len(hashes), 240):  # sums of 240 bits fit a byte
        h = hashes[at : at + 240, None]
        if expanders is not None:
            h = h * expanders
            h ^= h >> np.uint64(32)
            h *= np.uint64(_GOLDEN)
            h ^= h >> np.uint64(29)
        bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").tobytes()


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): every row's 64-bit fingerprint as a signed number."""
    import pyarrow as pa

    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in sliced(batches, 256):
            found = b"".join(fingerprint(shingle_hashes(t.encode() if t else b"", shingle)) for t in b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.frombuffer(found, "<i8").astype(np.int64))], names=["id", "fp"])

    rows = pick(docs, id=id, text=text)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


class Plan:
    """Bit groups, their thresholds, and the keys a fingerprint is probed with."""

    def __init__(self, groups: list[list[int]], thresholds: list[int]):
        self.groups, self.thresholds = groups, thresholds
        self.shifts = []
        for g, t in zip(groups, thresholds, strict=True):
            balls = [0] if t >= 0 else []
            for d in range(1, t + 1):
                balls += [sum(1 << b for b in c) for c in combinations(range(len(g)), d)]
            self.shifts.append(np.array(balls, np.uint64))

    def keys(self, bits: np.ndarray) -> np.ndarray:
        """One row of 64-bit keys per row of 0/1 bits; a key holds its partition's number."""
        out = []
        for i, (g, shifts) in enumerate(zip(self.groups, self.shifts, strict=True)):
            if len(shifts):
                own = bits[:, g].astype(np.uint64) @ (np.uint64(1) << np.arange(len(g), dtype=np.uint64))
                out.append((own[:, None] ^ shifts) | np.uint64(i << 48))
        return np.hstack(out)


def correlated_groups(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Deal bit positions into ``parts`` groups of nearly equal size, correlated bits together."""
    width = bits.shape[1]
    sizes = [width // parts + (i < width % parts) for i in range(parts)]
    centred = bits - bits.mean(axis=0) if len(bits) else np.zeros((1, width))
    spread = np.sqrt((centred**2).sum(axis=0))
    close = np.abs(centred.T @ centred) / np.maximum(np.outer(spread, spread), 1e-9)
    left, groups = set(range(width)), []
    for size in sizes:
        rest = sorted(left)
        group = [max(rest, key=lambda b: (close[b, rest].sum(), -b))]
        left.discard(group[0])
        gain = close[group[0]].copy()
        while len(group) < size:
            best = max(left, key=lambda b: (gain[b], -b))
            group.append(best)
            left.discard(best)
            gain += close[best]
        groups.append(sorted(group))
    return groups


def _ball(width: int, radius: int) -> int:
    total, term = 0, 1
    for d in range(radius + 1):
        total += term
        term = term * (width - d) // (d + 1)
    return total


def make_plan(sample: np.ndarray, total: int, tau: int, groupings: list[list[list[int]]], most: int) -> Plan:
    """The cheapest allocation for ``total`` fingerprints, judged by a sample of 0/1 bits.

    The cost of threshold t in a partition is its probe keys plus its expected
    candidate pairs; for every grouping of the bits, dynamic programming finds
    the cheapest thresholds from -1 (the partition is not probed) to ``most``
    with sum tau - partitions + 1.
    """
    best = None
    n = len(sample)
    pairs = max(1, n * (n - 1) // 2)
    for groups in groupings:
        costs = []
        for g in groups:
            part = sample[:, g].astype(np.float32)
            ones = part.sum(axis=1)
            far = ones[:, None] + ones[None, :] - 2 * part @ part.T
            near = [(int((far <= t).sum()) - n) / 2 for t in range(most + 1)]
            # pairs the sample has not seen count as chance would have them
            balls = [_ball(len(g), t) for t in range(most + 1)]
            rate = [max(near[t] / pairs, balls[t] / 2 ** len(g)) for t in range(most + 1)]
            costs.append([0.0] + [total * balls[t] * 8 + rate[t] * balls[t] * total * (total - 1) / 2 for t in range(most + 1)])
        table = {0: (0.0, [])}
        for c in costs:
            after = {}
            for s, (cost, chosen) in table.items():
                for t in range(-1, most + 1):
                    entry = (cost + c[t + 1], [*chosen, t])
                    if s + t not in after or entry < after[s + t]:
                        after[s + t] = entry
            table = after
        need = tau - len(groups) + 1
        if need in table and (best is None or table[need][0] < best[0]):
            best = (table[need][0], groups, table[need][1])
    return Plan(best[1], best[2])


def exact_plan(sample: np.ndarray, total: int, tau: int, parts: tuple[int, ...] = (2, 3)) -> Plan:
    """A plan that meets every pair of 64-bit fingerprints within ``tau`` bits."""
    return make_plan(sample, total, tau, [correlated_groups(sample.astype(np.float64), m) for m in parts], min(tau, 2))


def expected_recall(width: int, probes: int, bits: int = 1024, similarity: float = 0.8) -> float:
    """The share of pairs of a Jaccard ``similarity`` that ``probes`` partitions of ``width`` bits meet.

    Sets of equal size, the farthest case, differ in a share p = acos(2s / (1 + s)) / pi of the
    bits; the mean is over the binomial spread of that distance, taken as normal.
    """
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    z = np.linspace(-5, 5, 201)
    weight = np.exp(-z * z / 2)
    share = np.clip(p + z * np.sqrt(p * (1 - p) / bits), 0, 1)
    return float(1 - ((1 - (1 - share) ** width) ** probes * weight).sum() / weight.sum())


def wide_plan(sample: np.ndarray, total: int, spare: int = -2, seed: int = 5, recall: float = 0.99, similarity: float = 0.8) -> Plan:
    """A plan for long fingerprints and a large radius.

    Partitions have log2(total) + ``spare`` bits, so that an unrelated row
    meets about 2^-``spare`` others by a key at any size of the table (their
    sketches part them). The first round groups correlated bits, further rounds
    group the same bits anew, until there are as many partitions as it takes to
    meet pairs of ``similarity`` with a probability of ``recall``: wider
    partitions are met more seldom, so their number grows with the table.
    """
    bits = sample.shape[1]
    width = min(40, max(8, int(np.ceil(np.log2(max(total, 2)))) + spare))
    parts = bits // width
    needed = 1
    while expected_recall(int(np.ceil(bits / parts)), needed, bits, similarity) < recall:
        needed += 1
    groups = correlated_groups(sample.astype(np.float64), parts)
    rng = np.random.default_rng(seed)
    while len(groups) < needed:
        order = rng.permutation(bits)
        groups = groups + [sorted(order[i::parts].tolist()) for i in range(parts)]
    return Plan(groups[:needed], [0] * needed)


def _matrix(column) -> np.ndarray:
    """A row of 64-bit words for every fingerprint of an Arrow column, long or binary."""
    import pyarrow as pa

    if pa.types.is_int64(column.type):
        return column.to_numpy(zero_copy_only=False).reshape(-1, 1)
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(len(column), -1)


def _bits(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")


def key_rows(distinct: DataFrame, plan: Plan, words: int = 1) -> DataFrame:
    """(key, member, s0, s1, ...) for every fingerprint ``fp`` (long or binary), named by ``member``, and probe key; ``words`` words of it travel along."""
    import pyarrow as pa

    prepare(distinct.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                own = _matrix(b.column(0).slice(at, 1024))
                keys = plan.keys(_bits(own))
                each = np.repeat(np.arange(len(keys)), keys.shape[1])
                sketch = [pa.array(own[each, w]) for w in range(words)]
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), b.column(1).slice(at, 1024).take(pa.array(each)), *sketch], names=["key", "member", *(f"s{w}" for w in range(words))])

    return distinct.select("fp", "member").mapInArrow(run, "key long, member long, " + ", ".join(f"s{w} long" for w in range(words)))


def frequent_keys(distinct: DataFrame, plan: Plan, block: int) -> DataFrame:
    """Keys that more than ``block`` fingerprints have, as far as tasks meet them often.

    Tasks count their keys, ``COUNTED_KEYS`` at a time, and report those met
    ``FREQUENT`` times or more; so a key that is not among the result has at
    most ``block`` rows and fewer than ``FREQUENT`` more for every count made.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def often(held: list) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys[n >= FREQUENT].view(np.int64)), pa.array(n[n >= FREQUENT].astype(np.int64))], names=["key", "n"])

        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(plan.keys(_bits(_matrix(b.column(0)))).ravel())
            size += len(held[-1])
            if size >= COUNTED_KEYS:
                yield often(held)
                held, size = [], 0
        if held:
            yield often(held)

    return distinct.select("fp").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > block).select("key")


def sketch_links(distinct: DataFrame, plan: Plan, radius: int, words: int = 1, block: int = GROUP) -> DataFrame:
    """(key, a, b): links of fingerprints (fp, member) that share a key and differ in at most ``radius`` bits of their first ``words`` words."""
    sketch = [f"s{w}" for w in range(words)]
    compare = sketch_comparison(sketch, radius)
    rows = key_rows(distinct, plan, words)
    hot = materialize(frequent_keys(distinct, plan, block), "hot-keys")
    if hot.isEmpty():
        return compare(as_groups(rows))
    maybe, sure = IdFilter(hot, "key").split(rows, "key")
    cold = sure.unionByName(maybe.join(hot, "key", "left_anti"))
    dense = maybe.join(hot, "key", "left_semi").withColumn("weight", F.lit(1).cast("long"))
    found = hot_links(dense, sketch, sketch_comparison(sketch, radius, 1), block)
    return compare(as_groups(cold)).unionByName(found)


def planned(distinct: DataFrame, total: int, planner) -> Plan:
    """A plan by a bounded sample of the fingerprints, the least by a hash of every few."""
    every = max(1, total // (4 * SAMPLE))
    some = distinct.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow().column(0).combine_chunks()
    return planner(_bits(_matrix(some)), total)


def classes(prints: DataFrame, tau: int, block: int = GROUP) -> DataFrame:
    """(fp, component) of 64-bit fingerprints (id, fp long): the smallest id of all rows that can be reached over links.

    A fingerprint is its own name in the search, so rows of one id with
    several fingerprints are told apart.
    """
    distinct = materialize(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "distinct")
    total = distinct.count()
    if total < 2:
        return distinct.select("fp", F.col("rep").alias("component"))
    named = distinct.select("fp", F.col("fp").alias("member"))
    plan = planned(named, total, lambda sample, n: exact_plan(sample, n, tau))
    groups = components(sketch_links(named, plan, tau, 1, block))
    linked = distinct.join(groups, distinct.fp == groups.node).select("fp", "rep", F.col("component").alias("c"))
    least = linked.groupBy("c").agg(F.min("rep").alias("component"))
    linked = spread_join(linked, least, "c").select("fp", "component")
    return distinct.join(linked, "fp", "left").select("fp", F.coalesce("component", "rep").alias("component"))


def near_duplicates(spark: SparkSession, docs: DataFrame, tau: int = 2, shingle: int = 3, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, component) for every row of ``docs``, fingerprints as signed 64-bit numbers; a null id has no component."""
    prepare(spark)
    prints = materialize(fingerprints(docs, id, text, shingle), "fingerprints")
    found = spread_join(prints, classes(prints, tau), "fp", "left")
    return found.select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))


def simhash_classes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id): 3-word shingles, links at two bits or fewer."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_duplicates(spark, docs).select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").cast("long").alias("component_id"))


def text_prints(docs: DataFrame, shingle: int, bits: int) -> DataFrame:
    """(id, body, c0, c1, fp) from (id, body, text): a digest of each text's lower-cased words and the fingerprint of its distinct shingles."""
    import pyarrow as pa

    prepare(docs.sparkSession)
    expanders = _expanders(bits // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in sliced(batches, 256):
            words = Words(b.column(2).to_pylist())
            first, last = words.firsts[:-1], words.firsts[1:]
            digests = [pa.array(runs.ranges(first, last).view(np.int64)) for runs in words.runs]
            found = [fingerprint(s, expanders) for s in words.shingle_sets(first, last, shingle)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *digests, pa.array(found, pa.binary())], names=["id", "body", "c0", "c1", "fp"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, body long, c0 long, c1 long, fp binary")


def text_shingles(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(key, member, payload): shingle sets of the texts (id, body, text) that ``wanted`` (id, body, key, member) names, once for every row that holds one."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 256):
            words = Words(b.column(0).to_pylist())
            sets = words.shingle_sets(words.firsts[:-1], words.firsts[1:], shingle)
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "member", "payload"])

    some = IdFilter(wanted, "id").maybe(docs, "id").join(wanted, ["id", "body"])
    return some.select("text", "key", "member").mapInArrow(run, "key long, member long, payload binary")


def similar_texts(spark: SparkSession, docs: DataFrame, similarity: float, shingle: int, bits: int, id: str, text: str) -> DataFrame:
    """(id, body, root) of the texts with an id that have a class: ``root`` (id, body) is the least that links of exact similarity reach.

    ``body`` is a hash of the text, so that texts of one id are told apart.
    Fingerprints that meet by a key and have close sketches only say which
    texts are compared: texts of a component of such pairs are compared by the
    exact Jaccard similarity of their shingle sets.
    """
    rows = pick(docs, id=id, text=text).where("id is not null").withColumn("body", F.xxhash64("text")).select("id", "body", "text")
    prints = materialize(text_prints(rows, shingle, bits), "prints")
    place = F.struct("id", "body")
    distinct = materialize(prints.groupBy("c0", "c1").agg(F.min(F.struct("id", "body", "fp")).alias("least"), F.count(F.lit(1)).alias("copies")).select(F.col("c0").alias("member"), "c1", "least.*", "copies"), "distinct")
    total = distinct.count()
    copied = distinct.where("copies > 1").select("member", "c1", place.alias("root"))
    if total > 1:
        plan = planned(distinct, total, lambda sample, n: wide_plan(sample, n, similarity=similarity))
        near = components(sketch_links(distinct.select("fp", "member"), plan, SKETCH_RADIUS, SKETCH))
        groups = materialize(distinct.join(near, distinct.member == near.node).select("member", "c1", "id", "body", F.col("component").alias("key")), "groups")
        sets = materialize(text_shingles(rows, groups.select("id", "body", "key", "member"), shingle), "sets")
        found = components(payload_links(sets, payload_comparison(jaccard(similarity))))
        linked = groups.join(found, groups.member == found.node).select("member", "c1", "component", place.alias("own"))
        roots = linked.groupBy("component").agg(F.min("own").alias("root"))
        linked = materialize(spread_join(linked, roots, "component").select("member", "c1", "root"), "linked")
        copied = linked.unionByName(copied.join(linked, ["member", "c1"], "left_anti"))
        discard(sets, groups)
    named = prints.select("id", "body", F.col("c0").alias("member"), "c1")
    classed = only(named, copied.select("member").distinct(), "member")
    out = materialize(classed.join(copied, ["member", "c1"]).select("id", "body", "root"), "classed")
    discard(prints, distinct)
    return out


def keep_one(spark: SparkSession, docs: DataFrame, similarity: float = 0.8, shingle: int = 5, bits: int = 1024, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, without near copies: of a class the smallest id stays.

    Links are pairs whose sets of five-word shingles have an exact Jaccard
    similarity of ``similarity`` or more. Pairs of 0.8 have sketches 19 bits of
    128 apart on average (deviation 4), and 24 where texts are a few shingles
    long; the radius of 40 is far beyond, and unrelated sketches differ in 64.
    Of rows with the same id and text one stays; texts of one id that are not
    alike all stay; null ids stay.
    """
    prepare(spark)
    rows, names = plain(docs)
    own, body = f"c{names.index(id)}", f"c{names.index(text)}"
    found = similar_texts(spark, rows, similarity, shingle, bits, own, body)
    gone = materialize(found.where("id <> root.id OR body <> root.body").select(F.col("id").alias("gone"), F.col("body").alias("gone_body")).distinct(), "removed")
    marked = rows.withColumn("body", F.xxhash64(body))
    twice = marked.where(F.col(own).isNotNull()).groupBy(F.col(own).alias("gone"), "body").count().where("count > 1").select("gone")
    # texts of rows that stay for certain are not shuffled
    maybe, sure = IdFilter(gone.select("gone").union(twice), "gone").split(marked, own)
    left = maybe.join(gone, (maybe[own] == gone["gone"]) & (maybe["body"] == gone["gone_body"]), "left_anti")
    rank = F.row_number().over(Window.partitionBy(own, "body").orderBy(body))
    once = left.where(F.col(own).isNotNull()).withColumn("rank", rank).where("rank = 1").drop("rank")
    return sure.unionByName(once).unionByName(left.where(F.col(own).isNull())).drop("body").toDF(*names)


def sign_classes(spark: SparkSession, vectors: DataFrame, bits: int = 24, tau: int = 2) -> DataFrame:
    """(vec_id, component_id): classes of given fingerprints, the signs of a vector's first ``bits`` components."""
    prepare(spark)
    rows = pick(vectors, id="vec_id", v="embedding").where(F.size("v") >= bits)
    fp = F.aggregate(F.transform(F.slice("v", 1, bits), lambda x, i: F.when(x > 0, F.shiftleft(F.lit(1).cast("long"), 0) * F.pow(F.lit(2.0), i).cast("long")).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)
    prints = materialize(rows.select("id", fp.alias("fp")), "signs")
    return spread_join(prints, classes(prints, tau), "fp", "left").select(F.col("id").alias("vec_id"), F.col("component").alias("component_id"))


#: DuckDB: all pairs of sign fingerprints, and what links reach.
SIGN_SQL = """
WITH RECURSIVE prints AS (
  SELECT vec_id, CAST(list_sum(list_transform(range(24), lambda i: CASE WHEN embedding[i + 1] > 0 THEN 1 << i ELSE 0 END)) AS BIGINT) AS fp FROM embeddings WHERE len(embedding) >= 24 AND vec_id IS NOT NULL),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM prints a JOIN prints b ON bit_count(xor(a.fp, b.fp)) <= 2),
reach(id, other) AS (SELECT a, b FROM links UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a)
SELECT id AS vec_id, min(other) AS component_id FROM reach GROUP BY id
"""
