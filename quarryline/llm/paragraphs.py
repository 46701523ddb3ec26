"""Substring dedup: paragraph MinHash banding with exact verification.

Paragraphs are of two kinds. A line of a text is one (short lines that follow
each other are one together): it gets a MinHash signature over its five-word
shingles, cut into bands that :func:`tune` chooses for high recall; lines that
share a band meet in bounded groups, where the exact Jaccard similarity of
their shingle sets decides; links are clustered into components. Of each
component the first line (smallest document id, then place) stays and the
others repeat it. Repeats that follow each other in a text are a run, and runs
of at least ``min_run`` words are removals, given as spans of the original
text: a passage over several lines goes as a whole, while a single short line
that many texts share, such as a greeting, is no repeated passage.

Every run of ``PASSAGE`` words of a text is a sliding paragraph too, whatever
its line ends, so that passages inside longer lines are found. Its signature
is one MinHash over its shingles of ``ANCHOR`` words, a band of one row, so
equal runs collide for certain; neighbouring runs mostly share their minimum,
which is stored once. The runs that share a minimum at one place are a block,
and blocks whose minimum occurs twice are compared: those of the same words (by
128 bits) repeat the first of them (smallest document id, then word), all runs
at once; only where one minimum stands in blocks of different words, as at the
ends of a repeated passage, the runs of one of each are compared one by one.
Every run that stands at an earlier place too is a repeat, and repeats of one
keeper that touch are clustered to one span.

Both kinds come from one scan of the texts. Texts of the same words as one of
a smaller id are left out of the searches: their lines and passages are known
from the first one.

Edge cases: lines of fewer than ``min_words`` words are joined to the short ones
next to them; where these have too few words too, they are never removed and
neither break nor lengthen a run; null and empty texts have none; rows with a
null id are left as they are; of rows that occur twice (same id and text) the
paragraphs count once and are removed or kept in both; an empty table has no
removals; other columns are carried through whatever their names. Lines are
named by 64 bits of hash in the search and by 128 where equality decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import IdFilter, components, delete_path, discard, materialize, only, pick, plain, prepare, release, sliced, spread_join, without
from .neighbours import payload_comparison, payload_links
from .words import Words, mix

SHINGLE = 5
SIMILARITY = 0.8
MIN_WORDS = 8
MIN_RUN = 30
PERMUTATIONS = 27
PASSAGE = 50
ANCHOR = 25
#: Texts of a slice of a batch.
SLICE = 128
LINE, TEXT = 0, 1
#: Bits of a key that are counted (chance leaves one key of a thousand in where 10^9 are counted), bits that name its bucket, and keys that a task sorts at a time.
KEY_BITS, BUCKET_BITS = 40, 10
SORTED_KEYS = 1 << 20


def tune(permutations: int = PERMUTATIONS, similarity: float = SIMILARITY, recall: float = 0.995) -> tuple[int, int]:
    """(bands, rows): the most selective banding whose recall at ``similarity`` suffices."""
    for rows in range(permutations, 0, -1):
        bands = permutations // rows
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    return permutations, 1


class Lines:
    """The paragraphs of a slice: lines, and short ones that follow each other as one (blank ones left aside), with ``min_words`` words."""

    def __init__(self, words: Words, min_words: int = MIN_WORDS):
        counts = np.bincount(words.lines, minlength=len(words.line_ends))
        line = np.flatnonzero(counts)
        text = np.searchsorted(words.first_lines, line, side="right") - 1
        long = counts[line] >= min_words
        apart = np.ones(len(line), bool)
        apart[1:] = long[1:] | long[:-1] | (text[1:] != text[:-1])
        head = np.flatnonzero(apart)
        tail = np.append(head[1:], len(line)) - 1
        past = np.cumsum(counts)
        size = past[line[tail]] - past[line[head]] + counts[line[head]] if len(head) else np.zeros(0, np.int64)
        head, tail, size = head[size >= min_words], tail[size >= min_words], size[size >= min_words]
        #: Text, words first to last (excluded), and line number in the text.
        self.text = text[head]
        self.last = past[line[tail]]
        self.first = self.last - size
        self.place = line[head] - words.first_lines[self.text]
        begin = np.where(line[head] > 0, words.line_ends[line[head] - 1] + 1, 0)
        self.start = words.offsets(self.text, begin)
        self.stop = words.offsets(self.text, words.line_ends[line[tail]])
        #: The paragraph's number in its text.
        self.turn = np.arange(len(head)) - np.searchsorted(self.text, self.text)


def band_keys(shingles: np.ndarray, first: np.ndarray, stop: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One row of 64-bit band keys per range of shingle hashes, none empty: minima of ``bands * rows`` hash functions."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.append(low, np.uint32(0))  # where the last range stops
    cuts = np.column_stack([first, stop]).ravel()
    salts = (mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    out = np.empty((len(first), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(first), b, np.uint64)
        for r in range(rows):
            least = np.minimum.reduceat(low * salts[b * rows + r], cuts)[::2]
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least)
        out[:, b] = key
    return out


def sliding_minima(values: np.ndarray, span: int) -> np.ndarray:
    """The place of the least of every ``span`` consecutive values (by their upper 40 bits, the first of equals)."""
    n = len(values) - span + 1
    mask = np.uint64((1 << 24) - 1)
    keys = (values & ~mask) | np.arange(len(values), dtype=np.uint64)
    room = -len(keys) % span
    blocks = np.append(keys, np.full(room, np.iinfo(np.uint64).max)).reshape(-1, span)
    # a window is the end of one block and the beginning of the next
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    return (np.minimum(after[:n], before[span - 1 : span - 1 + n]) & mask).astype(np.int64)


def anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first word, hash) of the least run of ``ANCHOR`` words in every ``PASSAGE`` words of one text, and the first and last word where those begin."""
    n = len(words.hashes)
    if n < PASSAGE:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs = words.runs[0].fixed(ANCHOR)
    own = np.flatnonzero(words.owner[: n - PASSAGE + 1] == words.owner[PASSAGE - 1 :])
    least = sliding_minima(runs, PASSAGE - ANCHOR + 1)[own]
    heads = np.flatnonzero(np.append(True, least[1:] != least[:-1])) if len(least) else np.zeros(0, np.int64)
    tails = np.append(heads[1:], len(least)) - 1 if len(heads) else heads
    return least[heads], runs[least[heads]], own[heads], own[tails]


def scan(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Lines and texts of (id, text): (id, place, turn, words, start, stop, g, h, keys, ats, kind).

    A line has its band keys in ``keys``; a text of ``PASSAGE`` words or more
    its anchors there and their first words in ``ats``, and spans its first to
    its last word. ``g`` and ``h`` are hashes of all words.
    """
    import pyarrow as pa

    prepare(docs.sparkSession)
    names = ["id", "place", "turn", "words", "start", "stop", "g", "h", "keys", "ats", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in sliced(batches, SLICE):
            words = Words(b.column(1).to_pylist())
            if not len(words.hashes):
                continue

            def batch(text, first, last, place, turn, start, stop, keys, ends, ats, kind, b=b, words=words) -> pa.RecordBatch:
                numbers = [pa.array(x.astype(np.int32)) for x in (place, turn, last - first, start, stop)]
                hashes = [pa.array(r.ranges(first, last).view(np.int64)) for r in words.runs]
                ends = pa.array(ends.astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(keys.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(ats.astype(np.int32)))]
                return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(text)), *numbers, *hashes, *lists, pa.array(np.full(len(text), kind, np.int32))], names=names)

            lines = Lines(words)
            if len(lines.text):
                short = lines.last - lines.first < SHINGLE
                if short.any():
                    raise ValueError("a line must hold a shingle")
                keys = band_keys(words.runs[0].fixed(SHINGLE), lines.first, lines.last - SHINGLE + 1, bands, rows).ravel()
                ends = np.arange(len(lines.text) + 1) * bands
                yield batch(lines.text, lines.first, lines.last, lines.place, lines.turn, lines.start, lines.stop, keys, ends, np.zeros(len(keys)), LINE)
            at, found, _, _ = anchors(words)
            text = np.flatnonzero(words.counts >= PASSAGE)
            if len(text):
                first, last = words.firsts[text], words.firsts[text + 1]
                ends = np.append(np.searchsorted(at, first), len(at))
                start, stop = words.starts[first], words.stops[last - 1]
                place = words.lines[first] - words.first_lines[text]
                yield batch(text, first, last, place, np.zeros(len(text)), words.offsets(text, start), words.offsets(text, stop), found, ends, at - words.firsts[words.owner[at]], TEXT)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, place int, turn int, words int, start int, stop int, g long, h long, keys array<long>, ats array<int>, kind int")


def line_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(keys, member, payload): shingle sets of the lines that ``wanted`` (id, lines of place, member and keys) names, once for every row that holds one."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, SLICE):
            words = Words(b.column(0).to_pylist())
            lines = Lines(words)
            if not len(lines.text):
                continue
            named = words.runs[0].ranges(lines.first, lines.last).view(np.int64)
            asked = [{(x["place"], x["member"]): x["keys"] for x in a} for a in b.column(1).to_pylist()]
            keys = [asked[t].get((p, m)) for t, p, m in zip(lines.text.tolist(), lines.place.tolist(), named.tolist(), strict=True)]
            here = np.array([k is not None for k in keys])
            sets = words.shingle_sets(lines.first[here], lines.last[here], SHINGLE)
            keys = pa.array([k for k in keys if k is not None], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, pa.array(named[here]), pa.array([s.tobytes() for s in sets], pa.binary())], names=["keys", "member", "payload"])

    wanted = materialize(wanted, "wanted")
    # only texts that may be asked for are shuffled
    some = IdFilter(wanted, "id").maybe(docs, "id").join(wanted, "id").select("text", "lines")
    return some.mapInArrow(run, "keys array<long>, member long, payload binary")


def jaccard(similarity: float):
    """Which later shingle sets of a group are similar enough to its set i."""

    def relate(payloads: list):
        sets = [np.frombuffer(p, np.uint64) for p in payloads]
        sizes = np.array([len(s) for s in sets])
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)

        def linked(i: int) -> np.ndarray:
            mark = np.zeros(len(distinct) + 1, np.int64)
            mark[codes[firsts[i] : firsts[i] + sizes[i]]] = 1
            rest = firsts[i] + sizes[i]
            upto = np.concatenate([[0], np.cumsum(mark[codes[rest:]])])
            both = upto[firsts[i + 1 :] + sizes[i + 1 :] - rest] - upto[firsts[i + 1 :] - rest]
            return both >= similarity * (sizes[i + 1 :] + sizes[i] - both)

        return linked

    return relate


def packed_keys(keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, data) of ascending keys of ``KEY_BITS``: every bucket's steps from key to key, byte by byte of equal worth."""
    low = KEY_BITS - BUCKET_BITS
    bucket = (keys >> np.uint64(low)).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else np.zeros(0, np.int64)
    for start, stop in zip(cuts, np.append(cuts[1:], len(keys)), strict=True):
        steps = np.diff(keys[start:stop], prepend=np.uint64(bucket[start] << low))
        # small steps leave the upper bytes zero, which shuffles compress to nothing
        yield int(bucket[start]), steps.view(np.uint8).reshape(-1, 8)[:, : -(-low // 8)].T.tobytes()


def unpacked_keys(bucket: int, data: bytes) -> np.ndarray:
    low = KEY_BITS - BUCKET_BITS
    planes = np.frombuffer(data, np.uint8).reshape(-(-low // 8), -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, : len(planes)] = planes.T
    return np.cumsum(steps.view(np.uint64).ravel()) + np.uint64(bucket << low)


def different(met: DataFrame) -> DataFrame:
    """The distinct rows (key, member) of one key for every set of two members or more: sets that share many bands are compared once."""
    digests = [F.bit_xor(F.xxhash64("member", F.lit(salt))).alias(f"d{salt}") for salt in (0, 1)]
    sets = met.groupBy("key").agg(*digests, F.count(F.lit(1)).alias("n")).where("n > 1")
    return spread_join(met, sets.groupBy("d0", "d1", "n").agg(F.min("key").alias("key")).select("key"), "key")


def repeated(lists: DataFrame) -> DataFrame:
    """(key): the keys, cut to ``KEY_BITS``, that occur twice or more in a column of lists of longs.

    A task sends every key once, or twice where it met it more often, as the
    step from the one before it in its bucket: about three bytes a key, while a
    row with a count takes twelve. A bucket is looked at as a whole.
    """
    import pyarrow as pa

    mask = np.uint64((1 << KEY_BITS) - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def sent() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            bucket, data = zip(*packed_keys(np.repeat(keys, np.minimum(n, 2))), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(data, pa.binary())], names=["bucket", "data"])

        for b in batches:
            for at in range(0, b.num_rows, 4096):
                keys = b.column(0).slice(at, 4096).flatten().to_numpy(zero_copy_only=False).view(np.uint64) & mask
                if len(keys):
                    held.append(keys)
                    size += len(keys)
                if size >= SORTED_KEYS:
                    yield sent()
                    held, size = [], 0
        if held:
            yield sent()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def twice(bucket: int, held: list) -> pa.RecordBatch:
            keys = np.sort(np.concatenate([unpacked_keys(bucket, x) for x in held]))
            return pa.RecordBatch.from_arrays([pa.array(np.unique(keys[1:][keys[1:] == keys[:-1]]).view(np.int64))], names=["key"])

        last, held = None, []
        for b in batches:
            for bucket, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if held and bucket != last:
                    yield twice(last, held)
                    held = []
                last = bucket
                held.append(data)
        if held:
            yield twice(last, held)

    prepare(lists.sparkSession)
    return lists.mapInArrow(send, "bucket int, data binary").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "key long")


def shared(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """The rows (key, ...) whose key, cut to ``KEY_BITS``, occurs twice or more; ``lists`` holds the rows' keys as one column of lists."""
    # rows with a key of their own go before they are shuffled
    twice = materialize(repeated(lists), "shared-keys")
    return only(rows.withColumn("key", F.col("key").bitwiseAND(F.lit((1 << KEY_BITS) - 1))), twice, "key")


class Found:
    """One scan of ``docs``, and what both searches take from it."""

    def __init__(self, spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY):
        prepare(spark)
        self.docs = pick(docs, id=id, text=text).where("id is not null")
        self.similarity = similarity
        self.rows = materialize(scan(self.docs, *tune(similarity=similarity)), "scan", by="kind")
        texts = self.texts = self.rows.where(F.col("kind") == TEXT)
        # texts of the same words are compared by one of them; an id of several texts is compared by all
        same = texts.groupBy("g", "h").agg(F.min(F.struct("id", "place")).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("g", "h", "first")
        several = texts.groupBy("id").agg(F.min("g").alias("one"), F.max("g").alias("other")).where("one <> other").select("id")
        copies = texts.select("id", "place", "start", "stop", "words", "g", "h").distinct().join(same, ["g", "h"]).where(F.col("id") != F.col("first.id")).join(several, "id", "left_anti")
        self.copies = materialize(copies.select("id", "place", "start", "stop", F.col("words").alias("length"), F.col("first.id").alias("keeper_id"), F.col("first.place").alias("keeper_place")), "copies")
        self.copied = self.copies.select("id").distinct()
        self.lines = self.rows.where(F.col("kind") == LINE).drop("ats", "kind")


def removals(spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, min_run: int = MIN_RUN, found: Found | None = None) -> DataFrame:
    """(id, place, start, stop, length, keeper_id, keeper_place) of every repeated line in a run of ``min_run`` words; ``length`` is its run's."""
    found = found or Found(spark, docs, id, text, similarity)
    node = F.struct("id", "place")
    own = without(found.lines.select("id", "place", "g", "keys"), found.copied, "id")
    met = materialize(shared(own.select(F.explode("keys").alias("key"), F.col("g").alias("member")), own.select("keys")).distinct(), "met")
    # a line has few keys: one for every band
    members = materialize(different(met).groupBy(F.col("member").alias("g")).agg(F.collect_list("key").alias("keys")), "members")
    discard(met)
    asked = only(own.select("id", "place", "g"), members.select("g"), "g").groupBy("g").agg(F.min(node).alias("first")).join(members, "g")
    wanted = asked.groupBy("first.id").agg(F.collect_list(F.struct("first.place", F.col("g").alias("member"), "keys")).alias("lines"))
    sets = materialize(line_sets(found.docs, wanted), "line-sets")
    discard(members)
    links = payload_links(sets.select(F.explode("keys").alias("key"), "member", "payload"), payload_comparison(jaccard(similarity)))
    groups = materialize(components(links), "line-groups")
    discard(sets)
    # lines that occur twice or are linked
    twice = found.lines.groupBy("g").count().where("count > 1").select("g")
    touched = materialize(twice.union(groups.select("node")).distinct(), "touched")
    rows = only(found.lines.drop("keys"), touched, "g").distinct().join(groups, F.col("g") == groups.node, "left").drop("node")
    rows = materialize(rows.withColumn("class", F.struct(F.coalesce("component", "g").alias("c"), F.when(F.col("component").isNull(), F.col("h")).otherwise(0).alias("h"))), "lines")
    roots = rows.groupBy("class").agg(F.min(node).alias("root"))
    repeats = spread_join(rows, roots, "class").where(node != F.col("root"))
    # repeats without a gap in their turns are a run
    run = F.col("turn") - F.row_number().over(Window.partitionBy("id").orderBy("turn"))
    runs = repeats.withColumn("run", run).withColumn("length", F.sum("words").over(Window.partitionBy("id", "run")))
    return runs.where(F.col("length") >= min_run).select("id", "place", "start", "stop", "length", F.col("root.id").alias("keeper_id"), F.col("root.place").alias("keeper_place"))


def _asked(b, words: Words) -> np.ndarray:
    """Words that the last column of a batch lists for its texts, counted over the slice."""
    return np.concatenate([np.array(a, np.int64) + f for a, f in zip(b.column(2).to_pylist(), words.firsts, strict=False)])


def _spans(b, words: Words, first: np.ndarray, last: np.ndarray) -> list:
    """Id, first word, place and offsets of spans of words, the hashes of their words, and ``spot``.

    ``spot`` is the first word (upper half) and the place (lower half) of the
    first span of the same words in the same text.
    """
    import pyarrow as pa

    text = words.owner[first]
    at, place = first - words.firsts[text], words.lines[first] - words.first_lines[text]
    numbers = [at, place, words.offsets(text, words.starts[first]), words.offsets(text, words.stops[last - 1])]
    hashes = [r.ranges(first, last) for r in words.runs]
    order = np.lexsort((at, *hashes, text))
    head = np.ones(len(order), bool)
    for x in (text, *hashes):
        head[1:] &= x[order][1:] == x[order][:-1]
    head[1:] = ~head[1:]
    spot = np.empty(len(order), np.int64)
    spot[order] = (at << 32 | place)[order][np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    return [b.column(0).take(pa.array(text)), *(pa.array(x.astype(np.int32)) for x in numbers), *(pa.array(h.view(np.int64)) for h in hashes), pa.array(spot)]


_SPAN = "at int, place int, start int, stop int, g long, h long, spot long"


def blocks(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, at, place, start, stop, g, h, spot, last, key): the blocks of runs around the anchors that ``wanted`` (id, ats) names.

    Runs begin at the words ``at`` to ``last``; ``g`` and ``h`` are hashes of all the block's words.
    """
    import pyarrow as pa

    names = ["id", "at", "place", "start", "stop", "g", "h", "spot", "last", "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, SLICE):
            words = Words(b.column(1).to_pylist())
            at, key, first, last = anchors(words)
            here = np.isin(at, _asked(b, words))
            if here.any():
                key, first, last = key[here], first[here], last[here]
                ends = (last - words.firsts[words.owner[first]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*_spans(b, words, first, last + PASSAGE), pa.array(ends), pa.array(key.view(np.int64))], names=names)

    return _texts(docs, wanted).mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, {_SPAN}, last int, key long")


def single_runs(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, at, place, start, stop, g, h, spot) of the runs of ``PASSAGE`` words that begin at the words that ``wanted`` (id, ats) names."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, SLICE):
            words = Words(b.column(1).to_pylist())
            first = np.unique(_asked(b, words))
            yield pa.RecordBatch.from_arrays(_spans(b, words, first, first + PASSAGE), names=["id", "at", "place", "start", "stop", "g", "h", "spot"])

    return _texts(docs, wanted).mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, {_SPAN}")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text, ats) of the texts that ``wanted`` names; few others are shuffled."""
    wanted = materialize(wanted, "wanted-words")
    return IdFilter(wanted, "id").maybe(docs, "id").join(wanted, "id").select("id", "text", "ats")


def _first_places(rows: DataFrame) -> DataFrame:
    """``rows`` of words that occur twice or more, with the first place of all: ``first`` (id), ``first_at``, ``first_place``.

    All rows of one id and the same words have one spot, so the spot at the
    least id is the least: sums of numbers only, which need no sort. The join
    is by other expressions than the sums, so that Spark can split a hot value.
    """
    firsts = rows.groupBy("g", "h").agg(F.min("id").alias("first"), F.min_by("spot", "id").alias("first_spot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    side = firsts.select(F.bitwise_not("g").alias("_g"), F.bitwise_not("h").alias("_h"), "first", "first_spot")
    known = rows.withColumns({"_g": F.bitwise_not("g"), "_h": F.bitwise_not("h")}).join(side, ["_g", "_h"])
    place = F.col("first_spot").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    return known.withColumns({"first_at": F.shiftright("first_spot", 32).cast("int"), "first_place": place}).drop("_g", "_h", "first_spot")


def passages(spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text", found: Found | None = None) -> DataFrame:
    """(id, place, start, stop, length, keeper_id, keeper_place) of every repeated passage; ``length`` in words.

    A text that has all its words in common with one of a smaller id is one
    passage. Inside a text, a run that overlaps its own earlier place is no repeat.
    """
    found = found or Found(spark, docs, id, text)
    own = without(found.texts.select("id", "keys", "ats"), found.copied, "id")
    listed = own.select("id", F.explode(F.arrays_zip("keys", "ats")).alias("a")).select(F.col("a.keys").alias("key"), "id", F.col("a.ats").alias("at"))
    wanted = shared(listed, own.select("keys")).groupBy("id").agg(F.collect_set("at").alias("ats"))
    whole = materialize(blocks(found.docs, wanted), "blocks")
    repeat = (F.col("id") != F.col("first")) | (F.col("at") >= F.col("first_at") + PASSAGE)
    known = materialize(_first_places(whole), "known")
    # one block of each kind where a minimum stands in several kinds of blocks, and what overlaps it in its own text
    several = whole.groupBy("key").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("g", "h")]).where("min_g <> max_g OR min_h <> max_h").select("key")
    mixed = only(whole, materialize(several, "several"), "key").join(known.where(repeat).select("id", "at", "key").distinct(), ["id", "at", "key"], "left_anti")
    wanted = mixed.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", "last")))).alias("ats"))
    runs = materialize(single_runs(found.docs, wanted), "runs").withColumn("last", F.col("at"))
    columns = ["id", "at", "last", "place", "start", "stop", "first", "first_place"]
    repeats = known.where(repeat).select(columns).unionByName(_first_places(runs).where(repeat).select(columns))
    mine = Window.partitionBy("id", "first").orderBy("at", "last")
    reached = F.max("last").over(mine.rowsBetween(Window.unboundedPreceding, -1))
    joined = repeats.withColumn("gap", F.coalesce((F.col("at") - reached > PASSAGE).cast("int"), F.lit(0))).withColumn("island", F.sum("gap").over(mine.rowsBetween(Window.unboundedPreceding, 0)))
    spans = joined.groupBy("id", F.col("first").alias("keeper_id"), "island").agg(
        F.min("place").alias("place"), F.min("start").alias("start"), F.max("stop").alias("stop"), (F.max("last") - F.min("at") + PASSAGE).cast("int").alias("length"), F.min_by("first_place", "at").alias("keeper_place")
    )
    return spans.select("id", "place", "start", "stop", "length", "keeper_id", "keeper_place").unionByName(found.copies)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the characters of ``spans``; lines that this leaves blank go."""
    gone = np.zeros(len(text) + 1, bool)
    for start, stop in spans:
        gone[start:stop] = True
    left, at = [], 0
    for line in text.split("\n"):
        mask = gone[at : at + len(line)]
        at += len(line) + 1
        if mask.any():
            line = "".join(c for c, out in zip(line, mask.tolist(), strict=True) if not out)
            if not line.strip():
                continue
        left.append(line)
    return "\n".join(left)


def without_repeats(spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text", chars: str = "n_chars", inside: bool = False) -> DataFrame:
    """``docs``, all rows and columns, with repeated paragraphs (and passages ``inside`` lines) cut from the texts.

    A column named ``chars`` is brought up to date with the text's length.
    """
    import pyarrow as pa

    rows, names = plain(docs)
    own, body = f"c{names.index(id)}", f"c{names.index(text)}"
    span = F.struct("start", "stop").alias("span")
    seen = Found(spark, rows, own, body)
    found = removals(spark, rows, own, body, found=seen).select("id", span)
    if inside:
        found = materialize(found, "cut-lines")
        # passages are found by the texts' rows alone
        delete_path(spark, f"{seen.rows._quarryline_path}/kind={LINE}")
        found = found.unionByName(passages(spark, rows, own, body, found=seen).select("id", span))
    gone = found.groupBy(F.col("id").alias("gone")).agg(F.collect_set("span").alias("spans"))
    gone = materialize(gone, "cuts")
    discard(seen.rows, seen.copies)
    # texts that stay whole for certain are not shuffled
    maybe, sure = IdFilter(gone, "gone").split(rows, own)
    both = maybe.join(gone, maybe[own] == gone["gone"], "left").drop("gone")

    count = f"c{names.index(chars)}" if chars in names else None
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 128):
            new = {c: b.column(c).to_pylist() for c in (body, count) if c}
            for i, spans in enumerate(b.column("spans").to_pylist()):
                if new[body][i] is not None and spans:
                    new[body][i] = cut(new[body][i], [(x["start"], x["stop"]) for x in spans])
                    if count:
                        new[count][i] = len(new[body][i])
            yield pa.RecordBatch.from_arrays([pa.array(new[c], b.schema.field(c).type) if c in new else b.column(c) for c in columns], names=columns)

    return sure.unionByName(both.mapInArrow(run, rows.schema)).toDF(*names)
