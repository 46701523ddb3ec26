"""Binary token files with keyed access by a minimal perfect hash.

Texts are encoded in ascending order of their id into shards of raw ids (two
little-endian bytes an id where the vocabulary allows, else four), every
document closed by the end id. Beside the ids of a shard lie its keys and
lengths, so that the index is built without a look at any id:

    kind=ids/shard=<number>/   ids of all documents | line feed
    kind=keys/shard=<number>/  keys int64 * n | flags uint8 * n | lengths uint32 * n | n uint64 | line feed

(flag 1: the key is null). Shard numbers ascend with the ids of their documents.
The index maps (id, copy) to shard, offset and length. Keys are dealt by hash
into buckets of bounded size; a bucket's keys get slots by levels of bit
arrays in which every key that has a position to itself stays and the others
go on to the next level, so n keys fill exactly n slots. A slot stores a
fingerprint of its key, so that a key that was never stored is refused
except by chance of 2^-32. Ids are read from the byte range that a slot names,
and no other bytes of a shard are touched; where Python cannot open the store
that Spark writes to, a shard's bytes are brought to its keys instead.

Edge cases: null texts are empty, an empty text is its end id; null ids come
first and are keys too; rows with one id are told apart by ``copy`` (0 is the
first stored); ids may be any 64-bit integers, other types are a TypeError; an
empty table writes nothing and finds nothing; other columns are ignored
whatever their names. A document that does not end in the end id where its
slot says is an error.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh_path, integer_ids, materialize, pick, prepare, sliced
from .tokens import ENTRIES, encoder, vocabulary

#: Text bytes of a shard, about.
SHARD_BYTES = 16 << 20
#: Bytes of ids after which a task begins another shard.
MOST_BYTES = 64 << 20
#: Keys of an index bucket, about.
BUCKET_KEYS = 1 << 15
LEVELS = 24


def text_bytes(docs: DataFrame, text: str) -> int:
    """About how long all texts are: twice the files' size as the planner knows it, else their sum."""
    known = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if known < 1 << 50:
        return 2 * known
    return pick(docs, text=text).agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def write_shards(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end: int, width: int = 2, id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES, most_bytes: int = MOST_BYTES) -> None:
    """Write the shards below ``path``, in ascending order of the ids."""
    import pyarrow as pa

    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer, width, entries=2 * ENTRIES)
        last = np.array([end], encode.dtype).tobytes()
        number = TaskContext.get().partitionId() << 20
        keys, sizes, held, size = [], [], [], 0

        def shard() -> Iterator[pa.RecordBatch]:
            flags = np.array([k is None for k in keys], np.uint8)
            table = np.array([k or 0 for k in keys], "<i8").tobytes() + flags.tobytes() + np.array(sizes, "<u4").tobytes() + np.array([len(keys)], "<u8").tobytes()
            for kind, value in (("ids", b"".join(held)), ("keys", table)):
                yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([number], pa.int64()), pa.array([value], pa.binary())], names=["kind", "shard", "value"])

        for b in sliced(batches):
            for key, ids in zip(b.column(0).to_pylist(), encode.many(b.column(1).to_pylist()), strict=True):
                keys.append(key)
                sizes.append(len(ids) // width + 1)
                held += [ids, last]
                size += len(ids) + width
                if size >= most_bytes:
                    yield from shard()
                    number += 1
                    keys, sizes, held, size = [], [], [], 0
        if keys:
            yield from shard()

    rows = integer_ids(pick(docs, id=id, text=text), "id")
    total = text_bytes(docs, text)
    # equal ids may be many: what follows the id keeps them from meeting in one shard
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(total // shard_bytes + 1, "id", "_at").sortWithinPartitions("id", "_at")
    written = dealt.select("id", "text").mapInArrow(run, "kind string, shard long, value binary")
    written.select("kind", "shard", F.col("value").cast("string").alias("value")).write.partitionBy("kind", "shard").text(path)


def shard_files(spark: SparkSession, path: str, kind: str, *columns: str) -> DataFrame:
    """(shard, columns...) of the files of a kind; ``content`` is only read where it is asked for."""
    fields = "path string, modificationTime timestamp, length long, content binary, shard long"
    return spark.read.format("binaryFile").schema(fields).option("pathGlobFilter", "part-*").load(f"{path}/kind={kind}").select("shard", *columns)


def stored_keys(spark: SparkSession, path: str) -> DataFrame:
    """(id, copy, shard, offset, n) of every stored document, from the tables of keys; ``offset`` counts ids in the shard."""
    import pyarrow as pa

    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, cell in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                content = cell.as_buffer()
                stop = len(content) - 9
                n = int(np.frombuffer(content, "<u8", 1, stop)[0])
                lengths = np.frombuffer(content, "<u4", n, stop - 4 * n).astype(np.int64)
                null = np.frombuffer(content, np.uint8, n, stop - 5 * n).astype(bool)
                keys = np.frombuffer(content, "<i8", n, stop - 13 * n)
                # equal keys follow each other
                apart = np.append(True, (keys[1:] != keys[:-1]) | (null[1:] != null[:-1]))
                first = np.maximum.accumulate(np.where(apart, np.arange(n), 0))
                columns = [pa.array(np.full(n, shard)), pa.array(keys, mask=null), pa.array(np.arange(n) - first), pa.array(np.cumsum(lengths) - lengths), pa.array(lengths)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "id", "rank", "offset", "n"])

    rows = materialize(shard_files(spark, path, "keys", "content").mapInArrow(run, "shard long, id long, rank long, offset long, n long"), "keys")
    # only the first key of a shard can have copies in shards before it: one row a shard
    ends = rows.groupBy("shard").agg(F.min_by("id", "offset").alias("first"), F.max_by("id", "offset").alias("last"), (F.max_by("rank", "offset") + 1).alias("tail"), F.count(F.lit(1)).alias("rows"))
    order = Window.orderBy("shard")
    carries = (F.row_number().over(order) > 1) & F.col("first").eqNullSafe(F.lag("last").over(order))
    # a shard of one key goes on counting what the shard before it ended with
    chained = ends.withColumn("carries", carries).withColumn("begins", F.when(F.col("carries") & (F.col("tail") == F.col("rows")), 0).otherwise(1))
    total = F.sum("tail").over(Window.partitionBy("chain").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    chained = chained.withColumn("chain", F.sum("begins").over(order)).withColumn("total", total)
    before = chained.select("shard", "first", F.when(F.col("carries"), F.lag("total").over(order)).otherwise(0).alias("before"))
    joined = rows.join(before, "shard")
    copy = F.col("rank") + F.when(F.col("id").eqNullSafe(F.col("first")), F.col("before")).otherwise(0)
    return joined.select("id", copy.cast("long").alias("copy"), "shard", "offset", "n")


def hashed(rows: DataFrame, buckets: int) -> DataFrame:
    """Add the key's bucket, 64-bit hash and 32-bit fingerprint."""
    # a null id is hashed as a word of its own: xxhash64 skips nulls
    key = [F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("copy")]
    return rows.withColumns({"bucket": F.pmod(F.xxhash64(F.lit(1), *key), F.lit(buckets)).cast("int"), "h": F.xxhash64(F.lit(2), *key), "fp": F.xxhash64(F.lit(3), *key).bitwiseAND(F.lit(0xFFFFFFFF))})


def _positions(h: np.ndarray, level: int, size: int) -> np.ndarray:
    x = (h ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


def build_levels(h: np.ndarray, spread: float = 1.7) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of a minimal perfect hash over distinct 64-bit hashes, and each key's slot.

    Keys that no level parts (equal hashes) get the slots after all others.
    """
    levels, slots = [], np.full(len(h), -1, np.int64)
    left, used = np.arange(len(h)), 0
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, int(spread * len(left)))
        at = _positions(h[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        placed = alone[at]
        ranks = np.cumsum(alone) - 1
        slots[left[placed]] = used + ranks[at[placed]]
        used += int(alone.sum())
        left = left[~placed]
    slots[left] = used + np.arange(len(left))
    return levels, slots


def find_slots(h: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The slot of each hash, or -1 where no level has it."""
    slots = np.full(len(h), -1, np.int64)
    left, used = np.arange(len(h)), 0
    for level, bits in enumerate(levels):
        at = _positions(h[left], level, len(bits))
        hit = bits[at]
        slots[left[hit]] = used + (np.cumsum(bits) - 1)[at[hit]]
        used += int(bits.sum())
        left = left[~hit]
    return slots


def build_index(spark: SparkSession, stored: DataFrame, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """The index table, one row a bucket, and its number of buckets.

    ``stored`` is a table of (id, copy, shard, offset, n).
    """
    import pandas as pd

    prepare(spark)
    buckets = int(stored.count() // bucket_keys) + 1

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        levels, slots = build_levels(rows["h"].to_numpy().view(np.uint64))
        order = np.argsort(slots)
        cells = {c: rows[c].to_numpy()[order].astype(k).tobytes() for c, k in (("fp", "<u4"), ("shard", "<i8"), ("offset", "<i8"), ("n", "<i8"))}
        packed = [np.packbits(b).tobytes() for b in levels]
        return pd.DataFrame([{"bucket": rows["bucket"].iloc[0], "sizes": [len(b) for b in levels], "levels": packed, **cells}])

    rows = hashed(stored, buckets).select("bucket", "h", "fp", "shard", "offset", "n")
    table = rows.groupBy("bucket").applyInPandas(build, "bucket int, sizes array<int>, levels array<binary>, fp binary, shard binary, offset binary, n binary")
    return materialize(table, "index"), buckets


def look_up(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """(id, copy, shard, offset, n) of the keys (id, copy) that the index holds."""
    import pandas as pd

    def find(asked: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if not len(table) or not len(asked):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("id", "copy", "shard", "offset", "n")})
        t = table.iloc[0]
        levels = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(t["levels"], t["sizes"], strict=True)]
        prints = np.frombuffer(t["fp"], "<u4")
        h = asked["h"].to_numpy().view(np.uint64)
        slots = find_slots(h, levels)
        known = (slots >= 0) & (prints[np.maximum(slots, 0)] == asked["fp"].to_numpy()) if len(prints) else slots >= 0
        # keys that no level parted sit behind all others: by fingerprint
        rest = sum(int(b.sum()) for b in levels)
        for i in np.flatnonzero(~known) if rest < len(prints) else ():
            at = np.flatnonzero(prints[rest:] == asked["fp"].iloc[i])
            if len(at):
                slots[i], known[i] = rest + at[0], True
        out = asked.loc[known, ["id", "copy"]].copy()
        for c, kind in (("shard", "<i8"), ("offset", "<i8"), ("n", "<i8")):
            out[c] = np.frombuffer(t[c], kind)[slots[known]].astype(np.int64)
        out["id"] = out["id"].astype("Int64")
        return out

    asked = hashed(keys, buckets).select("bucket", "id", "copy", "h", "fp")
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(find, "id long, copy long, shard long, offset long, n long")


def byte_ranges(uri: str) -> Callable[[int, int], bytes]:
    """A function that reads (offset, length) of a file, wherever Arrow can open it."""
    from pyarrow import fs

    if re.match("file:|/", uri):
        store, name = fs.LocalFileSystem(), "/" + re.sub("^file:", "", uri).lstrip("/")
    else:
        store, name = fs.FileSystem.from_uri(uri)
    file = store.open_input_file(name)
    return lambda offset, length: file.read_at(length, offset)


def _reachable(uri: str) -> bool:
    import pyarrow as pa

    try:
        byte_ranges(uri)(0, 1)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def read_ids(spark: SparkSession, found: DataFrame, path: str, end: int, width: int = 2, with_ids: bool = True, ranges: bool | None = None) -> DataFrame:
    """(id, copy, shard, offset, n, crc, ids) of the documents that :func:`look_up` has found.

    ``crc`` and ``ids`` are of the ids as little-endian unsigned 32-bit
    integers; ``ids`` is null without ``with_ids``. ``ranges`` says whether byte
    ranges of the files are read, or whole shards joined; found out if None.
    """
    import pyarrow as pa

    prepare(spark)
    dtype = {2: "<u2", 4: "<u4"}[width]
    names = ["id", "copy", "shard", "offset", "n"]
    schema = "id long, copy long, shard long, offset long, n long, crc long, ids binary"

    def read(asked, reader: Callable[[int], Callable[[int, int], bytes]]) -> pa.Table:
        payloads = []
        for shard, offset, n in zip(*(asked.column(c).to_pylist() for c in names[2:]), strict=True):
            ids = np.frombuffer(reader(shard)(offset * width, n * width), dtype)
            if len(ids) != n or ids[-1] != end:
                raise ValueError(f"shard {shard} holds no document of {n} ids at {offset}")
            payloads.append(ids.astype("<u4").tobytes())
        crc = pa.array([zlib.crc32(p) for p in payloads], pa.int64())
        return pa.Table.from_arrays([*(asked.column(c) for c in names), crc, pa.array(payloads if with_ids else [None] * len(payloads), pa.binary())], names=[*names, "crc", "ids"])

    files = shard_files(spark, path, "ids", "path")
    if ranges is None:
        one = files.select("path").head()
        ranges = one is None or _reachable(one[0])
    if ranges:

        def scattered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current: list = [None, None]

            for b in sliced(batches, 4096):
                uris = dict(zip(b.column(2).to_pylist(), b.column(5).to_pylist(), strict=True))

                def reader(shard: int, uris=uris) -> Callable[[int, int], bytes]:
                    if current[0] != shard:
                        current[:] = shard, byte_ranges(uris[shard])
                    return current[1]

                yield from read(b, reader).to_batches()

        placed = found.join(files, "shard").select(*names, "path").repartition("shard").sortWithinPartitions("shard", "offset")
        return placed.mapInArrow(scattered, schema)

    def gathered(asked: pa.Table, content: pa.Table) -> pa.Table:
        data = {s: c.as_buffer() for s, c in zip(content.column("at").to_pylist(), content.column("content"), strict=True)}
        return read(asked, lambda shard: lambda offset, length: data[shard][offset : offset + length])

    whole = shard_files(spark, path, "ids", "content").select(F.col("shard").alias("at"), "content")
    return found.select(*names).groupBy("shard").cogroup(whole.groupBy("at")).applyInArrow(gathered, schema)


def stored_texts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, by keyed access to its shard."""
    path, end = fresh_path(spark, "shards"), 2
    write_shards(spark, docs, path, vocabulary("byte_bpe_50k.json"), end)
    if docs.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    stored = materialize(stored_keys(spark, path), "stored")
    index, buckets = build_index(spark, stored)
    # a key for every row: as many copies as an id has rows
    rows = integer_ids(pick(docs, id="doc_id"), "id").groupBy("id").count()
    keys = rows.select("id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("copy"))
    found = read_ids(spark, look_up(keys, index, buckets), path, end, with_ids=False)
    # one row a shard
    before = F.coalesce(F.sum("size").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored.groupBy("shard").agg(F.sum("n").alias("size")).select("shard", before.alias("before"))
    return found.join(starts, "shard").select(F.col("id").alias("doc_id"), (F.col("before") + F.col("offset")).alias("start"), F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
