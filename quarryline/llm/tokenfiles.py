"""Flat token files, and token counts by a separator scan over them.

A flat file is nothing but ids of two or four little-endian bytes; documents
follow each other, each closed by an end-of-document id, across file borders
(files are cut at a fixed number of ids, wherever that falls). There is no
index. The scan reads each file as one block, finds all end ids of a block by
one vectorised comparison, and reports whole documents at once. What a block
begins or ends with is a fragment: exclusive prefix sums over the blocks' ids
and end ids give every fragment its document's number, and fragments of one
document are summed. Only fragments (two a block) are stitched, and the prefix
scan has two levels, so nothing of the size of the corpus meets in a task.

``head`` leading ids of every document can hold its key (base-``end`` digits),
as files without an index have no other place for it.

Edge cases: an empty document is its head and end id; an empty file has no
fragments; ids after the last end id are a document with ``ended`` false; a
trailing byte that is no whole id is ignored; a null text is empty; a null id
has a code of its own; rows that occur twice are written and counted twice; an
empty table writes no files and counts nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import exclusive_prefix, fresh_path, integer_ids, pick, prepare, sliced
from .tokens import ENTRIES, encoder, vocabulary

#: Ids of a file.
FILE_IDS = 2 << 20
#: Digits of a document's key, enough for 64 bits at any base over 7132.
HEAD = 5
#: Files of one task are numbered within this span.
SPAN_BITS = 20


def key_digits(key: int | None, base: int, digits: int = HEAD) -> list[int]:
    """A signed 64-bit key in base ``base``, highest digit first; null is all highest digits."""
    if key is None:
        return [base - 1] * digits
    value, out = key + (1 << 63), []
    for _ in range(digits):
        value, d = divmod(value, base)
        out.append(d)
    return out[::-1]


def key_of(digits: list[int], base: int) -> int | None:
    if all(d == base - 1 for d in digits):
        return None
    value = 0
    for d in digits:
        value = value * base + d
    return value - (1 << 63)


def write_flat(spark: SparkSession, docs: DataFrame, path: str, tokenizer: str, end: int, width: int = 2, id: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS) -> None:
    """Write every document's key digits, ids and end id to flat files below ``path``.

    Files are folders ``shard=<number>`` in stream order; Spark's own writer
    makes them, so any file system and any lost task is its business. A file
    ends in a line feed, which is no whole id.
    """
    import pyarrow as pa

    prepare(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer, width, True, ENTRIES // 4)
        last = np.array([end], encode.dtype).tobytes()
        number = TaskContext.get().partitionId() << SPAN_BITS
        held, size = [], 0

        def files(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, number
            whole = b"".join(held)
            step = file_ids * width
            stop = len(whole) if final else len(whole) // step * step
            for at in range(0, stop, step):
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([whole[at : at + step]], pa.binary())], names=["shard", "value"])
                number += 1
            held, size = [whole[stop:]], len(whole) - stop

        for b in sliced(batches):
            for key, ids in zip(b.column(0).to_pylist(), encode.many(b.column(1).to_pylist()), strict=True):
                held += [np.array(key_digits(key, end), encode.dtype).tobytes(), ids, last]
                size += (HEAD + 1) * width + len(ids)
                if size >= file_ids * width:
                    yield from files(False)
        yield from files(True)

    rows = integer_ids(pick(docs, id=id, text=text), "id")
    found = rows.mapInArrow(run, "shard long, value binary")
    found.select("shard", F.col("value").cast("string").alias("value")).write.partitionBy("shard").text(path)


def scan_blocks(spark: SparkSession, path: str, end: int, width: int = 2, head: int = HEAD) -> DataFrame:
    """One row per whole document, fragment and block of the files below ``path``.

    kind 0: a block's totals (``ids``, ``ends``); 1: a document that lies in
    one block; 2: a fragment. ``place`` is the number of end ids before it in
    the block, ``start`` the ids before it, ``first`` its first ``head`` ids.
    """
    import pyarrow as pa

    prepare(spark)
    dtype = {2: "<u2", 4: "<u4"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = content.as_buffer()
                ids = np.frombuffer(data, dtype, count=len(data) // width)
                ends = np.flatnonzero(ids == end)
                # what lies between borders: first fragment, whole documents, last fragment
                borders = np.concatenate([[0], ends + 1, [len(ids)]])
                starts, sizes = borders[:-1], np.diff(borders)
                kinds = np.ones(len(starts), np.int32)
                kinds[[0, -1]] = 2
                ended = np.ones(len(starts), bool)
                ended[-1] = False
                used = np.flatnonzero(sizes > 0)
                firsts = [ids[s : s + min(head, n)].tolist() for s, n in zip(starts[used], sizes[used], strict=True)]
                n = len(used) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * n, pa.int64()), pa.array(np.append(kinds[used], 0).astype(np.int32)),
                        pa.array(np.append(used, 0)), pa.array(np.append(starts[used], 0)), pa.array(np.append(sizes[used], len(ids))),
                        pa.array(np.append(ended[used], True)), pa.array([*firsts, None], pa.list_(pa.int32())), pa.array([len(ends)] * n, pa.int64()),
                    ],
                    names=["shard", "kind", "place", "start", "ids", "ended", "first", "ends"],
                )

    files = spark.read.format("binaryFile").load(path).select(F.col("shard").cast("long"), "content")
    return files.mapInArrow(run, "shard long, kind int, place long, start long, ids long, ended boolean, first array<int>, ends long")


def count_tokens(spark: SparkSession, path: str, end: int, width: int = 2, head: int = HEAD) -> DataFrame:
    """(document, start, ids, ended, first) of every document of flat files.

    ``document`` is its number in the stream, ``start`` the ids before it,
    ``ids`` its ids with head and end id.
    """
    from .common import materialize

    found = materialize(scan_blocks(spark, path, end, width, head), "blocks")
    blocks = found.where("kind = 0").select("shard", "ids", "ends")
    before = exclusive_prefix(blocks, "shard", {"ids_before": "ids", "ends_before": "ends"}, span=1 << (SPAN_BITS + 6)).select("shard", "ids_before", "ends_before")
    parts = found.where("kind > 0").drop("ends").join(before, "shard")
    parts = parts.withColumns({"document": F.col("ends_before") + F.col("place"), "start": F.col("ids_before") + F.col("start")})
    whole = parts.where("kind = 1").select("document", "start", "ids", "ended", "first")
    pieces = parts.where("kind = 2").groupBy("document").agg(F.min("start").alias("start"), F.sum("ids").alias("ids"), F.bool_or("ended").alias("ended"), F.array_sort(F.collect_list(F.struct("start", "first"))).alias("pieces"))
    first = F.slice(F.flatten(F.transform("pieces", lambda p: p["first"])), 1, head) if head else F.array().cast("array<int>")
    return whole.unionByName(pieces.select("document", "start", "ids", "ended", first.alias("first")))


def decoded_key(first: str, base: int) -> F.Column:
    """The key that ``key_digits`` wrote; null for the null code."""
    digits = [F.col(first)[i].cast("decimal(38,0)") for i in range(HEAD)]
    value = digits[0]
    for d in digits[1:]:
        value = (value * F.lit(base).cast("decimal(6,0)") + d).cast("decimal(38,0)")
    empty = F.forall(first, lambda d: d == base - 1)
    return F.when(~empty, (value - F.lit(str(1 << 63)).cast("decimal(38,0)")).cast("long"))


def token_counts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, document, start, n_tokens): ids of every text, counted from flat files."""
    end = 49407
    path = fresh_path(spark, "flat")
    write_flat(spark, docs, path, vocabulary("word_bpe_49k.json"), end)
    if not _has_files(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "document", "start", "n_tokens")]))
    found = count_tokens(spark, path, end)
    return found.select(decoded_key("first", end).alias("doc_id"), "document", "start", (F.col("ids") - (HEAD + 1)).alias("n_tokens"))


def _has_files(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return any(s.isDirectory() for s in system.listStatus(folder))
