"""Packing token ids into training sequences by Karmarkar-Karp differencing.

A document's ids (with its end id) are cut into whole sequences of the
capacity as far as they go; what is left is cut into pieces of at most
``piece`` ids. Pieces are pooled as they come, and each pool is partitioned
by multiway differencing: partial partitions with opposing imbalances are
merged, largest with smallest window, until one partition into near-equal
windows is left. The number of windows starts at what the pool's ids need and
rises whenever the fullest window exceeds the capacity. So every sequence of a
pool ends nearly full.

Pools are made inside the tasks that tokenise, from a bounded number of ids:
no shuffle, and memory does not grow with the table. Sequence ids hold the
task's partition number in their upper bits.

Edge cases: null and empty texts are one end id; a document longer than the
capacity takes whole sequences of its own; equal lengths are dealt in the
order of the rows; rows that occur twice are packed twice; null ids are kept;
an empty table gives no pieces; other columns are ignored whatever their names.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, prepare, sliced
from .tokens import ENTRIES, encoder, vocabulary

CAPACITY = 2048
PIECE = 512
POOL = 512 * CAPACITY


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Positions of ``sizes`` in each of ``windows`` near-equal windows.

    Every size begins as a partial partition of its own. Of the two with the
    largest spread, the fullest windows of one join the emptiest of the other;
    a partition is kept as its windows' sums above the least of them, highest
    first, and the tree of merges is undone at the end into lists.
    """
    if not sizes:
        return [[] for _ in range(windows)]
    heap = []
    merges: list[tuple] = []
    for i, n in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = n
        heap.append((-n, i, sums))
        merges.append(())
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, high = heapq.heappop(heap)
        _, b, low = heapq.heappop(heap)
        joined = high + low[::-1]
        order = np.argsort(-joined, kind="stable")
        sums = joined[order]
        sums = sums - sums[-1]
        merges.append((a, b, order))
        heapq.heappush(heap, (-int(sums[0]), len(merges) - 1, sums))
    # from the root down: which final window is each place of a partial partition
    out: list[list[int]] = [[] for _ in range(windows)]
    stack = [(heap[0][1], np.arange(windows))]
    while stack:
        node, window = stack.pop()
        if not merges[node]:
            out[window[0]].append(node)
            continue
        a, b, order = merges[node]
        own = np.empty(windows, np.int64)
        own[order] = window  # place in the unsorted sums -> window
        stack.append((a, own))
        stack.append((b, own[::-1]))
    return out


def windows_of(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows within the capacity; their number rises until none exceeds it."""
    count = -(-sum(sizes) // capacity)
    while count:
        found = differencing(sizes, count)
        over = sum(max(0, sum(sizes[i] for i in w) - capacity) for w in found)
        if not over:
            return found
        count += max(1, over // capacity)
    return []


def pieces_of(length: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length): whole sequences first, then pieces of the rest."""
    whole = length // capacity * capacity
    return [(a, capacity) for a in range(0, whole, capacity)] + [(a, min(piece, length - a)) for a in range(whole, length, piece)]


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, piece: int = PIECE, pool: int = POOL, with_ids: bool = True, entries: int = ENTRIES) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of every piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers
    (null without ``with_ids``); a sequence is its pieces in the order of
    ``offset``.
    """
    import pyarrow as pa

    prepare(spark)
    width = 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer, width, entries=entries)
        last = np.array([end], encode.dtype).tobytes()
        names = iter(range(TaskContext.get().partitionId() << 32, 1 << 62))
        kind = None

        def placed(rows: list, loose: list) -> pa.RecordBatch:
            for window in windows_of([r[2] for r in loose], capacity):
                name, at = next(names), 0
                for i in window:
                    rows.append((*loose[i][:5], name, at, loose[i][5]))
                    at += loose[i][2]
            columns = zip(*rows, strict=True)
            kinds = [kind, *[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

        rows: list = []
        loose: list = []
        held = 0
        for b in sliced(batches):
            kind = b.schema.field(0).type
            for i, ids in zip(b.column(0).to_pylist(), encode.many(b.column(1).to_pylist()), strict=True):
                ids += last
                count = len(ids) // width
                for start, n in pieces_of(count, capacity, piece):
                    part = ids[start * width : (start + n) * width]
                    row = (i, start, n, zlib.crc32(part), count, part if with_ids else None)
                    if n == capacity:
                        rows.append((*row[:5], next(names), 0, row[5]))
                    else:
                        loose.append(row)
                        held += n
                    if held >= pool or len(rows) >= 8192:
                        yield placed(rows, loose if held >= pool else [])
                        rows = []
                        if held >= pool:
                            loose, held = [], 0
        if rows or loose:
            yield placed(rows, loose)

    rows = pick(docs, id=id, text=text)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def packed(spark: SparkSession, docs: DataFrame, entries: int = 2 * ENTRIES) -> DataFrame:
    """Every document's pieces in sequences of 2048 ids of the lower-cased word vocabulary, end id 1.

    ``entries`` bounds the tokenizer's cache: more is faster, less leaves memory to others.
    """
    found = pack(spark, docs, vocabulary("word_bpe_49k.json"), 1, with_ids=False, entries=entries)
    return found.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
