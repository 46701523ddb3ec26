"""Benchmark decontamination: one Aho-Corasick automaton over normalised items.

Texts are normalised to lower-cased words; each distinct benchmark word is
given one character, so that a text becomes a string with one character a
word, words outside the benchmark a common blank. All windows of ``window``
consecutive item words (an item of fewer words is one window) go into one
Aho-Corasick automaton; it scans each text once, and since a character is a
word, hits map back to the words' offsets in the original text.

The benchmark's words are counted before anything is sent to the tasks. Beyond
``shard_words`` words, what one automaton holds in a worker's memory, the items
are split into several of that size, which are built in turn for every
``SPAN_BYTES`` of texts; memory holds one of them and one span of texts.

Edge cases: a null text or item has no words; empty texts are clean; items
that occur twice count once per id, and items with a null id hit but are not
listed; several documents with one id are judged each on its own; empty tables
give empty or clean results; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_kind, pick, plain, prepare, release

WINDOW = 10
SHARD_WORDS = 500_000
#: Bytes of texts that automata of a split benchmark take their turns over.
SPAN_BYTES = 32 << 20

#: Bytes to bytes: A-Z lower-cased, bytes that are in no word to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BLANK = "\x00"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def word_spans(text: str) -> list[tuple[int, int]]:
    """Character offsets of the words in the original text."""
    folded = text.encode().translate(_FOLD)
    data = np.frombuffer(folded, np.uint8)
    inside = np.concatenate([[False], data != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    # a byte starts a character unless it is a continuation byte
    raw = np.frombuffer(text.encode(), np.uint8)
    before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    places = before[edges]
    return list(zip(places[::2].tolist(), places[1::2].tolist(), strict=True))


class Matcher:
    """The automaton of one shard of items."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        import ahocorasick

        self.codes: dict[bytes, str] = {}
        windows: dict[str, set] = {}
        for item, text in items:
            symbols = "".join(self._symbol(w) for w in words(text))
            if symbols:
                for at in range(max(1, len(symbols) - window + 1)):
                    windows.setdefault(symbols[at : at + window], set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for symbols, owners in windows.items():
            self.automaton.add_word(symbols, (len(symbols), owners))
        if windows:
            self.automaton.make_automaton()
        self.empty = not windows

    def _symbol(self, word: bytes) -> str:
        code = len(self.codes) + 1
        # surrogates are no characters
        return self.codes.setdefault(word, chr(code if code < 0xD800 else code + 0x800))

    def hits(self, text_words: list[bytes]) -> Iterator[tuple[int, int, set]]:
        """(first word, past the last word, items) of each occurrence of a window."""
        if self.empty:
            return
        get = self.codes.get
        for end, (size, owners) in self.automaton.iter("".join([get(w, _BLANK) for w in text_words])):
            yield end + 1 - size, end + 1, owners


def covered(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching word ranges merged."""
    out: list[list[int]] = []
    for a, z in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def _spans(batches: Iterator, span_bytes: int) -> Iterator:
    """Batches joined to at least ``span_bytes``."""
    import pyarrow as pa

    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= span_bytes:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


class _Automata:
    """The shards' automata in turn; a single one is built once per task."""

    def __init__(self, shards: list, window: int):
        self.shards, self.window = shards, window
        self.only = Matcher(shards[0].value, window) if len(shards) == 1 else None

    def batches(self, batches: Iterator) -> Iterator:
        return batches if self.only else _spans(batches, SPAN_BYTES)

    def __iter__(self) -> Iterator[Matcher]:
        if self.only:
            yield self.only
            return
        for shard in self.shards:
            matcher = Matcher(shard.value, self.window)
            shard.__dict__.pop("_value", None)  # a worker keeps what it has read of a broadcast
            yield matcher


def _shards(items: DataFrame, shard_words: int) -> list[list[tuple[object, str | None]]]:
    """The items on the driver, in shards of about ``shard_words`` words; one shard where they fit.

    A benchmark is a test set: its words are counted first, and shards are
    fetched one by one, each bounded by what its share of the count is.
    """
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 5
    count = int(total // shard_words) + 1
    place = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    return [[(r.item, r.text) for r in items.where(place == i).collect()] for i in range(count)]


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(id, n_words, n_hit, items, spans) for every document.

    ``items`` are the ids with an occurring window, ``spans`` the character
    offsets (start, stop) in the original text of the words hit.
    """
    import pyarrow as pa

    prepare(spark)
    shards = [spark.sparkContext.broadcast(s) for s in _shards(pick(items, item=item, text=item_text), shard_words)]
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    item_kind = items.schema[item].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        automata = _Automata(shards, window)
        for b in automata.batches(batches):
            texts = b.column(1).to_pylist()
            n_words, found, owners = [0] * len(texts), [[] for _ in texts], [set() for _ in texts]
            for m in automata:
                for i, t in enumerate(texts):
                    own = words(t)
                    n_words[i] = len(own)
                    for a, z, who in m.hits(own):
                        found[i].append((a, z))
                        owners[i] |= who
            ranges = [covered(f) for f in found]
            spans = []
            for t, r in zip(texts, ranges, strict=True):
                at = word_spans(t) if r else None
                spans.append([{"start": at[a][0], "stop": at[z - 1][1]} for a, z in r])
            lists = [sorted(o - {None}) for o in owners]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array([sum(z - a for a, z in r) for r in ranges], pa.int64()), pa.array(lists, pa.list_(kind)), pa.array(spans, span)],
                names=["id", "n_words", "n_hit", "items", "spans"],
            )

    rows = pick(docs, id=id, text=text)
    kind = arrow_kind(items, item)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_hit long, items array<{item_kind}>, spans array<struct<start:int,stop:int>>")


def contamination_report(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of :func:`contamination` per document; item ids are sorted as strings."""
    names = F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
    return contamination(spark, docs, items).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_benchmark(spark: SparkSession, docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, in which no window of an item occurs."""
    import pyarrow as pa

    prepare(spark)
    shards = [spark.sparkContext.broadcast(s) for s in _shards(pick(items, item="item_id", text="text"), SHARD_WORDS)]
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        automata = _Automata(shards, WINDOW)
        for b in automata.batches(batches):
            clean = np.ones(b.num_rows, bool)
            for m in automata:
                for i, t in enumerate(b.column(at).to_pylist()):
                    if clean[i] and next(m.hits(words(t)), None) is not None:
                        clean[i] = False
            yield b.filter(pa.array(clean))

    rows, names = plain(docs)
    return rows.mapInArrow(run, rows.schema).toDF(*names)


#: DuckDB: the same digest by window joins.
REPORT_SQL = r"""
WITH folded_docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
folded_items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM folded_items WHERE len(w) > 0)),
doc_windows AS (
  SELECT doc_id, p, size, array_to_string(w[p : p + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, greatest(len(w) - size + 1, 0) + 1)) AS p
        FROM folded_docs, (SELECT DISTINCT size FROM item_windows))),
hits AS (SELECT doc_id, p, d.size, item_id FROM doc_windows d JOIN item_windows i USING (size, win)),
words_hit AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id),
items_hit AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM folded_docs LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""
