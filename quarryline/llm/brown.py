"""Language-model scores by Brown class-based bigrams.

Words are put into classes by exchange clustering of the class-bigram
likelihood, in two steps. First, items are moved in turn to the class where the
likelihood of the training text is highest, until a sweep moves nothing or 12
sweeps are done: items are the most frequent words, each by itself, the end of
a text, and a fixed number of word forms (by a word's last bytes) that stand
for all other words, so this step has a fixed size. Then every other word that
occurs ``FLOOR`` times or more is exchanged by itself, all words in parallel
against the classes of the first step: its neighbours' classes are counted over
the whole corpus, and it goes to the class under which its occurrences are
likeliest. The number of words that have a class of their own choice so grows
with the corpus; rarer words stay with their form. Counts of words, classes and
transitions cover the whole training text, under the final classes.

    P(w | v) = weight * p(class(w) | class(v)) * p(w | class(w)) + (1 - weight) * (c(w) + 1) / (N + V + 1)

Transitions are smoothed towards the classes' shares, emissions by absolute
discounting, whose mass goes to the unknown word of the class; the base
model's unknown mass is shared out evenly over the classes' unknown words.

Texts are cut once into chunks that hold their texts as places in a local word
list. Word counts are sums over the lists; counts and classes come back to the
chunks by a join of the lists, so no vocabulary is ever broadcast. The most
frequent words, which stand in every list, travel with the model instead.

Edge cases: null and empty texts are one end token; null ids are training rows;
rows that occur twice are counted and scored twice; without training rows the
base model gives probability one and so does the class model; an empty table
gives an empty result; other columns are ignored whatever their names; ids may
be of any type.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import IdFilter, arrow_kind, discard, materialize, pick, prepare, release

FREQUENT = 1024
FORMS = 256  # a form's number is one byte
CLASSES = 64  # a class's number is one byte
FLOOR = 4
CHUNK_BYTES = 8 << 20
WEIGHT = 0.97


@dataclass
class ClassModel:
    """Item map and probabilities; small and of fixed size, so it travels with the tasks.

    ``counts`` are the frequent words', in the items' order.
    """

    items: dict[bytes, int]
    classes: np.ndarray
    transition: np.ndarray
    tokens: np.ndarray
    types: np.ndarray
    discount: float
    train_tokens: int
    vocabulary: int
    end_count: int
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def end(self) -> int:
        return len(self.items)


def listed_places(words, forms: np.ndarray, items) -> np.ndarray:
    """Items of a chunk's words (an Arrow array) from their forms' numbers and the frequent words."""
    import pyarrow.compute as pc

    found = pc.fill_null(pc.index_in(words, value_set=items), -1).to_numpy(zero_copy_only=False)
    return np.where(found >= 0, found, len(items) + 1 + forms.astype(np.int64))


#: Bytes of a piece of packed data: writers keep buffers of the size of what they are given.
PIECE = 1 << 16


def pieces(data: bytes) -> list[bytes]:
    return [data[at : at + PIECE] for at in range(0, len(data), PIECE)]


def packed(codes: np.ndarray) -> list[bytes]:
    """Word numbers as compressed bytes, after their number, in pieces."""
    import pyarrow as pa

    return pieces(len(codes).to_bytes(8, "little") + pa.compress(codes.astype("<i4").tobytes(), codec="zstd", asbytes=True))


def unpacked(held: list[bytes]) -> np.ndarray:
    import pyarrow as pa

    data = b"".join(held)
    size = 4 * int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.decompress(data[8:], size, codec="zstd"), "<i4")


def chunked(docs: DataFrame, id: str, text: str, folds: int, held: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk: ids, held flags, word numbers per text (packed), and the local words with training counts and forms."""
    import pyarrow as pa

    kind = arrow_kind(docs, id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        release()
        number = TaskContext.get().partitionId() << 24
        ids, flags, sizes, codes, local, held_bytes = [], [], [], [], {}, 0

        def chunk() -> pa.RecordBatch:
            flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
            train = np.repeat(~np.array(flags, bool), sizes)
            counts = np.bincount(flat[train], minlength=len(local)) if len(flat) else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([flags], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([packed(flat)], pa.list_(pa.binary())), pa.array([list(local)], pa.list_(pa.binary())), pa.array([counts.astype(np.int64)], pa.list_(pa.int64())),
                    pa.array([bytes([zlib.crc32(w[-4:]) % FORMS for w in local])], pa.binary()),
                ],
                names=["chunk", "ids", "held", "sizes", "codes", "words", "counts", "forms"],
            )

        for b in batches:
            for i, t, h in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                data = t.encode() if t else b""
                words = data.lower().split()
                place = local.setdefault
                codes.append(np.array([place(w, len(local)) for w in words], np.int32))
                ids.append(i)
                flags.append(h)
                sizes.append(len(words))
                held_bytes += len(data)
                if held_bytes >= chunk_bytes:
                    yield chunk()
                    number += 1
                    ids, flags, sizes, codes, local, held_bytes = [], [], [], [], {}, 0
        if ids:
            yield chunk()

    rows = pick(docs, id=id, text=text)
    name = rows.schema["id"].dataType.simpleString()
    out = F.coalesce(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(folds)) == held, F.lit(False))
    return rows.withColumn("held", out).mapInArrow(run, f"chunk long, ids array<{name}>, held array<boolean>, sizes array<int>, codes array<binary>, words array<binary>, counts array<long>, forms binary")


def padded(codes: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes with one end after every text, and the place of each text's first code."""
    stops = np.cumsum(sizes + 1)
    out = np.full(len(codes) + len(sizes), end, codes.dtype)
    keep = np.ones(len(out), bool)
    keep[stops - 1] = False
    out[keep] = codes
    return out, stops - sizes - 1


def pair_counts(chunks: DataFrame, items: dict[bytes, int]) -> np.ndarray:
    """Training counts of adjacent items, the end also standing before every text."""
    import pyarrow as pa

    size = len(items) + 1 + FORMS
    end = len(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        frequent = pa.array(list(items), pa.binary())
        for b in batches:
            for held, sizes, codes, words, forms in zip(*(b.column(c) for c in range(5)), strict=True):
                sizes, train = np.array(sizes.as_py(), np.int64), ~np.array(held.as_py(), bool)
                places = listed_places(words.values, np.frombuffer(forms.as_py(), np.uint8), frequent)
                flat = places[unpacked(codes.as_py())] if len(places) else np.zeros(0, np.int64)
                seq, firsts = padded(flat, sizes, end)
                before = np.concatenate([[end], seq[:-1]])
                before[firsts] = end
                use = np.repeat(train, sizes + 1)
                total += np.bincount(before[use] * size + seq[use], minlength=size * size)
        found = np.flatnonzero(total)
        for at in range(0, len(found), 65536):
            part = found[at : at + 65536]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], names=["pair", "n"])

    rows = chunks.select("held", "sizes", "codes", "words", "forms").mapInArrow(run, "pair long, n long")
    # at most size * size rows: the item set is fixed
    table = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[table["pair"].to_numpy()] = table["n"].to_numpy()
    return out.reshape(size, size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = 12) -> np.ndarray:
    """The class of each item: exchange clustering of the class-bigram likelihood.

    Starts from items dealt to classes by falling frequency; ties of a move go
    to the lowest class, and an item moves only where that gains.
    """
    n = len(pairs)
    counts = pairs.sum(axis=0).astype(np.float64)
    order = np.argsort(-counts, kind="stable")
    own = np.empty(n, np.int64)
    own[order] = np.arange(n) % classes
    member = np.zeros((n, classes))
    member[np.arange(n), own] = 1
    pairs = pairs.astype(np.float64)
    to_class, from_class = pairs @ member, pairs.T @ member  # per item: followers' and predecessors' classes
    matrix = member.T @ to_class
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if counts[w] == 0 and pairs[w].sum() == 0:
                continue
            a, loop = own[w], pairs[w, w]
            after, before = to_class[w].copy(), from_class[w].copy()
            after[a] -= loop
            before[a] -= loop
            matrix[a, :] -= after
            matrix[:, a] -= before
            matrix[a, a] -= loop
            rows, columns = matrix.sum(axis=1), matrix.sum(axis=0)
            gain = (_xlogx(matrix + after) - _xlogx(matrix)).sum(axis=1) + (_xlogx(matrix.T + before) - _xlogx(matrix.T)).sum(axis=1)
            d = np.diagonal(matrix)
            gain += _xlogx(d + after + before + loop) + _xlogx(d) - _xlogx(d + after) - _xlogx(d + before)
            out, into = after.sum() + loop, before.sum() + loop
            gain -= _xlogx(rows + out) - _xlogx(rows) + _xlogx(columns + into) - _xlogx(columns)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            matrix[b, :] += after
            matrix[:, b] += before
            matrix[b, b] += loop
            if b != a:
                moved += 1
                own[w] = b
                to_class[:, a] -= pairs[:, w]
                to_class[:, b] += pairs[:, w]
                from_class[:, a] -= pairs[w]
                from_class[:, b] += pairs[w]
        if not moved:
            break
    return own


def contexts(chunks: DataFrame, model: ClassModel) -> DataFrame:
    """(word, near): of every local word that is not frequent, the classes before it (as they are) and after it (plus ``CLASSES``) in training texts.

    ``near`` is pairs of bytes, a class and a count; a count above 255 takes several pairs.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        frequent = pa.array(list(model.items), pa.binary())
        for b in batches:
            for held, sizes, codes, words, forms in zip(*(b.column(c) for c in range(5)), strict=True):
                sizes, train = np.array(sizes.as_py(), np.int64), ~np.array(held.as_py(), bool)
                places = listed_places(words.values, np.frombuffer(forms.as_py(), np.uint8), frequent)
                local = len(places)
                own = np.append(model.classes[places], model.classes[model.end])
                seq, firsts = padded(unpacked(codes.as_py()), sizes, local)
                kinds = own.astype(np.int32)[seq]
                before = np.concatenate([kinds[:1], kinds[:-1]])
                before[firsts] = own[-1]
                # a chunk has few million words, so the products fit 32 bits
                rare = np.append(places > model.end, False)
                use = np.flatnonzero(rare[seq] & np.repeat(train, sizes + 1))
                found, n = np.unique(np.concatenate([seq[use] * 2 * CLASSES + before[use], seq[use] * 2 * CLASSES + CLASSES + kinds[use + 1]]), return_counts=True)
                several = -(-n // 255)
                found, n = np.repeat(found, several), np.repeat(n, several)
                last = np.cumsum(several) - 1
                n[last] -= 255 * (several - 1)
                full = np.ones(len(n), bool)
                full[last] = False
                n[full] = 255
                word, at = np.divmod(found, 2 * CLASSES)
                pairs = np.column_stack([at, n]).astype(np.uint8)
                cuts = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
                named = words.values.take(pa.array(word[cuts]))
                ends = np.append(cuts, len(word))
                for part in range(0, len(cuts), 8192):
                    stop = min(part + 8192, len(cuts))
                    offsets = (2 * (ends[part : stop + 1] - ends[part])).astype(np.int32)
                    near = pa.Array.from_buffers(pa.binary(), stop - part, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pairs[ends[part] : ends[stop]].tobytes())])
                    yield pa.RecordBatch.from_arrays([named.slice(part, stop - part), near], names=["word", "near"])

    return chunks.select("held", "sizes", "codes", "words", "forms").mapInArrow(run, "word binary, near binary")


def chosen(rows: DataFrame, model: ClassModel, share: np.ndarray) -> DataFrame:
    """(name, class): the class under which each word's occurrences are likeliest, from (name, near) of :func:`contexts`.

    For class k that is the sum of log p(next class | k) and log p(k | class
    before) over the occurrences, less count * log(tokens of k); ``share`` are
    the classes' tokens. Rows of a word are sums, added as they come. Words are
    named by a hash of 64 bits, which only their class depends on.
    """
    import pyarrow as pa

    logs = np.log(np.maximum(model.transition, 1e-12))
    size = np.log(np.maximum(share, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best(names: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            score = sums[:, CLASSES:] @ logs.T + sums[:, :CLASSES] @ logs - sums[:, :CLASSES].sum(axis=1)[:, None] * size
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(score.argmax(axis=1).astype(np.int32))], names=["name", "class"])

        name, total = None, np.zeros((1, 2 * CLASSES))
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                b = whole.slice(start, 4096)
                names, near = b.column(0).to_numpy(), b.column(1).to_pylist()
                cuts = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
                group = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(names))))
                pairs = np.frombuffer(b"".join(near), np.uint8).reshape(-1, 2).astype(np.int64)
                own = np.repeat(group, [len(x) // 2 for x in near])
                sums = np.bincount(own * 2 * CLASSES + pairs[:, 0], pairs[:, 1], 2 * CLASSES * len(cuts)).reshape(-1, 2 * CLASSES)
                names = names[cuts]
                if name is not None and names[0] == name:
                    sums[0] += total[0]
                elif name is not None:
                    names, sums = np.append(name, names), np.vstack([total, sums])
                if len(names) > 1:
                    yield best(names[:-1], sums[:-1])
                name, total = names[-1], sums[-1:].copy()
        if name is not None:
            yield best(np.array([name]), total)

    return rows.repartition("name").sortWithinPartitions("name").mapInArrow(run, "name long, class int")


def smoothed(matrix: np.ndarray) -> np.ndarray:
    """Transition probabilities of class counts, smoothed towards the classes' shares."""
    share = matrix.sum(axis=0) / max(matrix.sum(), 1)
    return (matrix + 10 * share) / (matrix.sum(axis=1, keepdims=True) + 10)


def train(chunks: DataFrame, counts: DataFrame, floor: int = FLOOR) -> tuple[ClassModel, DataFrame]:
    """The model of the first step, and (word, c, class) of all training words after the second; ``counts`` has their counts."""
    sums = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))).first()
    texts = chunks.select(F.explode("held").alias("held")).where("not held").count()
    types, words, once, twice = (int(x) for x in sums)
    top = counts.orderBy(F.col("c").desc(), "word").limit(FREQUENT).collect()
    items = {bytes(r.word): i for i, r in enumerate(top)}
    pairs = pair_counts(chunks, items)
    classes = exchange(pairs)
    member = np.zeros((len(pairs), CLASSES))
    member[np.arange(len(pairs)), classes] = 1
    matrix = member.T @ pairs @ member
    discount = once / (once + 2 * twice) if once else 0.5
    none = np.zeros(CLASSES)
    model = ClassModel(items, classes, smoothed(matrix), none, none, discount, words + texts, types + (texts > 0), texts, np.array([r.c for r in top], np.int64))
    frequent = counts.sparkSession.createDataFrame([(bytearray(w), i) for w, i in items.items()], "word binary, item int")
    # the frequent words are a fixed number of rows
    listed = counts.join(F.broadcast(frequent), "word", "left")
    enough = (F.col("c") >= floor) & F.col("item").isNull()
    near = IdFilter(listed.where(enough).select("word"), "word").maybe(contexts(chunks, model), "word")
    own = materialize(chosen(near.select(F.xxhash64("word").alias("name"), "near"), model, matrix.sum(axis=0)), "classes")
    found = F.array(*[F.lit(int(c)) for c in classes])
    form = F.pmod(F.crc32(F.substring("word", -4, 4)), F.lit(FORMS)).cast("int")
    place = F.coalesce(F.col("item"), form + len(items) + 1)
    named = listed.withColumn("name", F.when(enough, F.xxhash64("word"))).join(own, "name", "left").withColumn("class", F.coalesce("class", F.get(found, place)))
    return model, materialize(named.select("word", "c", "class"), "words")


def probabilities(model: ClassModel, before: np.ndarray, own: np.ndarray, count: np.ndarray) -> np.ndarray:
    """P(word | class before) from the words' classes and training counts (0: unknown)."""
    base = (count + 1) / (model.train_tokens + model.vocabulary + 1)
    if not model.train_tokens:
        return base
    known = count > 0
    base = np.where(known, base, base / CLASSES)
    total = np.maximum(model.tokens[own], 1)
    unknown = np.where(model.tokens[own] > 0, model.discount * model.types[own] / total, 1.0)
    emission = np.where(known, (count - model.discount) / total, unknown)
    return WEIGHT * model.transition[before, own] * emission + (1 - WEIGHT) * base


def coded(chunks: DataFrame, local: DataFrame, words: DataFrame, model: ClassModel) -> DataFrame:
    """The chunks with the training count and the class of each of their words, packed."""
    import pyarrow as pa

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["ids", "held", "sizes", "codes", "known", "kinds"]
        forms = np.frombuffer(left.column("forms")[0].as_py(), np.uint8).astype(np.int64)
        known, places = np.zeros(len(forms) + 1, np.int64), np.append(model.end + 1 + forms, model.end)
        kinds = model.classes[places]
        at = right["place"].to_numpy()
        known[at], kinds[at] = np.divmod(right["known"].to_numpy(), CLASSES)
        known[-1] = model.end_count
        return pa.Table.from_arrays([*(left.column(c).combine_chunks() for c in names[:4]), pa.array([pieces(known.astype("<i8").tobytes())], pa.list_(pa.binary())), pa.array([kinds.astype(np.uint8).tobytes()], pa.binary())], names=names)

    # a frequent word has a row in every chunk: its count and class are broadcast, a fixed number of rows
    frequent = words.join(F.broadcast(words.sparkSession.createDataFrame([(bytearray(w),) for w in model.items], "word binary")), "word")
    common = local.join(F.broadcast(frequent), "word")
    rest = local.join(F.broadcast(frequent.select("word")), "word", "left_anti").join(words, "word")
    known = (F.col("c") * CLASSES + F.col("class")).alias("known")
    # as a table, so that the shuffles of the join by word are gone before those by chunk begin
    found = materialize(common.select(F.col("chunk").alias("at"), "place", known).unionByName(rest.select(F.col("chunk").alias("at"), "place", known)), "found")
    kind = chunks.schema["ids"].dataType.simpleString()
    whole = chunks.select("chunk", "ids", "held", "sizes", "codes", "forms").groupBy("chunk").cogroup(found.groupBy("at"))
    out = materialize(whole.applyInArrow(run, f"ids {kind}, held array<boolean>, sizes array<int>, codes array<binary>, known array<binary>, kinds binary"), "coded")
    discard(found)
    return out


#: Tokens that are looked at together, whole texts.
TOKENS = 1 << 18


def sequences(batch) -> Iterator[tuple]:
    """(ids, held, sizes, first tokens, counts, classes, classes before) of some texts' tokens at a time, ends included."""
    for ids, held, sizes, codes, known, kinds in zip(*(batch.column(c) for c in range(6)), strict=True):
        sizes, held = np.array(sizes.as_py(), np.int64), np.array(held.as_py(), bool)
        known, kinds = np.frombuffer(b"".join(known.as_py()), "<i8"), np.frombuffer(kinds.as_py(), np.uint8).astype(np.int64)
        codes = unpacked(codes.as_py())
        past = np.concatenate([[0], np.cumsum(sizes)])
        start = 0
        while start < len(sizes):
            stop = max(start + 1, int(np.searchsorted(past, past[start] + TOKENS, side="right")) - 1)
            seq, firsts = padded(codes[past[start] : past[stop]], sizes[start:stop], len(known) - 1)
            own = kinds[seq]
            before = np.concatenate([own[:1], own[:-1]])
            before[firsts] = kinds[-1]
            yield ids.values.slice(start, stop - start), held[start:stop], sizes[start:stop], firsts, known[seq], own, before
            start = stop


def class_counts(rows: DataFrame) -> np.ndarray:
    """Training counts of adjacent classes; a fixed number of rows a task."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for b in batches:
            for _, held, sizes, _, _, own, before in sequences(b):
                use = np.repeat(~held, sizes + 1)
                total += np.bincount(before[use] * CLASSES + own[use], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["pair", "n"])

    found = rows.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES * CLASSES)
    out[found["pair"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(CLASSES, CLASSES)


def fitted(model: ClassModel, words: DataFrame, rows: DataFrame) -> ClassModel:
    """The model with transitions, tokens and types of the final classes."""
    matrix = class_counts(rows)
    types = np.zeros(CLASSES)
    for r in words.groupBy("class").count().collect():  # one row a class
        types[r["class"]] = r["count"]
    types[model.classes[model.end]] += model.end_count > 0
    model.transition, model.tokens, model.types = smoothed(matrix), matrix.sum(axis=0), types
    return model


def language_scores(spark: SparkSession, docs: DataFrame, id: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2, floor: int = FLOOR) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every text."""
    import pyarrow as pa

    prepare(spark)
    chunks = materialize(chunked(docs, id, text, folds, held), "chunks")
    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    local = listed.select("chunk", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counts = materialize(local.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "word-counts")
    model, words = train(chunks, counts, floor)
    discard(counts)
    rows = coded(chunks, local.drop("n"), words, model)
    discard(chunks)
    model = fitted(model, words, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in batches:
            for ids, flags, sizes, firsts, count, own, before in sequences(b):
                base = np.log10((count + 1) / (model.train_tokens + model.vocabulary + 1))
                score = np.log10(probabilities(model, before, own, count))
                columns = [
                    ids, pa.array(flags), pa.array(sizes + 1), pa.array(np.add.reduceat((count > 0).astype(np.int64), firsts)),
                    pa.array(np.full(len(sizes), model.train_tokens, np.int64)), pa.array(np.add.reduceat(base, firsts)), pa.array(np.add.reduceat(score, firsts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = docs.schema[id].dataType.simpleString()
    scored = rows.mapInArrow(run, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def scored_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return language_scores(spark, docs).withColumnRenamed("id", "doc_id")


def base_scores(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The columns of :func:`scored_documents` that do not depend on classes, which SQL can say."""
    return scored_documents(spark, docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


#: DuckDB: unigram scores; crc32 is written out bit by bit.
BASE_SQL = r"""
WITH cut AS MATERIALIZED (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w,
    coalesce(xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
      lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295) % 7 = 2, FALSE) AS held_out
  FROM documents),
counts AS (SELECT word, count(*) AS c FROM (SELECT unnest(w) AS word FROM cut WHERE NOT held_out) GROUP BY word),
totals AS (
  SELECT (SELECT coalesce(sum(c), 0) FROM counts) + (SELECT count(*) FROM cut WHERE NOT held_out) AS n,
    (SELECT count(*) FROM counts) + (SELECT CAST(count(*) > 0 AS INTEGER) FROM cut WHERE NOT held_out) AS v, (SELECT count(*) FROM cut WHERE NOT held_out) AS ends),
tokens AS (SELECT place, coalesce(c, 0) AS c FROM cut AS t, unnest(t.w) AS u(word) LEFT JOIN counts USING (word)),
named AS (SELECT place, doc_id, held_out, len(w) AS size FROM cut),
sums AS (SELECT place, sum(log10((c + 1) / (n + v + 1))) AS s, sum(CAST(c > 0 AS INTEGER)) AS known FROM tokens, totals GROUP BY place)
SELECT doc_id, held_out, CAST(size + 1 AS BIGINT) AS n_tokens, CAST(coalesce(known, 0) + CAST(ends > 0 AS INTEGER) AS BIGINT) AS n_known, CAST(n AS BIGINT) AS train_tokens,
  round(coalesce(s, 0) + log10((ends + 1) / (n + v + 1)), 4) AS base_score
FROM named LEFT JOIN sums USING (place), totals
"""
