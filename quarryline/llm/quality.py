"""Quality classifier: a byte-level convolutional network in numpy.

Filters of eight bytes slide over the whole text in steps of four, so that
neighbouring windows overlap; each filter's answers are max-pooled per block
of windows, and a text's blocks are combined by their maximum and mean into
one logistic probability. Nothing but the bytes of the text is an input.

The network is fitted on the driver on a sample bounded by ``sample_rows`` and
``sample_chars``: labelled rows in the order of a hash of their id, of texts
over ``sample_chars`` characters a third of that from their beginning, middle
and end. Scoring covers every whole text.

Edge cases: a null text scores as an empty one, and an empty one gets the
probability of a text without windows; null ids are scored and kept; rows that
occur twice are scored twice; an empty table gives an empty result; other
columns, whatever their names, are ignored. A label that is null is no label,
and of several labels of an id the lowest counts. Without labels of both
kinds the network stays untrained and scores 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, plain, prepare, release, sliced

STEP = 4
WIDTH = 2 * STEP


@dataclass
class Network:
    """Parameters of the classifier; ``filters`` holds both halves of a window."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    intercept: float
    block: int = 64
    trained: bool = field(default=False)

    @classmethod
    def fresh(cls, dims: int = 8, filters: int = 32, block: int = 64, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.5, (256, dims)).astype(np.float32),
            rng.normal(0, 1 / np.sqrt(WIDTH * dims), (2, STEP * dims, filters)).astype(np.float32),
            np.zeros(filters, np.float32), rng.normal(0, 0.05, 2 * filters).astype(np.float32), 0.0, block,
        )

    def windows(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All texts as steps of ``STEP`` bytes, zero-padded, and each text's first step.

        A text of n bytes takes ceil(n / STEP) steps and one more of zeros,
        so its last window ends in padding and none reaches the next text.
        """
        steps = np.array([-(-len(t) // STEP) + 1 if t else 0 for t in texts], dtype=np.int64)
        data = b"".join(t + bytes(int(s) * STEP - len(t)) for t, s in zip(texts, steps, strict=True))
        return np.frombuffer(data, np.uint8).reshape(-1, STEP), np.concatenate([[0], np.cumsum(steps)])

    def answers(self, steps: np.ndarray) -> np.ndarray:
        """Filter answers of the window that begins at each step (the last one has none)."""
        x = self.embedding[steps.ravel()].reshape(len(steps), -1)
        return (x @ self.filters[0])[:-1] + (x @ self.filters[1])[1:] + self.bias

    def blocks(self, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First window of every block, and the text it belongs to. Texts must not be empty."""
        counts = np.diff(firsts) - 1
        per = -(-counts // self.block)
        owner = np.repeat(np.arange(len(counts)), per)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        return firsts[:-1][owner] + rank * self.block, owner

    def pooled(self, texts: list[bytes]):
        """Per text the maximum and mean over its blocks of the blocks' maxima; texts must not be empty."""
        steps, firsts = self.windows(texts)
        answers = np.maximum(self.answers(steps), 0)
        answers[firsts[1:-1] - 1] = 0  # windows across two texts
        starts, owner = self.blocks(firsts)
        high = np.maximum.reduceat(answers, starts, axis=0)
        first = np.searchsorted(owner, np.arange(len(texts)))
        count = np.bincount(owner, minlength=len(texts))[:, None]
        top = np.maximum.reduceat(high, first, axis=0)
        mean = np.add.reduceat(high, first, axis=0) / count
        return np.hstack([top, mean]).astype(np.float32), (steps, starts, owner, answers, high, first, count)

    def score(self, texts: list[bytes], budget: int = 1 << 17) -> np.ndarray:
        """Probabilities; texts are taken together up to ``budget`` bytes, longer ones in pieces."""
        out = np.full(len(texts), 1 / (1 + np.exp(-self.intercept)))
        group: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if not t:
                continue
            if len(t) > budget:
                out[i] = self._logistic(self._long(t, budget))[0]
                continue
            if size + len(t) > budget:
                out[group] = self._logistic(self.pooled([texts[g] for g in group])[0])
                group, size = [], 0
            group.append(i)
            size += len(t)
        if group:
            out[group] = self._logistic(self.pooled([texts[g] for g in group])[0])
        return out

    def _long(self, text: bytes, budget: int) -> np.ndarray:
        """Pooled features of one long text, block by block in bounded memory."""
        size = STEP * self.block
        span = max(1, budget // size) * size
        top, total, count = 0.0, 0.0, 0
        for at in range(0, len(text), span):
            part, _ = self.windows([text[at : at + span + STEP]])
            answers = np.maximum(self.answers(part), 0)[: span // STEP]
            high = np.maximum.reduceat(answers, np.arange(0, len(answers), self.block), axis=0)
            top, total, count = np.maximum(top, high.max(axis=0)), total + high.sum(axis=0), count + len(high)
        return np.hstack([top, total / count])[None, :].astype(np.float32)

    def _logistic(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights + self.intercept, -60, 60)))

    def gradients(self, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weighted logistic loss; only windows that won a block carry any."""
        features, (steps, starts, owner, answers, high, first, count) = self.pooled(texts)
        delta = ((self._logistic(features) - labels) * weight / len(texts)).astype(np.float32)
        n = self.bias.size
        grad_high = (delta[:, None] * self.weights[n:] / count)[owner]
        ends = np.append(first[1:], len(owner))
        for t in range(len(texts)):
            rows = first[t] + high[first[t] : ends[t]].argmax(axis=0)
            grad_high[rows, np.arange(n)] += delta[t] * self.weights[:n]
        grad_high[high <= 0] = 0
        stops = np.append(starts[1:], len(answers))
        won = np.empty_like(high, dtype=np.int64)
        for k, (a, z) in enumerate(zip(starts, stops, strict=True)):
            won[k] = a + answers[a : min(z, a + self.block)].argmax(axis=0)
        used, inverse = np.unique(won.ravel(), return_inverse=True)
        grad = np.zeros((len(used), n), np.float32)
        np.add.at(grad, (inverse, np.tile(np.arange(n), len(high))), grad_high.ravel())
        d_embedding = np.zeros_like(self.embedding)
        d_filters = []
        for half in range(2):
            codes = steps[used + half]
            x = self.embedding[codes.ravel()].reshape(len(used), -1)
            d_filters.append(x.T @ grad)
            back = (grad @ self.filters[half].T).reshape(-1, self.embedding.shape[1])
            for d in range(back.shape[1]):
                d_embedding[:, d] += np.bincount(codes.ravel(), back[:, d], 256)
        return [d_embedding, np.stack(d_filters), grad.sum(axis=0), features.T @ delta, np.float32(delta.sum())]

    def fit(self, texts: list[bytes], labels: np.ndarray, epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 11) -> Network:
        """Adam on the logistic loss, both labels weighing the same in total."""
        keep = [i for i, t in enumerate(texts) if t]
        texts, labels = [texts[i] for i in keep], np.asarray(labels, np.float32)[keep]
        if len(texts) == 0 or len(set(labels.tolist())) < 2:
            self.weights[:] = 0
            return self
        weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
        rng = np.random.default_rng(seed)
        values = [self.embedding, self.filters, self.bias, self.weights, np.zeros(1, np.float32)]
        first, second, t = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        total = epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                found = self.gradients([texts[i] for i in rows], labels[rows], weight[rows])
                t += 1
                pace = rate * (1 - (t - 1) / total)
                for v, g, m, s in zip(values, found, first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= pace * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
                self.intercept = float(values[4][0])
        self.trained = True
        return self


def training_sample(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", folds: int = 5, held_out: int = 0, sample_rows: int = 3000, sample_chars: int = 12_000) -> DataFrame:
    """(text, label) of at most ``sample_rows`` labelled rows outside the held-out fold."""
    known = pick(labels, id=id, label=label).where("id is not null and label is not null")
    known = known.where(F.pmod(F.crc32(F.col("id").cast("string")), F.lit(folds)) != held_out)
    chosen = known.groupBy("id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    third = sample_chars // 3
    middle = (F.length("text") - third).cast("int") / 2
    windows = F.concat_ws("\n", F.substring("text", 1, third), F.substring(F.col("text"), middle.cast("int"), F.lit(third)), F.substring("text", -third, third))
    cut = F.when(F.length("text") > sample_chars, windows).otherwise(F.col("text"))
    texts = pick(docs, id=id, text=text).where("text <> ''").withColumn("text", cut)
    # the chosen rows are at most sample_rows ids and labels: a proven bound for the broadcast
    return texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label")).orderBy("id").select("text", "label")


def train(docs: DataFrame, labels: DataFrame, **sample) -> Network:
    rows = training_sample(docs, labels, **sample).collect()
    return Network.fresh().fit([r.text.encode() for r in rows], np.array([r.label for r in rows], np.float32))


def score(docs: DataFrame, network: Network, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score) for every row of ``docs``."""
    import pyarrow as pa

    prepare(docs.sparkSession)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in sliced(batches):
            texts = [t.encode() if t else b"" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(network.score(texts), pa.float64())], names=["id", "score"])

    rows = pick(docs, id=id, text=text)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scored, f"id {kind}, score double")


def keep_good(docs: DataFrame, network: Network, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose score reaches the threshold."""
    import pyarrow as pa

    prepare(docs.sparkSession)
    at = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in sliced(batches):
            texts = [t.encode() if t else b"" for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(network.score(texts) >= threshold))

    rows, names = plain(docs)
    return rows.mapInArrow(kept, rows.schema).toDF(*names)


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_out: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    prepare(spark)
    network = train(docs, labels, folds=folds, held_out=held_out)
    fold = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(folds))
    return score(docs, network).select(
        F.col("id").alias("doc_id"), F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )
