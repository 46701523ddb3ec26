import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from quarryline.llm import brown, common, quality

from .conftest import frame, prose


def brute_base(rows):
    train = [(t or "").encode().lower().split() for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t)
    n, v = sum(counts.values()) + len(train), len(counts) + (len(train) > 0)
    out = []
    for i, t in rows:
        words = (t or "").encode().lower().split()
        c = [counts[w] for w in words] + [len(train)]
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        out.append((i, held, len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 1) / (n + v + 1)) for x in c)))
    return out


def language(seed, words):
    """Words of two kinds in turn: a class model can learn that."""
    rng = random.Random(seed)
    return " ".join(f"{'n' if i % 2 else 'v'}{int(rng.paretovariate(0.6)) % 3000}{'oun' if i % 2 else 'erb'}" for i in range(words))


def test_base_scores_and_gain(spark, edge_rows):
    rows = edge_rows + [(1000 + i, language(i, 120)) for i in range(300)]
    found = brown.scored_documents(spark, frame(spark, rows)).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    expected = sorted(brute_base(rows), key=key)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=key)
    for a, b in zip(got, expected, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * abs(b[5])
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)


def test_scores_equal_brute_force(spark, edge_rows, monkeypatch):
    """Scores recomputed word by word from the words' classes and all training texts."""
    monkeypatch.setattr(brown, "FREQUENT", 100)
    rows = [(i, t) for i, t in edge_rows if i not in (None, 7)] + [(1000 + i, language(i, 80)) for i in range(150)]
    docs = frame(spark, rows)
    common.prepare(spark)
    chunks = common.materialize(brown.chunked(docs, "doc_id", "text", 7, 2, chunk_bytes=3000), "chunks")
    listed = chunks.selectExpr("explode(arrays_zip(words, counts)) AS w").selectExpr("w.words AS word", "w.counts AS n").where("n > 0")
    counts = common.materialize(listed.groupBy("word").agg({"n": "sum"}).withColumnRenamed("sum(n)", "c"), "counts")
    model, words = brown.train(chunks, counts, 2)
    own = {bytes(r.word): r["class"] for r in words.collect()}
    end = model.classes[model.end]

    def kind(w):
        return own[w] if w in own else model.classes[model.end + 1 + zlib.crc32(w[-4:]) % brown.FORMS]

    train = [(t or "").encode().lower().split() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for t in train for w in t)
    assert set(own) == set(count) and sum(c >= 2 for c in count.values()) > 500
    matrix, tokens, types = Counter(), Counter(), Counter(kind(w) for w in count)
    types[end] += 1
    for t in train:
        kinds = [kind(w) for w in t] + [end]
        tokens.update(kinds)
        matrix.update(zip([end, *kinds], kinds))
    after, into, total = Counter(), Counter(), sum(matrix.values())
    for (a, b), n in matrix.items():
        after[a] += n
        into[b] += n
    once, twice = sum(c == 1 for c in count.values()), sum(c == 2 for c in count.values())
    cut, n, v = once / (once + 2 * twice), sum(count.values()) + len(train), len(count) + 1
    found = {r.doc_id: r.score for r in brown.language_scores(spark, docs, floor=2).withColumnRenamed("id", "doc_id").collect()}
    for i, t in rows:
        before, score = end, 0
        for w in [*(t or "").encode().lower().split(), None]:
            k, c = (end, len(train)) if w is None else (kind(w), count[w])
            base = (c + 1) / (n + v + 1) / (1 if c else brown.CLASSES)
            emission = (c - cut) / tokens[k] if c else cut * types[k] / tokens[k] if tokens[k] else 1
            score += math.log10(brown.WEIGHT * (matrix[before, k] + 10 * into[k] / total) / (after[before] + 10) * emission + (1 - brown.WEIGHT) * base)
            before = k
        assert abs(found[i] - score) < 1e-6 * abs(score)


def test_words_choose_the_likeliest_class(spark):
    """The second step on its own: each word's class has the best score over its neighbours' classes."""
    rng = np.random.default_rng(2)
    k = brown.CLASSES
    model = brown.ClassModel({}, np.zeros(1, int), brown.smoothed(rng.integers(0, 50, (k, k)).astype(float)), None, None, 0.5, 1, 1, 1)
    share = rng.integers(1, 900, k).astype(float)
    rows, sums = [], {}
    for w in range(300):
        for _ in range(rng.integers(1, 5)):  # one row a chunk
            at, n = rng.choice(2 * k, 6, replace=False), rng.integers(1, 256, 6)
            rows.append((w, np.column_stack([at, n]).astype(np.uint8).tobytes()))
            np.add.at(sums.setdefault(w, np.zeros(2 * k)), at, n)
    found = brown.chosen(spark.createDataFrame(rows, "name long, near binary"), model, share).collect()
    assert len(found) == 300
    for r in found:
        s = sums[r.name]
        scores = [sum(s[k + j] * math.log(model.transition[c, j]) + s[j] * (math.log(model.transition[j, c]) - math.log(share[c])) for j in range(k)) for c in range(k)]
        assert scores[r["class"]] >= max(scores) - 1e-6


def test_counts_of_neighbours(spark):
    """Neighbours' classes over a chunk, counts above 255 in several pairs."""
    docs = frame(spark, [(3, "x " * 700 + "b c"), (10, "a rare x b"), (11, "")])
    common.prepare(spark)
    chunks = brown.chunked(docs, "doc_id", "text", 7, 10)
    classes = np.arange(2 + 1 + brown.FORMS) % brown.CLASSES
    model = brown.ClassModel({b"b": 0, b"a": 1}, classes, None, None, None, 0, 0, 0, 0)
    found = Counter()
    for r in brown.contexts(chunks, model).collect():
        for at, n in zip(r.near[::2], r.near[1::2], strict=True):
            found[bytes(r.word), at] += n
    kind = lambda w: int(classes[{"b": 0, "a": 1, None: 2}.get(w, 3 + zlib.crc32((w or "").encode()[-4:]) % brown.FORMS)])
    expected = Counter()
    for text in ("x " * 700 + "b c", "a rare x b"):
        words = [None, *text.split(), None]
        for before, w, after in zip(words, words[1:], words[2:], strict=False):
            if w not in ("a", "b", None):
                expected[w.encode(), kind(before)] += 1
                expected[w.encode(), brown.CLASSES + kind(after)] += 1
    assert found == expected and max(found.values()) > 600


def test_small_chunks_give_the_same(spark, edge_rows, monkeypatch):
    rows = frame(spark, edge_rows)
    whole = sorted((str(r.doc_id), r.n_tokens, round(r.score, 9)) for r in brown.scored_documents(spark, rows).collect())
    monkeypatch.setattr(brown, "CHUNK_BYTES", 100)
    cut = brown.chunked
    monkeypatch.setattr(brown, "chunked", lambda *a: cut(*a, chunk_bytes=100))
    assert sorted((str(r.doc_id), r.n_tokens, round(r.score, 9)) for r in brown.scored_documents(spark, rows).collect()) == whole


def test_scores_of_nothing(spark):
    assert brown.scored_documents(spark, frame(spark, [])).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = brown.scored_documents(spark, frame(spark, [(held, "a b")])).first()
    assert (row.base_score, row.score, row.train_tokens, row.n_known) == (0, 0, 0, 0)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    classes = rng.integers(0, brown.CLASSES, 500)
    count = rng.integers(1, 20, 500)
    tokens = np.bincount(classes, count, brown.CLASSES)
    types = np.bincount(classes, minlength=brown.CLASSES).astype(float)
    matrix = rng.random((brown.CLASSES, brown.CLASSES))
    model = brown.ClassModel({}, classes, matrix / matrix.sum(axis=1, keepdims=True), tokens, types, 0.6, int(count.sum()), 500, 1)
    own = np.concatenate([classes, np.arange(brown.CLASSES)])
    c = np.concatenate([count, np.zeros(brown.CLASSES, int)])
    for before in (0, 5):
        total = brown.probabilities(model, np.full(len(own), before), own, c).sum()
        assert abs(total - 1) < 1e-9


def likelihood(pairs, own):
    k = own.max() + 1
    m = np.zeros((k, k))
    np.add.at(m, (own[:, None], own[None, :]), pairs)
    return brown._xlogx(m).sum() - brown._xlogx(m.sum(axis=0)).sum() - brown._xlogx(m.sum(axis=1)).sum()


def test_exchange_reaches_a_local_optimum():
    rng = np.random.default_rng(1)
    kinds = np.arange(24) % 3
    pairs = rng.poisson(30 * (kinds[:, None] + 1 == kinds[None, :]) + 30 * ((kinds[:, None] == 2) & (kinds[None, :] == 0)) + 1)
    own = brown.exchange(pairs, 3, 50)
    best = likelihood(pairs, own)
    for w in range(24):
        for c in range(3):
            other = own.copy()
            other[w] = c
            assert likelihood(pairs, other) <= best + 1e-6
    assert all(len(set(own[kinds == k])) == 1 for k in range(3))


def junk(seed):
    return " ".join(f"{w}***" for w in prose(seed, 40).split())


def labelled(spark, n=400):
    rows = [(i, junk(i) if i % 4 == 0 else prose(i, 60)) for i in range(n)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0, "x") for i, _ in rows] + [(None, 1, 0, "x"), (5, None, 0, "x"), (6, 1, 1, "y"), (99999, 0, 0, "z")], "doc_id long, quality int, toxic int, id string")
    return rows, labels


def test_quality_on_held_out_rows(spark, edge_rows):
    rows, labels = labelled(spark)
    docs = frame(spark, rows + [(None if i is None else 5000 + i, t) for i, t in edge_rows])
    found = quality.quality_scores(spark, docs, labels).collect()
    assert len(found) == len(rows) + len(edge_rows) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id < 5000]
    assert held and all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    right = np.mean([r.predicted == int(r.doc_id % 4 != 0) for r in held])
    assert right >= 0.97
    assert all(r.predicted == int(r.score >= 0.3) for r in found)


def test_quality_without_labels(spark):
    rows, labels = labelled(spark, 20)
    empty = labels.limit(0)
    assert {r.score for r in quality.quality_scores(spark, frame(spark, rows), empty).collect()} == {0.5}
    assert quality.quality_scores(spark, frame(spark, []), labels).count() == 0


def test_good_rows_stay(spark, edge_rows):
    rows, labels = labelled(spark)
    network = quality.train(frame(spark, rows), labels)
    found = quality.keep_good(frame(spark, rows), network)
    kept = {r.doc_id for r in found.collect()}
    assert found.columns == frame(spark, []).columns
    assert len(kept & {i for i, _ in rows if i % 4}) >= 299 and len(kept & {i for i, _ in rows if i % 4 == 0}) <= 3


@pytest.mark.parametrize("length", [1, 3, 4, 5, 255, 256, 257, 4000, 70_001])
def test_pieces_of_long_texts_score_alike(length):
    network = quality.Network.fresh()
    text = bytes(np.random.default_rng(length).integers(32, 120, length, dtype=np.uint8))
    whole = network.score([text], 1 << 20)[0]
    assert abs(network.score([text], 300)[0] - whole) < 1e-5
    assert abs(network.score([b"x", text, b"", b"yy"], 1 << 20)[1] - whole) < 1e-5


def test_network_equals_a_loop():
    """Every window, filter and block by plain loops."""
    network = quality.Network.fresh(dims=3, filters=5, block=7, seed=9)
    for length in (1, 4, 9, 131, 400):
        text = bytes(np.random.default_rng(length).integers(0, 256, length, dtype=np.uint8))
        steps = [text[i : i + 4].ljust(4, b"\0") for i in range(0, length, 4)] + [b"\0" * 4]
        answers = []
        for one, two in zip(steps, steps[1:]):
            row = []
            for f in range(5):
                x = float(network.bias[f])
                for half, step in enumerate((one, two)):
                    for place, byte in enumerate(step):
                        for d in range(3):
                            x += float(network.embedding[byte, d]) * float(network.filters[half, place * 3 + d, f])
                row.append(max(x, 0.0))
            answers.append(row)
        blocks = [[max(a[f] for a in answers[i : i + 7]) for f in range(5)] for i in range(0, len(answers), 7)]
        features = [max(b[f] for b in blocks) for f in range(5)] + [sum(b[f] for b in blocks) / len(blocks) for f in range(5)]
        z = sum(w * x for w, x in zip(network.weights.tolist(), features, strict=True)) + network.intercept
        assert abs(network.score([text])[0] - 1 / (1 + math.exp(-z))) < 1e-5


def test_every_byte_counts():
    network = quality.Network.fresh(seed=3)
    text = b"a" * 3000
    base = network.pooled([text])[0]
    for at in (0, 1234, 2999):
        changed = text[:at] + b"Z" + text[at + 1 :]
        assert np.abs(network.pooled([changed])[0] - base).max() > 0


def test_gradients():
    network = quality.Network.fresh(dims=3, filters=4, block=8, seed=5)
    for name in ("embedding", "filters", "bias", "weights"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    texts, labels, weight = [b"hello there world, this is", b"another text!", b"x" * 70], np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        z = np.array([quality.Network.pooled(network, [t])[0].astype(np.float64)[0] for t in texts]) @ network.weights + network.intercept
        return np.mean(np.log1p(np.exp(z)) - labels * z)

    found = network.gradients(texts, labels, weight)
    for value, grad in zip((network.embedding, network.filters, network.bias, network.weights), found, strict=False):
        flat, g = value.reshape(-1), np.asarray(grad).reshape(-1)
        for i in np.argsort(-np.abs(g))[:3]:
            keep = flat[i]
            flat[i] = keep + 1e-3
            up = loss()
            flat[i] = keep - 1e-3
            down = loss()
            flat[i] = keep
            assert abs((up - down) / 2e-3 - g[i]) < 2e-3 + 0.05 * abs(g[i])


def test_pipeline(spark, sf_dir):
    docs = common.table(spark, sf_dir, "documents")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "substring dedup", "benchmark decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = common.materialize(stage(spark, docs, sf_dir), "test")
        if name != "packing":
            assert docs.columns == columns and docs.count() <= before
            before = docs.count()
    assert {r.doc_id for r in docs.select("doc_id").collect()} == kept
    assert corpus_pipeline.run(spark, sf_dir).agg({"length": "sum"}).first()[0] == docs.agg({"length": "sum"}).first()[0]
