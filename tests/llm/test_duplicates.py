import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import common, neighbours, paragraphs, simhash

from .conftest import frame, prose


def brute_fingerprint(text, size):
    import xxhash

    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, tau):
    """Smallest id reachable, from {row: (id, fingerprint)}."""
    ids = sorted({i for i, _ in prints if i is not None})
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i, f in prints:
            for j, g in prints:
                if i is not None and j is not None and bin(f ^ g).count("1") <= tau and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_classes_equal_brute_force(spark, edge_rows):
    rng = random.Random(4)
    rows = list(edge_rows)
    for i in range(40):
        words = prose(i % 8, 120).split()
        for _ in range(i // 8):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        rows.append((100 + i, " ".join(words)))
    found = simhash.simhash_classes(spark, frame(spark, rows)).collect()
    assert len(found) == len(rows)
    prints = [(i, brute_fingerprint(t, 3)) for i, t in rows]
    expected = brute_classes(prints, 2)
    assert sorted((str(r.doc_id), r.fingerprint) for r in found) == sorted((str(i), f"{f:016x}") for i, f in prints)
    assert all(r.component_id == (None if r.doc_id is None else expected[r.doc_id]) for r in found)
    assert found and simhash.simhash_classes(spark, frame(spark, [])).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=2, max_size=25), st.integers(0, 3), st.randoms())
def test_plan_meets_every_close_pair(values, tau, rng):
    prints = [v ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(tau + 1))) for v in values for _ in range(3)]
    bits = np.array([[f >> b & 1 for b in range(64)] for f in prints], np.uint8)
    plan = simhash.exact_plan(bits, 10**6, tau)
    assert sum(plan.thresholds) == tau - len(plan.groups) + 1
    keys = [set(k.tolist()) for k in plan.keys(bits)]
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= tau:
                assert keys[i] & keys[j]


def dense(rng, n):
    """Fingerprints near one another and far from one another, all with the same upper bits."""
    near = [1 << 40 | int(x) for x in rng.choice(1 << 12, n, replace=False)]
    return near + [1 << 40 | int(x) << 13 for x in rng.choice(1 << 24, n // 2, replace=False)]


@pytest.mark.parametrize("block", [100, 10_000])
def test_hot_keys_are_split_and_exact(spark, block):
    prints = dense(np.random.default_rng(0), 300)
    rows = spark.createDataFrame([(1, f, 1, f) for f in prints] + [(2, 9999, 1, 0)], "key long, member long, weight long, s0 long")
    links = neighbours.hot_links(rows, ["s0"], neighbours.sketch_comparison(["s0"], 2, 1), block)
    found = {r.node: r.component for r in common.components(links).collect()}
    expected = brute_classes([(f, f) for f in prints], 2)
    assert all(found.get(f, f) == expected[f] for f in prints)


def test_hot_key_has_bounded_groups(spark, monkeypatch):
    """A key that a third of the rows share, most of them alike: no comparison is larger than a few blocks."""
    rng = np.random.default_rng(5)
    members = rng.choice(1 << 62, 30_000, replace=False)
    data = [(int(1 if i % 3 == 0 else 2 + i // 2), int(m), int(rng.integers(0, 3)) if i % 30 else int(m)) for i, m in enumerate(members)]
    rows = spark.createDataFrame(data, "key long, member long, s0 long").selectExpr("*", "1L AS weight")
    real, sizes = neighbours.sketch_comparison(["s0"], 1, 1), []

    def watched(groups):
        sizes.append(groups.groupBy("key", "part").count().agg({"count": "max"}).first()[0])
        return real(groups)

    links = common.materialize(neighbours.hot_links(rows, ["s0"], watched, 512), "links")
    assert max(s or 0 for s in sizes) < 3 * 512 and len(sizes) <= 6
    assert links.count() < 4 * len(data)
    alike = {m for i, (k, m, _) in enumerate(data) if k == 1 and i % 30}
    found = {r.node: r.component for r in common.components(links).collect()}
    assert len({found[m] for m in alike if m in found}) == 1 and alike <= set(found)


def test_heavy_payloads_are_split(spark):
    """Sets of a key beyond the part's bytes: the same components as all pairs."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 400)
    sets = [np.unique(np.where(rng.random(400) < (0.02 if i % 5 else 0.5), rng.integers(0, 1 << 62, 400), base)).astype(np.uint64) for i in range(60)]
    rows = spark.createDataFrame([(i % 2, i) for i in range(60)], "key long, member long")
    payloads = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(sets)], "member long, payload binary")
    label = list(range(60))
    for _ in range(3):
        for i in range(60):
            for j in range(i % 2, i, 2):
                if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])):
                    label[i] = label[j] = min(label[i], label[j])
    compare = neighbours.payload_comparison(paragraphs.jaccard(0.8))
    for block in (20_000, 1 << 30):
        found = {r.node: r.component for r in common.components(neighbours.key_links(rows, compare, payloads, block)).collect()}
        assert [found.get(i, i) for i in range(60)] == label and len(set(label)) < 40


def test_frequent_keys_are_found(spark, monkeypatch):
    monkeypatch.setattr(simhash, "FREQUENT", 2)
    prints = dense(np.random.default_rng(1), 200)
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(prints)], "id long, fp long")
    expected = brute_classes(list(enumerate(prints)), 2)
    for block in (80, 10_000):
        found = {r.fp: r.component for r in simhash.classes(rows, 2, block).collect()}
        assert all(found[f] == expected[i] for i, f in enumerate(prints))


@settings(max_examples=12, deadline=None)
@given(edges=st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), min_size=1, max_size=25))
def test_components(spark, edges):
    found = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert found == {n: label[n] for n in linked}


def test_long_chain(spark):
    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
    assert {r.component for r in common.components(edges).collect()} == {0}


def test_prefix_sums(spark):
    rows = spark.createDataFrame([(i * 3, i) for i in range(50)], "o long, n long")
    found = common.exclusive_prefix(rows, "o", {"before": "n"}, span=16).orderBy("o").collect()
    assert [r.before for r in found] == [i * (i - 1) // 2 for i in range(50)]


def test_id_filter_never_loses_ids(spark):
    rows = spark.range(2000).withColumnRenamed("id", "doc")
    ids = rows.where("doc % 7 = 0")
    maybe, sure = common.IdFilter(ids, "doc").split(rows, "doc")
    assert maybe.join(ids, "doc", "left_semi").count() == ids.count()
    assert maybe.count() + sure.count() == 2000


def test_one_of_each_group_stays(spark, edge_rows):
    rows = list(edge_rows)
    base = prose(50, 300, 5000)
    words = base.split()
    words[150] = "changed"
    rows += [(20, base), (21, base), (22, " ".join(words)), (23, prose(51, 300, 5000)), (24, prose(52, 300, 5000))]
    found = simhash.keep_one(spark, frame(spark, rows))
    assert found.columns == frame(spark, []).columns
    kept = [r.doc_id for r in found.select("doc_id").collect()]
    assert {20, 23, 24} <= set(kept) and not {21, 22} & set(kept)
    assert kept.count(7) == 1 and kept.count(None) == 2 and (5 in kept) and (6 not in kept)
    assert simhash.keep_one(spark, frame(spark, [])).count() == 0


def jaccard(a, b):
    return len(a & b) / len(a | b)


def split(text):
    """(place, words) of each line of eight words or more; shorter ones that follow each other are one."""
    out, short = [], []
    for place, line in enumerate([*(text or "").split("\n"), None]):
        words = line.lower().split(" ") if line is not None else []
        words = [w for w in words if w.strip("\t\r\x0b\x0c")]
        if (line is None or len(words) >= 8) and short:
            joined = [w for _, some in short for w in some]
            if len(joined) >= 8:
                out.append((short[0][0], joined))
            short = []
        if len(words) >= 8:
            out.append((place, words))
        elif words:
            short.append((place, words))
    return out


def shingles(words, size=5):
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute_removals(rows):
    """Paragraphs that are not the first of their class, by all pairs."""
    found = []
    for i, t in {(i, t) for i, t in rows if i is not None}:
        found += [(i, place, shingles(words)) for place, words in split(t)]
    found.sort(key=lambda x: x[:2])
    label = list(range(len(found)))
    for _ in found:
        for i, a in enumerate(found):
            for j in range(i):
                if jaccard(a[2], found[j][2]) >= 0.8:
                    label[i] = label[j] = min(label[i], label[j])
    repeats = {f[:2]: found[label[i]][:2] for i, f in enumerate(found) if label[i] != i}
    out = {}
    for i, t in {(i, t) for i, t in rows if i is not None}:
        run = []
        for place, words in [*split(t), (None, [])]:
            if (i, place) in repeats:
                run.append((place, len(words)))
            else:
                if sum(n for _, n in run) >= paragraphs.MIN_RUN:
                    out |= {(i, p): repeats[i, p] for p, _ in run}
                run = []
    return out


def corpus():
    rng = random.Random(8)
    shared = [prose(200 + i, 60, 3000) for i in range(5)]
    rows = []
    for d in range(40):
        lines = [prose(1000 + 10 * d + i, rng.randrange(3, 80), 3000) for i in range(rng.randrange(1, 6))]
        if d % 3 == 0:
            words = shared[d % 5].split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(60)] = "new"
            whole = " ".join(words)
            if d % 2:  # over several lines, one of them short
                whole = "\n".join([" ".join(words[:20]), " ".join(words[20:23]), " ".join(words[23:])])
            lines.insert(rng.randrange(len(lines) + 1), whole)
        if d % 4 == 0:
            lines.append(prose(77, 12))  # a short line that many share
        rows.append((d, "\n".join(lines)))
    return rows


def test_removals_equal_brute_force(spark, edge_rows):
    rows = corpus() + [(1000 + (i or 0), t) for i, t in edge_rows if i is not None]
    found = {(r.id, r.place): (r.keeper_id, r.keeper_place) for r in paragraphs.removals(spark, frame(spark, rows)).collect()}
    assert found == brute_removals(rows)


def test_cut_texts(spark, edge_rows):
    rows = corpus() + [(None, corpus()[0][1])] + [(1000 + (i or 0), t) for i, t in edge_rows if i is not None]
    gone = brute_removals(rows)
    found = paragraphs.without_repeats(spark, frame(spark, rows))
    assert found.columns == frame(spark, []).columns and found.count() == len(rows)
    texts = dict(rows)
    for r in found.toDF(*[f"c{i}" for i in range(len(found.columns))]).collect():
        doc, text, chars = r.c0, r.c1, r.c4
        if doc is None or texts[doc] is None:
            assert text == (texts[doc] if doc in texts and doc is not None else corpus()[0][1])
            continue
        assert text == "\n".join(line for i, line in enumerate(texts[doc].split("\n")) if (doc, i) not in gone)
        assert chars == len(text)
    assert paragraphs.without_repeats(spark, frame(spark, [])).count() == 0


def test_spans_are_offsets(spark):
    rows = [(1, "é " * 3 + "\n" + prose(1, 40)), (2, "x\n\n" + prose(1, 40))]
    r = paragraphs.removals(spark, frame(spark, rows)).first()
    assert rows[1][1][r.start : r.stop] == prose(1, 40) and (r.id, r.keeper_id, r.keeper_place) == (2, 1, 1)


def test_tuning():
    bands, rows = paragraphs.tune()
    assert bands * rows <= paragraphs.PERMUTATIONS and 1 - (1 - 0.8**rows) ** bands >= 0.995
    assert paragraphs.tune(4, 0.2, 0.9999) == (4, 1)


def test_wide_plan_keeps_its_recall_at_every_size():
    rng = np.random.default_rng(3)
    one = rng.integers(0, 2, (600, 1024)).astype(np.uint8)
    p = np.arccos(1.6 / 1.8) / np.pi  # share of bits in which pairs of Jaccard 0.8 differ
    other = one ^ (rng.random(one.shape) < p).astype(np.uint8)
    for total in (1_000, 200_000, 12_000_000, 10**9, 10**10):
        plan = simhash.wide_plan(one, total)
        widths = {len(g) for g in plan.groups}
        assert simhash.expected_recall(max(widths), len(plan.groups)) >= 0.99
        assert (plan.keys(one) == plan.keys(other)).any(axis=1).mean() >= 0.98
    sketches = one[:, : 64 * simhash.SKETCH] != other[:, : 64 * simhash.SKETCH]
    assert (sketches.sum(axis=1) <= simhash.SKETCH_RADIUS).all()


def test_near_copies_equal_brute_force(spark):
    """Edited copies of many texts around a similarity of 0.8: kept rows are those of all pairs."""
    rng = random.Random(12)
    rows = []
    for d in range(220):
        words = prose(9000 + d % 90, 80 + d % 90, 4000).split()
        for _ in range(d // 90 * rng.randrange(5)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
        rows.append((d, " ".join(words)))
    sets = {i: shingles(t.split()) for i, t in rows}
    close = [(i, j) for i in sets for j in range(i) if jaccard(sets[i], sets[j]) >= 0.8]
    label = {i: i for i in sets}
    for _ in range(4):
        for i, j in close:
            label[i] = label[j] = min(label[i], label[j])
    kept = {r.doc_id for r in simhash.keep_one(spark, frame(spark, rows)).select("doc_id").collect()}
    assert len(close) > 60 and kept == {i for i in label if label[i] == i}


def test_texts_of_one_id_are_told_apart(spark):
    rows = [(1, prose(1, 80)), (1, prose(2, 80)), (1, prose(1, 80)), (2, prose(2, 80)), (3, prose(3, 80)), (3, prose(4, 80))]
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_one(spark, frame(spark, rows)).toDF(*"abcdefghijk").selectExpr("a AS doc_id", "b AS text").collect())
    assert kept == sorted({(1, prose(1, 80)), (1, prose(2, 80)), (3, prose(3, 80)), (3, prose(4, 80))})
    prints = spark.createDataFrame([(1, 0), (1, 255), (2, 254), (3, 1 << 40)], "id long, fp long")
    assert {r.fp: r.component for r in simhash.classes(prints, 2).collect()} == {0: 1, 255: 1, 254: 1, 1 << 40: 1}


def test_links_are_exact_similarities(spark):
    """Texts below a Jaccard similarity of 0.8 stay however near their fingerprints are, those above go."""
    base = prose(60, 300, 5000).split()
    rows = [(0, " ".join(base))]
    for d in range(1, 13):
        words, edits = list(base), 8 if d <= 8 else 4
        for e in range(edits):
            words[e * 36 + d] = f"new{d}"
        rows.append((d, " ".join(words)))
    rows.append((13, " ".join(["spam ham eggs"] * 200)))  # its shingles are most of the next one's
    rows.append((14, " ".join(["spam ham eggs"] * 200) + " " + prose(61, 100, 5000)))
    sets = {i: shingles(t.split()) for i, t in rows}
    label = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            for j in range(i):
                if jaccard(sets[i], sets[j]) >= 0.8:
                    label[i] = label[j] = min(label[i], label[j])
    kept = {r.doc_id for r in simhash.keep_one(spark, frame(spark, rows)).select("doc_id").collect()}
    assert {*range(9), 13, 14} <= kept
    assert kept == {i for i in label if label[i] == i}


def brute_passages(rows):
    """Words (id, number) of texts in a run of 50 words that stands earlier too and not over itself."""
    first, gone = {}, set()
    for i, t in sorted(rows):
        words = t.lower().split()
        for at in range(len(words) - 49):
            run = tuple(words[at : at + 50])
            doc, was = first.setdefault(run, (i, at))
            if doc != i or at >= was + 50:
                gone |= {(i, k) for k in range(at, at + 50)}
    return gone


def test_passages_inside_lines(spark):
    shared = [prose(300 + i, n, 3000) for i, n in enumerate((49, 50, 53, 90, 64))]
    rows = []
    for d in range(24):
        around = [prose(400 + 2 * d + i, 40 + d, 3000) for i in range(2)]
        words = shared[d % 5].split()
        whole = " ".join(words) if d % 2 else "\n".join(" ".join(words[k : k + 6]) for k in range(0, len(words), 6))  # lines of six words
        rows.append((d, f"é  {around[0]} {whole} {around[1]}"))
    rows.append((50, "la " * 80))
    rows.append((51, "la " * 130))
    rows.append((52, " ".join([shared[3].upper(), prose(9, 20), shared[3], "\n", shared[4], "日本"])))
    found = paragraphs.passages(spark, frame(spark, rows)).collect()
    texts, gone = dict(rows), set()
    for r in found:
        before, span = texts[r.id][: r.start].split(), texts[r.id][r.start : r.stop]
        assert r.length == len(span.split()) >= 50 and r.keeper_id <= r.id and r.place == texts[r.id][: r.start].count("\n")
        gone |= {(r.id, len(before) + k) for k in range(r.length)}
    assert gone == brute_passages(rows) and len({i for i, _ in gone}) > 15
    whole = paragraphs.without_repeats(spark, frame(spark, rows), inside=True)
    left = {r.c0: r.c1 for r in whole.toDF(*[f"c{i}" for i in range(len(whole.columns))]).collect()}
    for i, t in rows:
        if i < 24 and i % 2:  # texts of long lines, which no other line is like
            assert left[i].split() == [w for k, w in enumerate(t.split()) if (i, k) not in gone]


def test_op9_reports_every_repeat_with_its_run(spark, tmp_path):
    from quarryline.llm import registry

    greeting, half, other = prose(500, 9), prose(501, 20, 3000), prose(502, 25, 3000)
    verse = [prose(510 + i, 5, 3000) for i in range(8)]
    edited = [*verse[:7], " ".join([*verse[7].split()[:4], "new"])]
    rows = [(1, "\n".join([prose(503, 40), greeting, half, prose(504, 30), other]))]
    rows += [(2, "\n".join([greeting, prose(505, 40), half, prose(506, 12), other]))]  # a run broken by one line
    rows += [(3, "\n".join([prose(507, 60), *verse])), (4, "\n".join([prose(508, 70), *edited]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r.doc_id, r.place): (r.length, r.keeper_doc_id, r.keeper_place) for r in registry.op9_paragraphs(spark, str(tmp_path)).collect()}
    assert found == {(2, 0): (9, 1, 1), (2, 2): (20, 1, 2), (2, 4): (25, 1, 4), (4, 1): (40, 3, 1)}
    cut = {r.c0: r.c1 for r in paragraphs.without_repeats(spark, frame(spark, rows)).toDF(*[f"c{i}" for i in range(11)]).collect()}
    assert cut[2] == rows[1][1] and cut[4] == prose(508, 70)  # only the pipeline's stage asks for runs of 30 words


def test_unfinished_components_are_an_error(spark):
    edges = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
    with pytest.raises(RuntimeError, match="2 rounds"):
        common.components(edges, max_rounds=2)


def test_keys_that_occur_twice():
    rng = np.random.default_rng(8)
    keys = np.sort(np.append(rng.integers(0, 1 << paragraphs.KEY_BITS, 5000, dtype=np.uint64), np.array([0, 0, (1 << paragraphs.KEY_BITS) - 1], np.uint64)))
    packed = list(paragraphs.packed_keys(keys))
    assert np.array_equal(np.concatenate([paragraphs.unpacked_keys(*x) for x in packed]), keys)


def shuffled(spark, work):
    """Bytes that the stages of ``work()`` wrote to shuffles."""
    store, last = spark.sparkContext._jsc.sc().statusStore(), spark.range(1).count()
    jvm = spark.sparkContext._jvm

    def stages():
        none = spark.sparkContext._gateway.new_array(jvm.double, 0)
        found = store.stageList(jvm.java.util.ArrayList(), False, False, none, jvm.java.util.ArrayList())
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteBytes() for i in range(found.size())}

    before = max(stages())
    work()
    return sum(n for stage, n in stages().items() if stage > before + last - 1)


def test_repeats_shuffle_little(spark):
    """Keys and shingle sets of lines are most of what the searches move."""
    rng = random.Random(21)
    lines = [prose(9000 + i, 40, 5000) for i in range(1500)]
    rows = []
    for d in range(1500):
        edited = lines[rng.randrange(300)].split()
        edited[rng.randrange(40)] = "new"
        rows.append((d, "\n".join([lines[d], " ".join(edited), *(prose(20_000 + 8 * d + i, 40, 5000) for i in range(6))])))
    size = sum(len(t) for _, t in rows)
    docs = frame(spark, rows)
    moved = shuffled(spark, lambda: paragraphs.removals(spark, docs).count())
    assert moved < 1.25 * size
