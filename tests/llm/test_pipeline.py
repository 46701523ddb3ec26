"""The five stages in a row, each held against brute force over what its predecessor kept."""

import glob
import os
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from quarryline.llm import common, quality, registry

from .conftest import DOCS, frame, prose
from .test_duplicates import brute_passages, brute_removals, jaccard, shingles
from .test_search_chat import fold
from .test_tokens_packing import reference


def junk(seed):
    return " ".join(f"{w}***" for w in prose(seed, 40).split())


def documents():
    """Prose, junk, copies, edited copies, shared lines and passages, benchmark passages, nulls and empty texts."""
    rows = [(i, junk(i) if i % 4 == 0 else prose(i, 70, 3000)) for i in range(160)]
    rows += [(200 + i, prose(i, 70, 3000)) for i in (1, 2, 3)]
    for i in (5, 6, 7):
        words = prose(i, 70, 3000).split()
        words[35] = "changed"
        rows.append((300 + i, " ".join(words)))
    line, passage, item = prose(901, 45, 3000), prose(902, 64, 3000), prose(903, 30, 3000)
    for i in range(4):
        rows.append((400 + i, "\n".join([prose(910 + i, 40, 3000), line, prose(920 + i, 30, 3000)])))
        rows.append((500 + i, f"{prose(930 + i, 35, 3000)} {passage} {prose(940 + i, 35, 3000)}"))
    rows += [(600, f"{prose(950, 60, 3000)} {item.upper()} end"), (601, " ".join(item.split()[:9]) + " " + prose(951, 60, 3000))]
    rows += [(None, prose(960, 50, 3000)), (700, None), (701, ""), (702, " \n "), (703, prose(961, 50, 3000)), (703, prose(961, 50, 3000)), (703, prose(962, 50, 3000))]
    return rows, item


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    _, item = documents()
    labels = [(i, int(i % 4 != 0), 0, "x") for i in range(160)] + [(None, 1, 0, "x"), (5, None, 0, "y")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, Doc string").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item, "x"), (2, None, "y"), (None, "", "z")], "item_id long, text string, note string").write.parquet(f"{base}/benchmark.parquet")
    return base


def pairs(df):
    """(id, text) of rows whatever other columns are called."""
    return [(r.c0, r.c1) for r in df.toDF(*[f"c{i}" for i in range(len(df.columns))]).collect()]


def expected_quality(spark, before, rows, folder):
    network = quality.train(before, common.table(spark, folder, "labels"))
    return [r for r in rows if network.score([(r[1] or "").encode()])[0] >= 0.3]


def expected_single(rows):
    named = sorted({(i, t) for i, t in rows if i is not None}, key=lambda r: (r[0], hash(r[1])))
    sets = [shingles((t or "").lower().split()) if (t or "").split() else {()} for _, t in named]
    root = list(range(len(named)))
    for _ in range(4):
        for a in range(len(named)):
            for b in range(a):
                if jaccard(sets[a], sets[b]) >= 0.8:
                    root[a] = root[b] = min(root[a], root[b])
    return [n for k, n in enumerate(named) if root[k] == k] + [r for r in rows if r[0] is None]


def expected_words(rows):
    named = [(i, t) for i, t in rows if i is not None]
    lines, words = brute_removals(named), brute_passages([(i, t or "") for i, t in named])
    out = []
    for i, t in rows:
        kept, k = [], 0
        for place, text in enumerate((t or "").split("\n")):
            for w in text.split():
                if i is None or ((i, place) not in lines and (i, k) not in words):
                    kept.append(w)
                k += 1
        out.append((i, kept))
    return out


def contaminated(text, item):
    own, asked = fold(text), fold(item)
    windows = {tuple(asked[a : a + 10]) for a in range(len(asked) - 9)}
    return any(tuple(own[a : a + 10]) in windows for a in range(len(own)))


def test_stages_equal_brute_force(spark, folder):
    rows, item = documents()
    docs = frame(spark, rows)
    stages = dict(corpus_pipeline.STAGES)

    def kept(name, docs):
        out = stages[name](spark, docs, folder)
        assert out.columns == docs.columns
        # names that differ by case only cannot be stored
        stored = common.materialize(out.toDF(*[f"c{i}" for i in range(len(out.columns))]), "stage").toDF(*out.columns)
        return stored, pairs(stored)

    key = lambda r: (str(r[0]), str(r[1]))
    after, found = kept("quality classifier", docs)
    assert sorted(found, key=key) == sorted(expected_quality(spark, docs, rows, folder), key=key)
    assert 0 < len(found) < len(rows)
    docs, before = after, found
    after, found = kept("SimHash near-dedup", docs)
    assert sorted(found, key=key) == sorted(expected_single(before), key=key) and len(found) < len(before)
    docs, before = after, found
    after, found = kept("substring dedup", docs)
    assert sorted(((i, (t or "").split()) for i, t in found), key=key) == sorted(expected_words(before), key=key)
    assert sum(len(t or "") for _, t in found) < sum(len(t or "") for _, t in before)
    docs, before = after, found
    after, found = kept("benchmark decontamination", docs)
    assert sorted(found, key=key) == sorted((r for r in before if not contaminated(r[1], item)), key=key)
    ids = {i for i, _ in found}
    assert 600 not in ids and 601 in ids
    packed = stages["packing"](spark, after, folder).collect()
    for i, t in found:
        own = sorted((r for r in packed if r.doc_id == i), key=lambda r: (r.start, r.length))
        if sum(x == i for x, _ in found) == 1:
            whole, at = reference("word_bpe_49k.json", t, 1), 0
            for r in own:
                assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(whole), zlib.crc32(whole[at : at + r.length].tobytes()))
                at += r.length
            assert at == len(whole)
    assert {r.doc_id for r in packed} == ids


@pytest.mark.parametrize("number", range(5))
def test_stages_of_an_empty_table(spark, folder, number):
    empty = spark.createDataFrame([], DOCS)
    name, stage = corpus_pipeline.STAGES[number]
    found = stage(spark, empty, folder)
    assert found.count() == 0 and (name == "packing" or found.columns == empty.columns)


def texts(rows):
    return sorted(str(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_equal_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(t)[:-8]} AS SELECT * FROM '{t}'")
    rows = registry.queries()[name](spark, sf_dir)
    columns = sorted(rows.columns)
    found = con.sql(registry.oracle_sql()[name])
    assert sorted(found.columns) == columns
    assert texts(rows.select(*columns).collect()) == texts(found.select(*[f'"{c}"' for c in columns]).fetchall())


def test_near_copies_of_a_sample_table(spark, sf_dir):
    """All pairs of the smallest table's documents: the stage keeps what brute force keeps."""
    docs = common.table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = [np.array(sorted({hash(s) for s in shingles((t or "").lower().split())})) for _, t in rows]
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    root = {k: k for k in order}
    for _ in range(4):
        for n, a in enumerate(order):
            for b in order[:n]:
                if min(len(sets[a]), len(sets[b])) < 0.8 * max(len(sets[a]), len(sets[b])):
                    continue
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                    low = min(root[a], root[b], key=lambda k: rows[k][0])
                    root[a] = root[b] = low
        if _ == 0 and all(root[k] == k for k in order):
            break
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, sf_dir).select("doc_id").collect())
    assert kept == sorted(rows[k][0] for k in order if root[k] == k)
