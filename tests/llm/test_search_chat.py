import hashlib
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.llm import chat, contamination, impact

from .conftest import frame, prose

VECTORS = "vec_id long, embedding array<float>, id string, v string, rank int, Embedding string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 3, "z") for i, v in rows], VECTORS)


def brute_nearest(rows, k=20):
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % 20 == 0:
            scored = sorted((-sum(map(lambda a, b: a * b, q, c)), j) for j, c in ok if j != i and len(c) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_nearest_with_ties_and_bad_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 16).round(1).tolist()) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(200, 260)]  # ties, queries among them
    rows += [(300, None), (301, []), (302, [None] * 16), (303, [float("nan")] * 16), (304, [float("inf")] * 16), (None, rows[0][1]), (320, [1.0, 2.0]), (321, [0.5, 2.0]), (340, [0.0] * 16)]
    found = sorted(tuple(r) for r in impact.nearest(spark, vectors(spark, rows)).collect())
    assert found == brute_nearest(rows)
    assert impact.nearest(spark, vectors(spark, [])).count() == 0
    assert impact.nearest(spark, vectors(spark, [(0, [1.0])])).count() == 0


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(impact, "CANDIDATES", 20)
    monkeypatch.setattr(impact, "QUERIES", 3)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.3, 8).tolist()) for i in range(130)]
    assert sorted(tuple(r) for r in impact.nearest(spark, vectors(spark, rows)).collect()) == brute_nearest(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 60), st.integers(0, 2**31), st.sampled_from([3, 100, 10**7, 2**40]))
def test_index_equals_products(k, n, seed, size):
    rng = np.random.default_rng(seed)
    c, q = (np.floor(rng.standard_t(1.5, (m, 6)).clip(-9, 9) * size) for m in (n, 4))
    ids = rng.permutation(n)
    for i, (query, found, scores) in enumerate(impact.ImpactIndex(ids, c).search(np.array([0, 1, 2, 10**6]), q, k)):
        row = [0, 1, 2, 10**6].index(query)
        exact = [(max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(q[row], v, strict=True)))), int(j)) for v, j in zip(c, ids, strict=True) if j != query]
        expected = sorted(exact, key=lambda x: (-x[0], x[1]))[:k]
        assert list(zip(scores.tolist(), found.tolist(), strict=True)) == expected


def test_scoring_stops_on_proof():
    rng = np.random.default_rng(3)
    c = np.floor(64 * rng.normal(0, 0.02, (4000, 32)))
    c[7] = 900
    index = impact.ImpactIndex(np.arange(4000), c)
    (_, found, _), = index.search(np.array([-1]), np.full((1, 32), 5.0), 1)
    assert found.tolist() == [7] and index.work < 200  # one segment, and the best of it again


def test_less_work_than_all_products():
    """On vectors of length one in 64 dimensions, the last segments are left out on proof."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(12_000, 64))
    c = np.floor(64 * x / np.linalg.norm(x, axis=1, keepdims=True))
    q = c[:100]
    index = impact.ImpactIndex(np.arange(len(c)), c)
    found = {i: (ids, scores) for i, ids, scores in index.search(np.arange(100), q, 20)}
    assert index.work < 0.9 * c.size * len(q)
    exact = q @ c.T
    for i in range(100):
        order = [j for j in np.lexsort((np.arange(len(c)), -exact[i])) if j != i][:20]
        assert found[i][0].tolist() == order and found[i][1].tolist() == exact[i][order].tolist()


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_report(docs, items):
    windows = {}
    for i, t in items:
        w = fold(t)
        for a in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[a : a + 10]), set()).add(i)
    out = []
    for doc, text in docs:
        w, hit, who = fold(text), set(), set()
        for a in range(len(w)):
            for n in range(1, 11):
                if tuple(w[a : a + n]) in windows and a + n <= len(w):
                    hit |= set(range(a, a + n))
                    who |= windows[tuple(w[a : a + n])]
        names = ",".join(sorted(str(i) for i in who if i is not None))
        out.append((doc, len(w), len(hit), len(who - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return out


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, item string, Text string")


@pytest.mark.parametrize("shard", [contamination.SHARD_WORDS, 10])
def test_contamination(spark, edge_rows, shard):
    long = [prose(500 + i, 40) for i in range(6)]
    items = [(i, t) for i, t in enumerate(long)] + [(10, "Solo"), (11, "É lan"), (12, ""), (13, None), (None, prose(700, 30)), (2, long[2]), (14, " ".join(long[0].split()[:20]))]
    docs = edge_rows + [(100 + i, f"Intro, {t.upper() if i % 2 else t.replace(' ', '  ')}!! end solo") for i, t in enumerate(long)]
    docs += [(200, " ".join(long[0].split()[:9])), (201, " ".join(long[1].split()[5:15])), (202, "é LAN é lan"), (203, prose(700, 30)), (204, "Solo\x00solo-SOLO")]
    found = contamination.contamination(spark, frame(spark, docs), benchmark(spark, items), shard_words=shard)
    names = F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
    rows = found.select("id", "n_words", "n_hit", F.size("items"), F.sha2(names, 256), F.col("n_hit") > 0).collect()
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, brute_report(docs, items)))
    texts = dict(docs)
    for r in found.where("n_hit > 0 and id is not null").collect():
        assert sum(len(fold(texts[r.id][s.start : s.stop])) for s in r.spans) == r.n_hit


def test_contamination_of_nothing(spark, edge_rows):
    assert contamination.contamination_report(spark, frame(spark, []), benchmark(spark, [])).count() == 0
    assert contamination.contamination_report(spark, frame(spark, edge_rows), benchmark(spark, [])).where("contaminated").count() == 0


def test_clean_rows_stay(spark, edge_rows):
    item = prose(900, 15)
    rows = edge_rows + [(300, item), (301, "so: " + item), (302, " ".join(item.split()[:9]))]
    found = contamination.without_benchmark(spark, frame(spark, rows), benchmark(spark, [(1, item)]))
    assert found.columns == frame(spark, []).columns
    assert sorted(str(r.doc_id) for r in found.collect()) == sorted(str(i) for i, _ in edge_rows + [(302, "")])


def cheapest(roles):
    """The least cost over all repairs, by search."""
    best = [10**9]

    def follow(state, extra):
        for r in extra:
            if r not in chat._NEXT[state]:
                return None
            state = r + 1
        return state

    inserts = [(), *((a,) for a in range(3)), *((a, b) for a in range(3) for b in range(3))]

    def go(i, state, cost):
        if cost >= best[0]:
            return
        if i == len(roles):
            for extra in inserts:
                if follow(state, extra) == 3:
                    best[0] = min(best[0], cost + chat.INSERT * len(extra))
            return
        for target in range(3):
            price = cost + (0 if target == roles[i] else chat.RELABEL)
            if state == target + 1:
                go(i + 1, state, price + chat.MERGE)
            for extra in inserts:
                after = follow(state, (*extra, target))
                if after is not None:
                    go(i + 1, after, price + chat.INSERT * len(extra))

    go(0, 0, 0)
    return best[0]


def legal(pieces):
    state = 0
    for role, action in pieces:
        place = chat.ROLES.index(role)
        if action == "merge":
            assert state == place + 1
        else:
            assert place in chat._NEXT[state]
            state = place + 1
    assert state == 3


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([-1, 0, 1, 2]), min_size=1, max_size=5), st.integers(0, 5))
def test_repair_is_cheapest(roles, cut):
    parts = [p for p in (roles[:cut], roles[cut:]) if p]
    ways = chat.chain([chat.matrix(p) for p in parts])
    out = []
    for i, (part, (before, after)) in enumerate(zip(parts, ways, strict=True)):
        out += chat.repaired([(r, "t") for r in part], before, after, i == len(parts) - 1)
    legal([(r, a) for r, a, _, _ in out])
    assert sum(c for *_, c in out) == cheapest(roles)
    assert [t for _, a, t, _ in out if a != "insert"] == ["t"] * len(roles)


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "z", 5) for r in rows], "conv_id long, turn long, role string, text string, conv string, block int, Role string, part int")


def conversations():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "Human ", "tool", None]), f"{c}-{t}") for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(77, t, rng.choice(["user", "assistant", None]), f"77-{t}") for t in range(300)]  # one conversation has most rows
    return rows + [(None, 0, "user", None), (None, None, "user", ""), (5, 0, "user", "5-0"), (5, 0, "user", "5-0")]


@pytest.mark.parametrize("block", [7, 10_000])
def test_conversations(spark, monkeypatch, block):
    rows = conversations()
    monkeypatch.setattr(chat, "BLOCK_ROWS", block)
    found = chat.repair(spark, turns(spark, rows), block_rows=block).orderBy("conv", "part", "piece").collect()
    for conv in {r[0] for r in rows}:
        own = [r for r in found if r.conv == conv]
        legal([(r.role, r.action) for r in own])
        whole = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        roles = [chat.role_place(r[2]) for r in whole]
        (_, _), = chat.chain([chat.matrix(roles)])
        m = chat.matrix(roles)
        assert sum(r.cost for r in own) == min(m[0][s] + chat.CLOSING[s][0] for s in range(4))
        texts = [r.fragment.split("\n", 1)[1] for r in own if r.action != "insert"]
        assert texts == [r[3] or "" for r in whole]


def test_pieces_are_numbered(spark):
    found = chat.formatted(spark, turns(spark, conversations()))
    counts = found.groupBy("conv_id").agg(F.count("*").alias("n"), F.max("piece").alias("m"), F.count_distinct("piece").alias("d")).collect()
    assert all(r.n == r.m + 1 == r.d for r in counts)
    assert chat.formatted(spark, turns(spark, [])).count() == 0


def test_rendering(spark):
    rows = [(1, 0, "assistant", "hi"), (1, 1, "user", "a"), (1, 2, "user", "b")]
    found = chat.formatted(spark, turns(spark, rows)).orderBy("piece").collect()
    assert "".join(r.fragment + "\n" for r in found).count("<|assistant|>") >= 1 and found[-1].role == "assistant"
