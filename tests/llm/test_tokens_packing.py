import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import common, keyed, packing, tokenfiles
from quarryline.llm.tokens import Encoder, vocabulary

from .conftest import frame, prose

VOCABULARIES = [("byte_bpe_50k.json", 2), ("word_bpe_49k.json", 4)]
TEXT = st.text(st.sampled_from(list("ab Zé'.,!\n\t 1<|>\x00\x1c\xa0　ſΣς日")) | st.characters(codec="utf-8"), max_size=60)


@pytest.fixture(scope="module", params=VOCABULARIES, ids=lambda v: v[0])
def encoder(request):
    return Encoder(vocabulary(request.param[0]), request.param[1])


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(TEXT | st.just("a <|endoftext|> b") | st.just("we'll don't 'S"), max_size=5))
def test_encoder_equals_library(encoder, texts):
    found = list(encoder.many(texts))
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_cache_turnover():
    e = Encoder(vocabulary("byte_bpe_50k.json"), 2, entries=50)
    texts = [prose(i, 200) + ". Été!!\nNew" for i in range(30)]
    for text, ids in zip(texts, e.many(texts, group=3), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == e.tokenizer.encode(text, add_special_tokens=False).ids


def reference(name, text, end):
    from tokenizers import Tokenizer

    return np.array([*Tokenizer.from_file(vocabulary(name)).encode(text or "", add_special_tokens=False).ids, end], "<u4")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 512), max_size=80))
def test_windows(sizes):
    found = packing.windows_of(sizes)
    assert sorted(i for w in found for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= packing.CAPACITY for w in found)
    if len(sizes) >= 60:
        fills = [sum(sizes[i] for i in w) for w in found]
        assert max(fills) - min(fills) <= max(sizes)


def test_window_count_rises():
    assert len(packing.windows_of([1500, 1500, 1500])) == 3


def test_packing(spark, edge_rows):
    rows = edge_rows[2:] + [(100 + i, prose(i, 50 + 37 * i % 900)) for i in range(60)]
    rows = [r for r in rows if r[0] != 7] + [(7, prose(3, 60))]
    found = packing.packed(spark, frame(spark, rows)).collect()
    texts = dict(rows)
    for doc in texts:
        own = sorted((r for r in found if r.doc_id == doc), key=lambda r: r.start)
        ids = reference("word_bpe_49k.json", texts[doc], 1)
        at = 0
        for r in own:
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 2048


def test_packing_keeps_repeats_and_null_ids(spark, edge_rows):
    found = packing.pack(spark, frame(spark, edge_rows), vocabulary("word_bpe_49k.json"), 1).collect()
    assert len({(r.sequence_id, r.offset) for r in found if r.id == 7}) == 2
    assert any(r.id is None for r in found)
    for r in found:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
    assert packing.packed(spark, frame(spark, [])).count() == 0


def test_little_padding(spark):
    rows = [(i, prose(i, 30 + (i * 7919) % 700)) for i in range(400)]
    found = packing.packed(spark, frame(spark, rows).coalesce(1)).collect()
    assert sum(r.length for r in found) >= 0.98 * 2048 * len({r.sequence_id for r in found})


def test_binary_round_trip(spark, edge_rows):
    rows = [r for r in edge_rows if r[0] is not None and r[0] != 7] + [(-5, "negative"), (2**62, "far")]
    found = {r.doc_id: r for r in keyed.stored_texts(spark, frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    start = 0
    for doc, text in sorted(rows):
        ids = reference("byte_bpe_50k.json", text, 2)
        r = found[doc]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_binary_repeats_nulls_and_empty(spark, edge_rows):
    found = keyed.stored_texts(spark, frame(spark, edge_rows)).collect()
    assert len(found) == len(edge_rows) and len({r.start for r in found}) == len(edge_rows)
    assert min(r.start for r in found if r.doc_id is None) == 0
    assert keyed.stored_texts(spark, frame(spark, [])).count() == 0


@pytest.mark.parametrize("ranges", [True, False])
@pytest.mark.parametrize("end", [2, 50000])
def test_keyed_access_to_payloads(spark, tmp_path, ranges, end):
    """Ids come from the byte ranges that slots name; end ids may have any bytes; unknown keys are refused."""
    path = str(tmp_path / "shards")
    rows = [(i, prose(i, 20)) for i in range(50)] + [(7, prose(7, 20)), (None, "x")]
    keyed.write_shards(spark, frame(spark, rows), path, vocabulary("byte_bpe_50k.json"), end, shard_bytes=1000, most_bytes=400)
    stored = common.materialize(keyed.stored_keys(spark, path), "stored")
    assert stored.select("shard").distinct().count() > 10
    index, buckets = keyed.build_index(spark, stored, bucket_keys=16)
    asked = spark.createDataFrame([(3, 0), (49, 0), (50, 0), (3, 1), (7, 0), (7, 1), (7, 2), (None, 0), (None, 1)], "id long, copy long")
    found = keyed.look_up(asked, index, buckets)
    read = keyed.read_ids(spark, found, path, end, ranges=ranges).collect()
    assert sorted(((r.id or 0), r.copy) for r in read) == [(0, 0), (3, 0), (7, 0), (7, 1), (49, 0)]
    for r in read:
        text = "x" if r.id is None else prose(r.id, 20)
        assert r.ids == reference("byte_bpe_50k.json", text, end).tobytes() and r.crc == zlib.crc32(r.ids)
    with pytest.raises(Exception, match="holds no document"):
        keyed.read_ids(spark, found.withColumn("offset", found["offset"] + 1), path, end, ranges=ranges).collect()


def test_corrupted_fingerprints_are_refused(spark):
    stored = spark.createDataFrame([(i, 0, 1, 10 * i, 10) for i in range(100)], "id long, copy long, shard long, offset long, n long")
    index, buckets = keyed.build_index(spark, stored, bucket_keys=30)
    asked = stored.select("id", "copy")
    assert keyed.look_up(asked, index, buckets).count() == 100
    flipped = index.toPandas()
    flipped["fp"] = [bytes(b ^ 255 for b in fp) for fp in flipped["fp"]]
    assert keyed.look_up(asked, spark.createDataFrame(flipped, index.schema), buckets).count() == 0


@pytest.mark.parametrize("cut", [1, 3, 1000])
def test_copies_across_shards(spark, tmp_path, cut):
    ids = [None] * 5 + [1] * 7 + [2] + [3] * 4 + [4, 5, 5]
    rows = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string").repartition(3)
    keyed.write_shards(spark, rows, str(tmp_path / "s"), vocabulary("byte_bpe_50k.json"), 2, shard_bytes=10**9, most_bytes=cut * 6)
    found = keyed.stored_keys(spark, str(tmp_path / "s")).collect()
    assert sorted(((r.id or 0), r.copy) for r in found) == sorted((i or 0, ids[:k].count(i)) for k, i in enumerate(ids))


def test_ids_that_are_no_integers_are_refused(spark):
    rows = spark.createDataFrame([("a", "b")], "doc_id string, text string")
    for run in (keyed.stored_texts, tokenfiles.token_counts):
        with pytest.raises(TypeError, match="integers"):
            run(spark, rows)


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_is_minimal(keys):
    h = np.array(sorted(keys), np.uint64)
    levels, slots = keyed.build_levels(h)
    assert sorted(slots.tolist()) == list(range(len(h)))
    assert (keyed.find_slots(h, levels) == slots).all()


def test_perfect_hash_with_equal_hashes():
    _, slots = keyed.build_levels(np.array([5, 5, 9], np.uint64))
    assert sorted(slots.tolist()) == [0, 1, 2]


def test_token_counts(spark, edge_rows):
    rows = [(-1 if i is None else i, t) for i, t in edge_rows if i != 7 and (i is not None or t)]
    found = {r.doc_id: r for r in tokenfiles.token_counts(spark, frame(spark, rows)).collect()}
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    t.encode_special_tokens = True
    for doc, text in rows:
        assert found[doc].n_tokens == len(t.encode(text or "", add_special_tokens=False).ids)
    assert sorted(r.document for r in found.values()) == list(range(len(rows)))
    assert tokenfiles.token_counts(spark, frame(spark, [])).count() == 0
    assert tokenfiles.token_counts(spark, frame(spark, edge_rows)).where("doc_id is null").count() == 2


@pytest.mark.parametrize("cut", [1, 2, 3, 7, 1000])
def test_documents_across_files(spark, tmp_path, cut):
    rng = np.random.default_rng(cut)
    sizes = [0, 5, 1, 0, 23, 2, 40, 0, 3]
    stream = np.concatenate([np.append(rng.integers(0, 9, n), 9) for n in sizes] + [rng.integers(0, 9, 4)]).astype("<u2")
    for i, at in enumerate(range(0, len(stream), cut)):
        folder = tmp_path / "flat" / f"shard={i}"
        folder.mkdir(parents=True)
        (folder / "part-0.txt").write_bytes(stream[at : at + cut].tobytes() + b"\n")
    found = tokenfiles.count_tokens(spark, str(tmp_path / "flat"), 9, head=0).orderBy("document").collect()
    assert [(r.ids, r.ended) for r in found] == [(n + 1, True) for n in sizes] + [(4, False)]
    assert [r.start for r in found] == np.concatenate([[0], np.cumsum([n + 1 for n in sizes])]).tolist()


@given(st.integers(-(2**63), 2**63 - 1) | st.none(), st.sampled_from([49407, 50256, 7200]))
def test_key_digits(key, base):
    digits = tokenfiles.key_digits(key, base)
    assert all(0 <= d < base for d in digits) and tokenfiles.key_of(digits, base) == key
