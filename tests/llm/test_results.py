"""Operators against plain versions, the tokenizers' own results, and held-out labels."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import landfall.llm.repeats as repeats
import landfall.llm.token_files as files
from landfall.llm import bwt_merge as bwt
from landfall.llm.bwt_merge import repeat_digest
from landfall.llm.cap_filters import vector_classes
from landfall.llm.catalog import QUERIES, SQL
from landfall.llm.components import components
from landfall.llm.language_id import parsing_table, phrases
from landfall.llm.simhash import SMALL_GROUP, simhash_classes
from landfall.llm.suffix_trees import deep_nodes, shared_window_digest
from landfall.llm.toxicity import segments
from tests.comparing import content

SF = "/root/testdata/sf0.01"


def documents(spark, sf_dir=SF):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def roots(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    got = content(QUERIES[name](spark, "/root/testdata/sf0.001").toArrow())
    want = content(con.sql(SQL[name]).to_arrow_table())
    assert got == want


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    ids = {i for e in edges for i in e}
    assert {r["node"]: r["component"] for r in found} == roots(ids, edges)
    assert len(found) == len(ids)


def test_vectors_in_groups_larger_than_a_block(spark, monkeypatch):
    import landfall.llm.cap_filters as caps

    monkeypatch.setattr(caps, "shared_buckets", lambda rows: __import__("landfall.llm.buckets", fromlist=["x"]).shared_buckets(rows, 7))
    random = np.random.default_rng(3)
    middle = random.standard_normal((4, 64))
    near = np.concatenate([m + random.standard_normal((n, 64)) * 0.2 for m, n in zip(middle, (40, 3, 2, 1))])
    vectors = np.concatenate([near, random.standard_normal((60, 64)), near[:5]]).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    want = roots(range(len(vectors)), zip(*np.nonzero(linked)))
    for r in vector_classes(frame).collect():
        assert r["n_links"] == linked[r["vec_id"]].sum()
        assert r["component_id"] == want[r["vec_id"]]


def plain_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    sums = [0] * 64
    for gram in grams:
        h = xxhash.xxh64_intdigest(gram, seed=42)
        for k in range(64):
            sums[k] += h >> k & 1
    return sum(1 << k for k in range(64) if sums[k] * 2 > len(grams))


def test_simhash_classes_by_comparing_all(spark):
    rows = documents(spark).collect()
    base = max(rows, key=lambda r: len(r["text"]))["text"].split()
    near = [(10_000 + k, " ".join([*base[:k], "x" * (k + 1), *base[k + 1 :]])) for k in range(0, len(base), max(1, len(base) // (2 * SMALL_GROUP)))]
    every = [(r["doc_id"], r["text"]) for r in rows] + near
    prints = {i: plain_print(t) for i, t in every}
    ids = sorted(prints)
    values = np.array([prints[i] for i in ids], np.uint64)
    links = [
        (ids[k], ids[j]) for k in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 3) if j > k
    ]
    want = roots(ids, links)
    found = simhash_classes(spark.createDataFrame(every, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in found} == prints
    assert {r["doc_id"]: r["component_id"] for r in found} == want


def plain_windows(docs):
    earliest = {}
    for i, words in sorted(docs.items()):
        for k in range(len(words) - 12):
            earliest.setdefault(tuple(words[k : k + 13]), i)
    out = {}
    for i, words in docs.items():
        gone = set()
        for k in range(len(words) - 12):
            if earliest[tuple(words[k : k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("class_spans", [20_000, 2])
def test_shared_windows_by_comparing_all(spark, monkeypatch, class_spans):
    monkeypatch.setattr(repeats, "CLASS_SPANS", class_spans)
    docs = {r["doc_id"]: r["text"].encode().split() for r in documents(spark, "/root/testdata/sf0.001").collect()}
    # The same words again and again, and a passage in the middle of other texts.
    docs |= {9001: [b"a", b"b"] * 20, 9002: [b"a", b"b"] * 9, 9003: [b"q%d" % k for k in range(40)]}
    docs |= {9010 + k: [b"u%d" % k, *docs[9003][k : k + 25], b"v%d" % k] for k in range(8)}
    rows = [(i, b" ".join(w).decode()) for i, w in docs.items()]
    found = shared_window_digest(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == plain_windows(docs)


def plain_repeats(docs):
    seen = Counter(t[k : k + 200] for t in docs.values() for k in range(len(t) - 199))
    out = {}
    for i, t in docs.items():
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out[i] = (len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("class_spans", [20_000, 2])
def test_repeats_by_comparing_all(spark, monkeypatch, class_spans):
    monkeypatch.setattr(repeats, "CLASS_SPANS", class_spans)
    docs = {r["doc_id"]: r["text"].encode() for r in documents(spark, "/root/testdata/sf0.001").collect()}
    own = "".join(chr(97 + (k * k * 7 + k // 3) % 26) for k in range(900)).encode()
    docs |= {9001: b"x" * 450, 9002: "né".encode() * 150, 9003: own, 9004: own[:199], 9005: own[50:260] + b"!" + own[300:500]}
    docs |= {9010 + k: b"u%d " % k + own[k * 30 : k * 30 + 320] + b" v%d" % k for k in range(8)}
    rows = [(i, t.decode()) for i, t in docs.items()]
    found = repeat_digest(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}
    assert got == plain_repeats(docs)


BINARY = st.binary(min_size=1, max_size=90).map(lambda b: bytes(97 + x % 2 for x in b))


@settings(max_examples=60, deadline=None)
@given(st.lists(BINARY, min_size=1, max_size=8), st.sampled_from([20, 40, 60]), st.sampled_from([30, 70, 1 << 18]))
def test_windows_of_merged_transforms_are_those_that_repeat(strings, window, shard):
    held, bwt.SHARD_BYTES = bwt.SHARD_BYTES, shard
    try:
        row, at = bwt.repeated_windows(strings, window)
    finally:
        bwt.SHARD_BYTES = held
    seen = Counter(s[k : k + window] for s in strings for k in range(len(s) - window + 1))
    want = [(i, k) for i, s in enumerate(strings) for k in range(len(s) - window + 1) if seen[s[k : k + window]] > 1]
    assert list(zip(row.tolist(), at.tolist())) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(BINARY, min_size=1, max_size=5), st.sampled_from([20, 40, 80]))
def test_interleaved_transforms_are_one_order_of_all_rotations(shards, depth):
    data = np.frombuffer(b"".join(shards), np.uint8)
    cuts = np.cumsum([0, *map(len, shards)])
    symbols = bwt.numbers_of(data, cuts)
    rotation = [s[k:] + s[:k] for s in shards for k in range(len(s))]
    first = [(r * 80)[:20] for r in rotation]
    assert [sorted(set(first)).index(f) for f in first] == symbols.tolist()
    parts = [bwt.transform(symbols[a:b], depth) for a, b in zip(cuts[:-1], cuts[1:])]
    for (order, before), a in zip(parts, cuts):
        assert before.tolist() == [symbols[a + (k - 20) % len(order)] for k in order.tolist()]
    elements, new = bwt.merged([t for _, t in parts], depth)
    place = np.concatenate([a + order for (order, _), a in zip(parts, cuts)])[elements]
    cut = [(rotation[p] * 90)[:depth] for p in place]
    assert cut == sorted(cut)
    if not new.all():
        assert [True, *(a != b for a, b in zip(cut, cut[1:]))] == new.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=6, max_size=80), st.integers(1, 5))
def test_deep_nodes_hold_equal_suffixes(words, size):
    import landfall.llm.suffix_trees as trees

    held, trees.GROUP_SUFFIXES = trees.GROUP_SUFFIXES, size
    try:
        words = np.array(words, np.uint64)
        suffixes = np.arange(len(words) - 4)
        nodes = [sorted(n.tolist()) for n in deep_nodes(words, suffixes, 5)]
    finally:
        trees.GROUP_SUFFIXES = held
    groups = {}
    for s in suffixes.tolist():
        groups.setdefault(tuple(words[s : s + 5].tolist()), []).append(s)
    assert sorted(nodes) == sorted(g for g in groups.values() if len(g) > 1)


@given(st.lists(st.floats(0.5, 5), min_size=1, max_size=9), st.data())
def test_segments_are_all_maximal_ones(scores, data):
    gaps = data.draw(st.lists(st.integers(0, 4), min_size=len(scores), max_size=len(scores)))
    at, place = [], 0
    for gap in gaps:
        place += gap
        at.append(place)
        place += 1
    values = [-0.7] * place
    for k, s in zip(at, scores):
        values[k] = s

    def best(low, high):
        """Maximal segments by their definition: the best one, then those to its left and right."""
        options = [(round(sum(values[i:j]), 9), i - j, i, j) for i in range(low, high) for j in range(i + 1, high + 1)]
        if not options or max(options)[0] <= 0:
            return []
        _, _, i, j = max(options)
        return [*best(low, i), (i, j), *best(j, high)]

    assert [s[:2] for s in segments(at, scores, -0.7, place)] == best(0, place)


@given(st.text("abc", min_size=1, max_size=40), st.text("abcd", min_size=1, max_size=60))
def test_phrases_are_longest_matches(trained, text):
    table = parsing_table([ord(c) - 97 for c in trained], 5)
    symbols = np.array([4 if c == "d" else ord(c) - 97 for c in text])
    count, match = 0, ""
    for letter in text:
        if match + letter in trained:
            match += letter
        else:
            count, match = count + 1, letter if letter in trained else ""
    assert phrases(symbols, np.array([0]), np.array([len(text)]), table)[0] == count


def held_out(spark, name, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")[label]
    rows = QUERIES[name](spark, SF).where("held_out").toPandas()
    rows = rows[rows["doc_id"].isin(labels.index)]
    return rows, labels[rows["doc_id"]].to_numpy()


def test_languages_of_held_out_rows(spark):
    want = {r["doc_id"]: r["lang"] for r in documents(spark).select("doc_id", "lang").collect()}
    rows = QUERIES["op2_language_id"](spark, SF).where("held_out").collect()
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in rows]) > 0.97


def test_quality_and_toxicity_of_held_out_rows(spark):
    rows, y = held_out(spark, "op3_quality", "quality")
    assert np.mean(rows["predicted"] == y) > 0.88
    rows, y = held_out(spark, "op7_toxicity", "toxic")
    assert np.mean(rows["predicted"] == y) > 0.88


def test_items_found_are_those_contained(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    want = {(r["doc_id"], i["item_id"]) for r in documents(spark).collect() for i in items if i["text"] in r["text"]}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontaminate"](spark, SF).collect()}
    assert want and found == want


def test_ids_are_those_of_the_library(spark):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in documents(spark).collect()}
    found = {r["doc_id"]: r for r in QUERIES["op5_sentencepiece"](spark, SF).collect()}
    for i, text in texts.items():
        ids = np.array(model.encode(text), "<u4")
        assert (found[i]["n_tokens"], found[i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))
        assert found[i]["round_trip"]


def test_files_give_back_all_ids(spark, monkeypatch, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    monkeypatch.setattr(files, "PART_TOKENS", 1 << 17)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = documents(spark)
    files.write_token_files(docs, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c/blocks")).select("part").distinct().count() > 1
    start = 0
    rows = files.read_token_files(spark, str(tmp_path / "c")).orderBy("doc_id").collect()
    for row, doc in zip(rows, docs.orderBy("doc_id").collect(), strict=True):
        ids = tokenizer.encode(doc["text"], add_special_tokens=False).ids + [2]
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids"]) == (doc["doc_id"], start, len(ids), ids)
        start += len(ids)


def test_a_damaged_block_is_noticed():
    table = files.Table(files.shares(np.array([5, 0, 3, 900])))
    ids = np.array([0, 3, 3, 2, 3] * 300, np.int32)
    packed = table.pack(ids)
    assert (table.unpack(packed) == ids).all()
    with pytest.raises(ValueError, match="damaged"):
        table.unpack(packed[:40] + bytes([packed[40] ^ 1]) + packed[41:])
