"""Packing, the conversation trie and whitening: against the tokenizer, plain versions and other solvers; edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landfall.llm.byte_bpe import default_tokenizer
from landfall.llm.packing import Packer, Piece, in_powers_of_two, packed
from landfall.llm.spectrum import count_above, leading
from landfall.llm.turn_trie import NODE, TernaryTree, median_order, prefix_trie
from landfall.llm.whitening import Fit, whitened
from tests.llm.conftest import EDGES

SF = "/root/testdata/sf0.001"


def piece(size, number=0):
    return Piece(number, size, 0, np.arange(size, dtype=np.int32))


# Packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_each_piece_goes_where_the_sum_of_squares_is_least(sizes):
    packer, counts = Packer(16), [0] * 17
    for size in sizes:
        size %= 16
        if not size:
            continue
        costs = {}
        for level in range(0, 17 - size):
            if level == 0 or counts[level]:
                after = list(counts)
                after[level] -= level > 0
                after[level + size] += 1
                costs[level] = sum(c * c for c in after[1:16])
        least = min(costs.values())
        level = packer.level_for(size)
        assert level == max(k for k, v in costs.items() if v == least)
        packer.add(piece(size))
        counts[level] -= level > 0
        counts[level + size] += 1
        counts[16] = 0
        assert counts[1:16] == [len(own) for own in packer.levels[1:]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60), st.integers(20, 200))
def test_every_id_is_in_one_piece_of_a_full_or_a_power_of_two_sequence(sizes, held):
    packer = Packer(16, held)
    for number, size in enumerate(sizes):
        packer.add(piece(size, number))
        assert packer.held <= held + 16
    left = packer.remains()
    assert sum(len(p.ids) for p in left) == sum(sizes) % 16
    short = list(in_powers_of_two(left))
    assert [sum(len(p.ids) for p in own) for own in short] == [1 << k for k in (3, 2, 1, 0) if sum(sizes) >> k & 1]
    assert all(sum(len(p.ids) for p in own) == 16 for own in packer.closed)
    found = defaultdict(list)
    for own in [*packer.closed, *short]:
        for p in own:
            assert p.ids.tolist() == list(range(p.start, p.start + len(p.ids)))
            found[p.doc_id] += p.ids.tolist()
    assert {k: sorted(v) for k, v in found.items()} == {k: list(range(n)) for k, n in enumerate(sizes)}


def check_packing(rows, texts):
    """Pieces of documents with ids of their own against the tokenizer itself."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0


@pytest.mark.parametrize("parts", (1, 7))
def test_packed_documents_against_the_tokenizer(spark, parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(parts)
    rows = packed(docs).collect()
    check_packing(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert sum(r["length"] == 2048 or r["offset"] == 0 for r in rows) >= sum(r["length"] for r in rows) // 2048


def test_packing_any_row_and_none(spark, edges, nothing):
    rows = packed(edges.where("doc_id <> 7")).collect()
    check_packing(rows, {e[0]: e[1] for e in EDGES if e[0] not in (None, 7)})
    rows = packed(edges, with_ids=True).collect()
    assert sum(r["offset"] == 0 and r["start"] == 0 for r in rows) >= 1
    tokens = {(r["doc_id"], r["doc_tokens"]) for r in rows}
    assert {i for i, _ in tokens} == {e[0] for e in EDGES} and (1, 1) in tokens and (2, 1) in tokens
    assert sum(r["length"] for r in rows if r["doc_id"] == 7) == 2 * next(n for i, n in tokens if i == 7)
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    assert packed(nothing).count() == 0 and packed(nothing).columns == packed(edges).columns


# Conversation trie

KINDS = "conv_id bigint, turn bigint, role string, text string, path string, least string, key string"


def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v, key=lambda t: (t[0], t[1] or 0))] for c, v in own.items()}
    members = defaultdict(list)
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []
    for p, own_members in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in own_members if paths[c] == p)))
        above = min(members[p[:-1]]) if p else None
        leaves = sum(q not in children for q in below)
        out.append((min(own_members), len(p), above, len(own_members), len(children[p]) if p in children else 0, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], KINDS)


@pytest.mark.parametrize("seed", range(3))
def test_trie_of_shards_of_any_size(spark, seed):
    pick = random.Random(seed)
    texts = ["hello", "hello there", "ß", "", "1:user", None]
    rows = []
    for c in pick.sample(range(200), 70):
        rows += [(c, t, pick.choice(("user", "bot")) if t % 2 else "user", pick.choice(texts) if t else pick.choice(texts[:2])) for t in range(pick.choice((0, 1, 2, 3, 4, 12)))]
    want = plain_trie(rows)
    for shard_turns, fan_in in ((1 << 19, 256), (5, 2), (3, 3)):
        found = prefix_trie(conversations(spark, rows), shard_turns, fan_in).select(*NODE).collect()
        assert sorted(map(tuple, found), key=str) == want


def test_trie_of_any_row_and_none(spark):
    nowhere = [(0, 1, None, None), (0, None, "user", None), (0, 0, None, "x"), (None, 0, "user", "lost"), (6, 0, "u", "own only"), (8, 5, "u", "five"), (8, 3, "u", "three")]
    long = [(10, t, "user", f"turn {t}") for t in range(900)] + [(11, t, "user", f"turn {t}") for t in range(900)]
    copies = [(c, t, "user", f"same {t}") for c in range(100, 400) for t in range(2)]
    rows = nowhere + long + copies + [(6, 0, "u", "own only")]
    found = prefix_trie(conversations(spark, rows), 64, 4).select(*NODE).collect()
    assert len(found) == len(set(found))
    want = plain_trie([r for r in rows if r[0] not in (10, 11)])
    short = [tuple(r) for r in prefix_trie(conversations(spark, [r for r in rows if r[0] not in (10, 11)])).select(*NODE).collect()]
    assert sorted(short, key=str) == want
    deepest = max(found, key=lambda r: r["depth"])
    assert deepest["depth"] == 900 and deepest["n_convs"] == 2 and deepest["n_leaves"] == 1
    assert prefix_trie(conversations(spark, rows).limit(0)).count() == 0
    # Turns of one number with different texts are in one order on every run.
    tied = conversations(spark, [(20, 0, "u", t) for t in "abcdef"])
    assert prefix_trie(tied).exceptAll(prefix_trie(tied.repartition(5))).count() == 0


def test_median_order_balances_the_search_trees():
    n, tree = 1000, TernaryTree()
    for k in median_order(n):
        tree.insert([k], [1])
    assert sorted(tree.code) == [-1, *range(n)]

    def height(node):
        return 1 + max((height(s) for s in (tree.low[node], tree.high[node]) if s), default=0)

    assert height(tree.below[0]) <= 10


# Whitening


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 24), st.integers(0, 10**6), st.sampled_from(["wide", "ties", "low", "whole"]))
def test_leading_components_against_another_solver(n, seed, kind):
    pick = np.random.default_rng(seed)
    turn = np.linalg.qr(pick.standard_normal((n, n)))[0]
    values = {"wide": 10.0 ** pick.uniform(-6, 3, n), "ties": pick.choice([1.0, 2.0, 5.0], n), "low": np.where(np.arange(n) < n // 2, pick.random(n), 0.0)}
    matrix = np.round(pick.standard_normal((n, n)) * 3) if kind == "whole" else (turn * values[kind]) @ turn.T
    matrix = (matrix + matrix.T) / 2
    known = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    size = max(1e-300, np.abs(known).max())
    for shift in pick.uniform(-1, 1, 4) * size:
        assert count_above(matrix, shift) == (known > shift).sum()
    found, vectors = leading(matrix, 8)
    assert len(found) == min(8, (known > 1e-12 * size).sum())
    assert np.allclose(found, known[: len(found)], atol=1e-11 * size, rtol=0)
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max(initial=0) < 1e-10
    assert np.abs(matrix @ vectors - vectors * found).max(initial=0) < 1e-10 * size


def test_whitened_embeddings_against_another_solver(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    table = frame.toArrow()
    vectors = np.stack(table["embedding"].to_pylist())
    x = np.floor(64 * vectors.astype(float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, turn = np.linalg.eigh(covariance)
    values, turn = values[::-1][:32], turn[:, ::-1][:, :32]
    want = centred @ turn / np.sqrt(values)
    rows = whitened(frame.repartition(5)).toPandas().sort_values(["component", "vec_id"])
    order = np.argsort(table["vec_id"].to_numpy())
    assert len(rows) == n * 32
    for k, own in rows.groupby("component"):
        got, plain = own.whitened.to_numpy(), want[order, k - 1]
        assert np.abs(got * np.sign(got @ plain) - plain).max() < 1e-8
        assert np.allclose(own.explained, values[k - 1] / np.trace(covariance), rtol=1e-9)
        assert (own.deviation.to_numpy() == ((n * x - sums) ** 2).sum(axis=1)[order]).all()
    assert (rows.n == n).all() and rows.identity_error.nunique() == 1 and rows.identity_error.iloc[0] < 1e-9


def test_vectors_that_cannot_be_whitened(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k), float(k * k % 7)]) for k in range(1, 9)] + [(1, [1.0, 1.0]), (None, [2.0, 2.0])]
    rows += [(20, None), (21, [nan, 1.0]), (22, [inf, 1.0]), (23, [None, 1.0]), (24, []), (25, [1e300, 0.0])]
    rows += [(30, [5.0, 5.0, 5.0]), (31, [5.0, 5.0, 5.0]), (40, [1.0, 2.0, 3.0, 4.0])]
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id bigint, embedding array<float>, n int, whitened double")
    found = whitened(frame).toPandas()
    # Equal vectors, and a single one, have no variance and so no component.
    assert sorted(found.vec_id.dropna().unique()) == list(range(1, 9)) and found.vec_id.isna().sum() == 2
    assert (found.n == 10).all() and len(found) == 20
    assert abs(found.groupby("component").explained.first().sum() - 1) < 1e-12
    assert whitened(frame.limit(0)).count() == 0 and whitened(frame.where("vec_id = 20")).count() == 0


def test_deviations_are_exact_or_null():
    x = np.array([[1 << 40, 0], [0, 1 << 40], [(1 << 40) + 3, 7]], np.int64)
    fit = Fit(3, tuple(int(s) for s in x.sum(axis=0)))
    exact = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, fit.sums)) for row in x]
    assert fit.deviations(x).to_pylist() == [v if v < 1 << 63 else None for v in exact]
    small = x % 1000
    fit = Fit(3, tuple(int(s) for s in small.sum(axis=0)))
    assert fit.deviations(small).to_pylist() == [sum((3 * int(v) - s) ** 2 for v, s in zip(row, fit.sums)) for row in small]


