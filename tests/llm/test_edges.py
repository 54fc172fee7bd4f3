"""Nulls, empty and very long texts, repeated rows, clashing column names and empty tables."""

import pytest
from pyspark.sql.functions import lit

import corpus_pipeline
from landfall.llm.bwt_merge import cut_documents, repeat_digest
from landfall.llm.cap_filters import vector_classes
from landfall.llm.decontaminate import contaminated, decontaminated
from landfall.llm.language_id import in_a_language, languages_of
from landfall.llm.quality import quality_scores
from landfall.llm.sentencepiece_codec import decode, encode, encoding_digest
from landfall.llm.simhash import one_of_each, simhash_classes
from landfall.llm.suffix_trees import shared_window_digest
from landfall.llm.token_files import token_files
from landfall.llm.toxicity import toxic_scores
from tests.llm.conftest import EDGES, LONG, SAME

PLAIN = {
    "languages": languages_of,
    "simhash": simhash_classes,
    "encoding": encoding_digest,
    "windows": shared_window_digest,
    "repeats": repeat_digest,
    "files": token_files,
}
SCORED = {"quality": quality_scores, "toxicity": toxic_scores}


@pytest.mark.parametrize("name", PLAIN)
def test_a_row_for_each_document(edges, name):
    rows = PLAIN[name](edges).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(e[0]) for e in EDGES)


@pytest.mark.parametrize("name", PLAIN)
def test_an_empty_table_gives_no_rows(nothing, edges, name):
    found = PLAIN[name](nothing)
    assert found.count() == 0
    assert found.columns == PLAIN[name](edges).columns


@pytest.mark.parametrize("name", SCORED)
def test_scores_of_any_text(edges, labels, name):
    rows = SCORED[name](edges, labels).collect()
    assert len(rows) == len(EDGES)
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)


@pytest.mark.parametrize("name", SCORED)
def test_no_labels_or_no_documents(edges, labels, nothing, name):
    assert all(r["score"] == 0.5 for r in SCORED[name](edges, labels.limit(0)).collect())
    assert SCORED[name](nothing, labels).count() == 0


def test_texts_without_a_letter_have_no_language(edges):
    found = {r["doc_id"]: r for r in languages_of(edges).collect() if r["doc_id"]}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (1, 2, 3, 4))
    assert found[8]["lang_pred"] == "de"
    kept = in_a_language(edges)
    assert kept.columns == edges.columns
    assert not {1, 2, 3, 4} & {r["doc_id"] for r in kept.collect()}


def test_empty_texts_are_linked_and_rows_without_id_are_not(edges):
    found = {r["doc_id"]: r for r in simhash_classes(edges).collect() if r["doc_id"]}
    assert [found[i]["component_id"] for i in (1, 2, 3, 6, 7)] == [1, 1, 1, 6, 6]
    assert found[1]["fingerprint"] == "0" * 16
    kept = one_of_each(edges)
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 6, 8, 9] and ids.count(None) == 2


def test_cutting_keeps_rows_and_columns(edges):
    cut = cut_documents(edges)
    assert cut.columns == edges.columns
    rows = cut.collect()
    assert len(rows) == len(EDGES)
    long = next(r for r in rows if r["doc_id"] == 8)
    assert len(long["text"]) < len(LONG) and long["n_chars"] == len(long["text"])


def test_items_are_found_in_any_row(edges, items, nothing):
    found = contaminated(edges, items).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["6", "7", "7", "None"]
    assert {r["item_id"] for r in found} == {1}
    kept = decontaminated(edges, items)
    assert kept.columns == edges.columns and kept.count() == len(EDGES) - 4
    assert kept.where("text is null").count() == 2
    assert contaminated(edges, items.limit(0)).count() == 0
    assert contaminated(nothing, items).count() == 0


def test_ids_go_there_and_back(edges):
    rows = decode(encode(edges).drop("text").withColumnRenamed("source", "of")).collect()
    assert {r["text"] for r in rows} == {(e[1] or "").replace("▁", " ") for e in EDGES}


def test_vectors_without_a_direction(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(7, [None, 1.0]), (8, []), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_classes(vectors).collect()}
    assert [found[i] for i in (1, 2, 10)] == [(2, 1, True), (2, 1, False), (2, 1, False)]
    assert all(found[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))
    assert found[None] == (0, None, True)
    assert vector_classes(vectors.limit(0)).count() == 0


def test_other_columns_of_vectors_labels_and_items_do_not_matter(spark, edges, labels, items):
    names = ("id", "bucket", "own", "copies", "y", "text_", "first", "score", "hits", "ids", "node", "component")

    def more(df):
        return df.select("*", *[lit(k).alias(name) for k, name in enumerate(names) if name not in df.columns])

    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    pairs = [(vector_classes, (vectors,)), (contaminated, (edges, items))]
    pairs += [(scored, (edges, labels)) for scored in SCORED.values()]
    for operator, tables in pairs:
        plain, with_more = operator(*tables), operator(*tables[:-1], more(tables[-1]))
        assert sorted(map(str, plain.collect())) == sorted(map(str, with_more.collect()))


def test_stages_take_edges_and_nothing(spark, edges, nothing, tmp_path):
    items = spark.createDataFrame([(1, SAME)], "item_id bigint, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edges, nothing):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            rows = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert rows.columns == docs.columns
                assert [f.dataType for f in rows.schema] == [f.dataType for f in docs.schema]
            rows.collect()
