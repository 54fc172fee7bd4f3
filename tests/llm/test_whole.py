"""Results that a part of the work would miss."""

import random

import pyarrow as pa

import landfall.llm.decontaminate as decontaminate
from landfall.llm.arrays import flat
from landfall.llm.decontaminate import contaminated
from landfall.llm.language_id import MOST_BITS, Languages, _predict, letters_of
from landfall.llm.simhash import one_of_each, simhash_classes

WORDS = [f"w{k}" for k in range(28)]


def test_an_item_is_found_with_any_one_word_changed(spark):
    copies = [(k, " ".join(["in front", *WORDS[:k], "other", *WORDS[k + 1 :], "behind"])) for k in range(len(WORDS))]
    items = spark.createDataFrame([(1, " ".join(WORDS)), (2, "nothing like it is in any of these texts at all")], "item_id bigint, text string")
    found = {r["doc_id"]: r for r in contaminated(spark.createDataFrame(copies, "doc_id bigint, text string"), items).collect()}
    # 24 shingles, of which one word takes up to five with it, at most 4 of 24 may be gone.
    missing = {k: sum(k - 4 <= s <= k for s in range(24)) for k in range(len(WORDS))}
    assert set(found) == {k for k, m in missing.items() if 1 - m / 24 >= 0.8}
    assert all(abs(found[k]["overlap"] - (1 - missing[k] / 24)) < 1e-9 for k in found)
    assert found[27]["answer"] < 0.8


def test_a_longer_item_is_found_with_one_word_changed_at_every_place(spark):
    words = [f"w{k}" for k in range(40)]
    copies = [(k, " ".join([*words[:k], "other", *words[k + 1 :]])) for k in range(40)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    found = contaminated(spark.createDataFrame(copies, "doc_id bigint, text string"), items).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(40))


def invented(seed, letters, words=300, chars=2):
    """A text over a vocabulary of its own."""
    pick = random.Random(seed)
    own = ["".join(pick.choice(letters) for _ in range(pick.randint(1, chars))) for _ in range(words)]
    return lambda n: " ".join(pick.choice(own) for _ in range(n))


def test_languages_of_many_letters_are_told_apart_and_kept():
    texts = {
        "en": invented(1, "abcdefghijklmnopqrstuvwxyz", chars=7),
        "el": invented(2, "αβγδεζηθικλμνξοπρστυφχψω", chars=7),
        "ru": invented(3, "абвгдежзийклмнопрстуфхцчшщъыьэюя", chars=7),
        "ja": invented(4, [chr(0x3041 + k) for k in range(80)] + [chr(0x4E00 + 7 * k) for k in range(200)], chars=4),
        "zh": invented(5, [chr(0x4E00 + 11 * k) for k in range(900)], chars=4),
    }
    learned = {}
    for name, text in texts.items():
        letters, _ = letters_of(*flat(pa.array([text(4000)])))
        learned[name] = letters[:32_768].astype("<u4").tobytes().decode("utf-32-le")
    names, _, bits = _predict(pa.array([text(200) for text in texts.values()] + ["กขคฆงจฉชซ" * 20]), Languages(learned))
    assert names[:5] == list(texts)
    assert (bits[:5] <= MOST_BITS).all() and bits[5] > MOST_BITS


def test_one_of_each_class_of_fingerprints_stays(spark):
    pick = random.Random(6)
    rows = []
    for _ in range(30):
        words = [f"v{pick.randrange(3000)}" for _ in range(pick.randint(150, 400))]
        rows.append((len(rows), " ".join(words)))
        for changes in (0, 1, 2, 8):
            changed = list(words)
            for k in pick.sample(range(len(words)), changes):
                changed[k] = f"u{pick.randrange(3000)}"
            rows.append((len(rows), " ".join(changed)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    classes = {r["doc_id"]: r["component_id"] for r in simhash_classes(frame).collect()}
    kept = one_of_each(frame).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(classes.values()))
    assert 30 <= len(kept) < 100 and {r["text"] for r in kept} <= {t for _, t in rows}


def test_two_texts_of_one_doc_id_stay_or_go_each_with_its_own_class(spark):
    texts = ["alpha beta gamma delta epsilon zeta eta theta", "wholly other words stand in this second text here"]
    rows = [(1, texts[0], "x"), (2, texts[0], "x"), (2, texts[1], "x"), (3, texts[1], "x"), (2, texts[1], "a"), (2, texts[1], "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _id string")
    kept = one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(map(tuple, kept.collect())) == [(1, texts[0], "x"), (2, texts[1], "a")]


def plain_hits(docs, items):
    """Items of which 0.8 of the distinct shingles of five words, or of all words, are in a document."""

    def shingles(text, length):
        words = text.lower().split()
        return {tuple(words[k : k + length]) for k in range(len(words) - length + 1)}

    found = set()
    for item, text in items:
        length = min(5, len(text.split()))
        own = shingles(text, length)
        found |= {(doc, item) for doc, whole in docs if own and 5 * len(own & shingles(whole, length)) >= 4 * len(own)}
    return found


def test_items_of_any_length_are_found_however_many_indexes(spark, monkeypatch):
    pick = random.Random(8)
    word = lambda: f"q{pick.randrange(4000)}"
    items = [(n, " ".join(word() for _ in range(n))) for n in range(1, 81)]
    items += [(100, "two two"), (101, "Word Word word"), (102, "tie one two three four five six"), (103, "tie one two three four five six")]
    docs = []
    for n, text in items:
        for changes in (0, 1, 2, n // 8):
            words = text.split()
            for k in pick.sample(range(len(words)), min(changes, len(words))):
                words[k] = word()
            around = [word() for _ in range(60)]
            docs.append((len(docs), " ".join([*around[:30], *words, *around[30:]]).upper()))
    frame, listed = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    want = plain_hits(docs, items)
    rows = sorted(map(tuple, contaminated(frame, listed).collect()))
    assert {r[:2] for r in rows} == want and len(rows) == len(want)
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 4000)
    again = sorted(map(tuple, contaminated(frame, listed).collect()))
    assert [r[:2] for r in again] == [r[:2] for r in rows]
    assert all(abs(x - y) < 1e-9 for a, c in zip(again, rows) for x, y in zip(a[2:], c[2:]))
