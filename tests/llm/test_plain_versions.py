"""Language, quality, toxicity and the pipeline against plain versions written without numpy or Spark."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from landfall.llm import language_id, quality, toxicity
from landfall.llm.arrays import mixed, token_hashes
from landfall.llm.language_id import languages_of
from landfall.llm.quality import quality_scores
from landfall.llm.tables import learnable, share_of_hash
from landfall.llm.toxicity import toxic_scores
from tests.llm.test_results import plain_print, plain_repeats, roots
from tests.llm.test_whole import plain_hits

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x20\x09-\x0d]+")


def invented(pick, letters, words=120):
    own = ["".join(pick.choice(letters) for _ in range(pick.randint(1, 7))) for _ in range(words)]
    return lambda n: " ".join(pick.choice(own) for _ in range(n))


LANGUAGES = {"aa": "abcdefghij", "bb": "fghijklmnop", "cc": "äöüßabcmnoδ"}


@pytest.fixture(scope="module")
def spoken(spark):
    pick = random.Random(3)
    speak = {lang: invented(pick, letters) for lang, letters in LANGUAGES.items()}
    rows = []
    for n in range(90):
        lang = pick.choice(sorted(speak))
        text = speak[lang](pick.choice((1, 3, 30, 90)))
        rows.append((n, text.title() + "! 42 " + text[:20], lang if n % 7 else None))
    rows += [(200, None, "aa"), (201, "", "bb"), (202, "12 !?", "cc"), (203, "ωωω жж", None), (204, "a", None), (None, "abc", "aa")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


# Language


def plain_letters(text):
    out = []
    for char in text or "":
        if char.isalpha():
            out.append(char.lower())
        elif not out or out[-1] != " ":
            out.append(" ")
    return "".join(out)


def plain_languages(docs):
    """Name, probability and bits a symbol of each text, by searching for the longest stretches one letter after the other."""
    known = docs.where(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    trained = defaultdict(str)
    for r in known.select("lang", "text", share_of_hash(F.col("doc_id")).alias("share"), "doc_id").orderBy("share", "doc_id").collect():
        assert len(r["text"]) <= language_id.PIECE_CHARS
        trained[r["lang"]] += plain_letters(r["text"])
    alphabet = set("".join(trained.values())) | {" "}
    assert len(alphabet) < language_id.LETTERS and max(map(len, trained.values())) < language_id.TRAIN_SYMBOLS
    found = []
    for r in docs.collect():
        text = plain_letters(r["text"])
        if not any(map(str.isalpha, text)):
            found.append((r["doc_id"], "und", 0.0, 0.0))
            continue
        costs = {}
        for lang, own in trained.items():
            count, match = 0, ""
            for letter in text:
                if letter in alphabet and match + letter in own:
                    match += letter
                else:
                    count, match = count + 1, letter if letter in alphabet and letter in own else ""
            costs[lang] = count * math.log2(max(2, len(own)))
        least = min(costs.values())
        name = min(lang for lang, cost in costs.items() if cost == least)
        found.append((r["doc_id"], name, 1 / sum(2 ** max(least - c, -1000) for c in costs.values()), least / len(text)))
    return found


def close(one, other):
    return all(x == y if not isinstance(x, float) else math.isclose(x, y, rel_tol=1e-7, abs_tol=1e-9) for x, y in zip(one, other, strict=True))


def test_languages_by_searching_for_the_longest_stretches(spoken):
    want = sorted(plain_languages(spoken), key=str)
    found = sorted((tuple(r) for r in languages_of(spoken).select("doc_id", "lang_pred", "score", "bits").collect()), key=str)
    assert len(found) == len(want) and all(close(f, w) for f, w in zip(found, want))
    assert {w[1] for w in want} == {"und", *LANGUAGES}


def test_equal_languages_are_taken_by_name(spark):
    rows = [(n, "same text here", "zz" if n % 2 else "yy") for n in range(20)] + [(50, "same text", None)]
    found = languages_of(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).where("doc_id = 50").first()
    assert found["lang_pred"] == "yy" and found["score"] == pytest.approx(0.5, abs=0.2)


# Quality


def tokens(text):
    return [t.lower() for t in TOKEN.findall((text or "").encode())]


def hash_of(token):
    return token_hashes(pa.array([token.decode()]))[0][0]


def plain_features(text):
    """Counts of hashed words and pairs; the last word is there once more."""
    hashes = [hash_of(t) for t in tokens(text)]
    numbers = []
    for one, other in zip(hashes, [*hashes[1:], None]):
        numbers.append(one)
        if other is None:
            numbers.append(one)
        else:
            numbers.append(np.uint64(0) if one == other else mixed(np.array([one]) * np.uint64(3) + np.array([other]))[0])
    return Counter(int(n) >> (64 - quality.FEATURE_BITS) for n in numbers)


def plain_ftrl(rows):
    """Follow the regularised leader, one coordinate after the other."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for x, y in rows:
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[i] * v for i, v in x.items())))))
            for i, v in x.items():
                g = (p - y) * v
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return {i: weight(i) for i in list(z)}


def row_of(text):
    counts = plain_features(text)
    size = math.sqrt(max(1, sum(counts.values())))
    return {**{i: c / size for i, c in counts.items()}, "bias": 1.0}


def labelled(docs, labels, label):
    """What is learned from, with the shard and the order of each document."""
    rows = docs.join(labels, "doc_id").where(learnable(F.col("doc_id")) & F.col(label).isin(0, 1))
    order, shard = share_of_hash(F.col("doc_id"), 11), F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(quality.SHARDS))
    return rows.select("doc_id", "text", F.col(label).alias("y"), order.alias("order"), shard.alias("shard")).orderBy("order", "doc_id").collect()


@pytest.fixture(scope="module")
def judged(spark):
    pick = random.Random(5)
    good, bad = invented(pick, "abcdefgh", 60), invented(pick, "efghijkl", 60)
    rows, marks = [], []
    for n in range(160):
        y = int(pick.random() < 0.4)
        text = " ".join((good if pick.random() < (0.8 if y else 0.2) else bad)(pick.randint(1, 6)) for _ in range(pick.randint(1, 6)))
        toxic = int(pick.random() < 0.3)
        text += " Vilewordings vileword! slur" * (toxic * pick.randint(1, 3))
        rows.append((n, text))
        marks.append((n, y, toxic))
    rows += [(300, None), (301, ""), (302, "the the the the"), (303, "vilewordly slur slur")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    return frame, spark.createDataFrame(marks + [(301, None, None)], "doc_id bigint, quality int, toxic int")


def test_quality_by_updating_one_weight_after_the_other(judged):
    docs, labels = judged
    shards = defaultdict(list)
    for r in labelled(docs, labels, "quality"):
        shards[r["shard"]].append((row_of(r["text"]), r["y"]))
    weights = defaultdict(float)
    for rows in shards.values():
        for i, w in plain_ftrl(rows).items():
            weights[i] += w / quality.SHARDS
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality_scores(docs, labels).collect():
        margin = sum(weights[i] * v for i, v in row_of(texts[r["doc_id"]]).items())
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-margin)), rel=1e-6)
        assert r["predicted"] == int(r["score"] >= 0.3)


# Toxicity


def plain_keys(text):
    """The tokens of a text with what they are read by: themselves, or the first bytes of longer ones."""
    return [(("word", t), ("stem", t[: toxicity.STEM_BYTES]) if len(t) > toxicity.STEM_BYTES else None) for t in tokens(text)]


def plain_segments(values):
    """Maximal segments by their definition: the best one, then those to its left and right."""

    def best(low, high):
        sums = [0.0]
        for v in values[low:high]:
            sums.append(sums[-1] + v)
        options = [(round(sums[j] - sums[i], 9), i - j, low + i, low + j) for i in range(len(sums)) for j in range(i + 1, len(sums))]
        if not options or max(options)[0] <= 0:
            return []
        score, _, i, j = max(options)
        return [*best(low, i), (i, j, score), *best(j, high)]

    return best(0, len(values))


def test_toxicity_by_trying_all_segments(judged):
    docs, labels = judged
    sample = labelled(docs, labels, "toxic")
    counts = {0: Counter(), 1: Counter()}
    for r in sample:
        counts[r["y"]].update({key for pair in plain_keys(r["text"]) for key in pair if key})
    t, c = sum(counts[1].values()), sum(counts[0].values())
    share = (t + 1) / (t + c + 2)
    score = {}
    for key in counts[0].keys() | counts[1].keys():
        a, b = counts[1][key] + toxicity.PRIOR * share, counts[0][key] + toxicity.PRIOR * (1 - share)
        odds = math.log(a / b) - math.log(share / (1 - share))
        if odds >= toxicity.LEAST_ODDS and odds / math.sqrt(1 / a + 1 / b) >= toxicity.LEAST_Z:
            score[key] = odds
    assert ("word", b"slur") in score and ("stem", b"vileword") in score
    rest = -sum(score.values()) / len(score) / toxicity.PASSAGE_TOKENS

    def values(text):
        return [score.get(word) or (stem and score.get(stem)) or rest for word, stem in plain_keys(text)]

    shares = {key: counts[0][key] / c for key in score}
    low, high = 1e-6, 20.0
    for _ in range(80):
        rate = (low + high) / 2
        over = sum(s * math.exp(rate * score[k]) for k, s in shares.items()) + max(0.0, 1 - sum(shares.values())) * math.exp(rate * rest) > 1
        low, high = (low, rate) if over else (rate, high)
    rate, clean = low, [values(r["text"]) for r in sample if not r["y"]]
    expected = sum(map(len, clean)) * math.exp(-rate * min(score.values()))
    scale = (sum(len(plain_segments(v)) for v in clean) + 0.5) / max(expected, 1e-9)

    def surprise(text):
        own = values(text)
        chance = math.log(max(scale * len(own), 1.0))
        return math.log1p(sum(max(0.0, rate * s - chance) for *_, s in plain_segments(own)))

    x, y = np.array([surprise(r["text"]) for r in sample]), np.array([float(r["y"]) for r in sample])
    bias, slope = toxicity.logistic(x, y)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = set()
    for r in toxic_scores(docs, labels).collect():
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(bias + slope * surprise(texts[r["doc_id"]])))), rel=1e-5)
        seen.add(r["predicted"])
        length = len(tokens(texts[r["doc_id"]]))
        want = [s for s in plain_segments(values(texts[r["doc_id"]])) if rate * s[2] > math.log(max(scale * length, 1.0))]
        assert [(p["first"], p["end"]) for p in r["passages"]] == [s[:2] for s in want]
    assert seen == {0, 1}


# The pipeline


def test_the_pipeline_by_plain_versions_of_its_stages(spark, spoken, tmp_path):
    import public_tokenizers
    import sentencepiece

    pick = random.Random(9)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spoken.collect()]
    speak = invented(random.Random(3), LANGUAGES["aa"], 400)
    base = speak(300)
    words = base.split()
    # Copies, near copies, a passage that two texts share, an item of the benchmark, and noise in no language.
    rows += [(300, base, None), (301, base, None), (302, " ".join([*words[:150], "x", *words[151:]]), None)]
    passage = speak(60)
    rows += [(n, f"{speak(40)} {passage} {speak(40)}", None) for n in (310, 311)]
    item = speak(24)
    rows += [(320, f"{speak(30)} {item} {speak(30)}", "aa"), (330, "".join(chr(pick.randrange(0x4E00, 0x9000)) for _ in range(300)), None)]
    frame = spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [r for r in plain_languages(frame) if r[1] != "und" and r[3] <= language_id.MOST_BITS]
    texts = {i: t for i, t, _ in rows if i is not None}
    left = {r[0]: texts[r[0]] for r in left if r[0] is not None}
    assert 330 not in left and {300, 301, 302, 310, 311, 320} <= set(left)
    prints = {i: plain_print(t) for i, t in left.items()}
    ids = sorted(left)
    root = roots(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3])
    left = {i: t.encode() for i, t in left.items() if root[i] == i}
    assert 301 not in left
    seen = Counter(t[k : k + 200] for t in left.values() for k in range(len(t) - 199))
    cut = {}
    for i, t in left.items():
        gone = set()
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone.update(range(k, k + 200))
        cut[i] = bytes(b for k, b in enumerate(t) if k not in gone).decode("utf-8", "ignore")
    assert plain_repeats(left)[310][1] == len(left[310]) - len(cut[310].encode()) > 200
    hit = {doc for doc, _ in plain_hits(list(cut.items()), [(1, item)])}
    assert hit == {320}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: len(model.encode(t)) for i, t in cut.items() if i not in hit}
    found = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect() if r["doc_id"] is not None}
    assert found == want
