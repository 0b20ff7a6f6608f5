"""Decontamination against every window, fitting samples against hot texts and partitionings, pieces against chunk sizes."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from lakemart.llm import decontaminate, language, pieces, toxicity
from lakemart.llm.words import shingle_hashes

# --- 8 decontamination ----------------------------------------------------------------------------------------------


def bag(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)])


def best_window(text, item):
    """Highest weighted Jaccard similarity over all windows of the item's length."""
    own, best = bag(item), 0.0
    for start in range(max(1, len(text) - len(item) + 1)):
        window = bag(text[start : start + len(item)])
        best = max(best, sum((own & window).values()) / sum((own | window).values()))
    return best


def leaked(spark, texts, items):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(docs, bench).collect()}


def test_runs_of_one_word_do_not_hide_a_leak(spark):
    items, texts = [], []
    for words, run in ((120, 14), (200, 16), (300, 20), (300, 24)):
        body = [f"a{len(items)}x{i}" for i in range(words)]
        items.append(body + ["run"] * run)
        texts.append(["before"] * 30 + body + ["other"] * run + ["after"] * 30)
    found = leaked(spark, texts, items)
    for n, (text, item) in enumerate(zip(texts, items, strict=True)):
        assert best_window(text, item) >= 0.8 and found[n, n] == pytest.approx(best_window(text, item))


def test_leaks_equal_brute_force_over_all_windows(spark):
    """Random bags with many repeats, copied with a few words changed: found exactly when some window is similar enough."""
    rng = np.random.default_rng(8)
    items = [[f"w{int(w)}" for w in rng.integers(0, vocabulary, size)] for size, vocabulary in [(5, 9), (6, 3), (9, 4), (14, 5), (30, 6), (60, 8), (60, 400), (90, 30)] for _ in range(3)]
    texts = []
    for item in items * 2:
        copy = list(item)
        for at in rng.integers(0, len(copy), int(rng.integers(0, max(1, len(copy) // 20) + 1))):
            copy[at] = f"w{int(rng.integers(0, 500))}"
        texts.append([f"v{int(w)}" for w in rng.integers(0, 50, 20)] + copy[int(rng.integers(0, 2)) :] + [f"w{int(w)}" for w in rng.integers(0, 6, 25)])
    texts += [items[20][:-3], items[12], ["w1"] * 200]
    expected = {(d, i): best_window(text, item) for d, text in enumerate(texts) for i, item in enumerate(items)}
    expected = {pair: value for pair, value in expected.items() if value >= 0.8}
    found = leaked(spark, texts, items)
    assert set(found) == set(expected) and len(found) > 15 and any(v < 0.95 for v in found.values())
    assert all(found[p] == pytest.approx(expected[p]) for p in found)


def test_window_fingerprints_equal_those_of_the_window_alone(monkeypatch):
    rng = np.random.default_rng(1)
    for size, vocabulary in ((200, 3), (200, 40), (50, 2), (7, 7)):
        words = rng.integers(1, vocabulary + 1, size).astype(np.uint64)
        shingles, _, _ = shingle_hashes(words, np.array([0, size]), 2)
        for span in (1, 2, 5, len(shingles)):
            prints = decontaminate._window_prints(shingles, span)
            alone = [decontaminate._window_prints(shingles[i : i + span], span)[0] for i in range(len(shingles) - span + 1)]
            assert (prints == np.array(alone)).all()
            # The order of the shingles is no part of a bag.
            turned = decontaminate._window_prints(shingles[:span][::-1].copy(), span)[0]
            assert (turned == prints[0]).all()


def test_radius_covers_bags_at_the_least_similarity():
    rng = np.random.default_rng(4)
    for size in (9, 18, 45, 90, 600):
        reach = decontaminate.radius_for(size, size, 0.8)
        for _ in range(40):
            own = rng.integers(1, 2**63, size + size // 9, dtype=np.uint64)
            a, b = own[:size], own[size // 9 :]
            prints = [decontaminate._window_prints(x, size)[0] for x in (a, b)]
            assert (prints[0] != prints[1]).sum() <= reach
    assert decontaminate.radius_for(8, 8, 0.8) == 0 and decontaminate.radius_for(10, 4, 0.8) == -1


def test_a_long_text_that_repeats_an_item_is_read_in_pieces(spark, monkeypatch):
    item = [f"w{i}" for i in range(40)]
    text = (item + ["and"]) * 3000 + [*item[:-1], "end"]
    monkeypatch.setattr(decontaminate, "_WINDOWS", 1000)
    assert leaked(spark, [text, text[41 * 3000 :]], [item]) == {(0, 0): 1.0, (1, 0): pytest.approx(35 / 37)}


# --- 7 language -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("trial", range(6))
def test_hot_texts_do_not_take_the_other_language(spark, trial):
    """Two languages of one repeated text each, in any hash order."""
    english, french = f"the cat sat on the mat and slept {trial}", f"le chat dort sur le tapis et rêve {trial}"
    docs = spark.range(1700).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 1200, english).otherwise(french).alias("text"), F.when(F.col("id") < 1200, "en").otherwise("fr").alias("lang")
    )
    found = language.identified(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang_pred <> lang").count() == 0


def test_rare_languages_are_learned_and_samples_bounded(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("text is not null and lang is not null").select("text", "lang")
    rare = spark.createDataFrame([("zzyx qwqw zyzx wqwq xyzzy " * 3, "xx")], "text string, lang string")
    model = language.fit(docs.union(docs).union(rare), sample=40)
    assert "xx" in model.languages and len(model.languages) == docs.select("lang").distinct().count() + 1


# --- 5 toxicity -----------------------------------------------------------------------------------------------------


def test_scores_do_not_depend_on_partitions(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    expected = None
    for parts in (1, 7, 13):
        found = {r["doc_id"]: r["score"] for r in toxicity.judged(docs.repartition(parts), labels.repartition(parts)).collect()}
        expected = expected or found
        assert found == expected


def test_samples_are_bounded_and_never_empty(spark):
    """Bounds far below one in a million of the rows, and one text with most of them."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").where("text is not null")
    hot = spark.range(3000).select(F.lit("one text again and again and again").alias("text"))
    seen = []
    original = toxicity._distinct_texts

    def counted(sample):
        seen.append({r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()})
        return original(sample)

    toxicity._distinct_texts = counted
    try:
        toxicity.fit(hot.union(docs), docs.union(hot), 0.1, max_positive=2, max_unlabelled=3)
    finally:
        toxicity._distinct_texts = original
    assert seen == [{True: 2, False: 3}]


# --- 2 pieces -------------------------------------------------------------------------------------------------------


def test_pieces_do_not_depend_on_the_chunks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    found = []
    for chars, rows in ((1 << 18, 256), (1 << 12, 3)):
        monkeypatch.setattr(pieces, "_CHUNK_CHARS", chars)
        monkeypatch.setattr(pieces, "_CHUNK_ROWS", rows)
        found.append({r["doc_id"]: r["piece_ids"] for r in pieces.encode(docs).collect()})
    assert found[0] == found[1]
