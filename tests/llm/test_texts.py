"""Operators on documents against brute force, and their edge cases."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from lakemart.llm import decontaminate, graph, language, licenses, near_dedup, pieces, pii, toxicity, words

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


def docs_of(spark, *texts_):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts_)], DDL)


def word_list(text):
    return re.findall(r"[0-9A-Za-z_\x80-\U0010ffff]+", (text or "").lower())


def shingle_set(text, size=5):
    found = word_list(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


# --- words ----------------------------------------------------------------------------------------------------------


def test_word_hashes_tell_words_apart_and_ignore_batches():
    samples = ["The cat, the CAT; ünder_score 7", "", None, "cat", "a" * 5000 + " b", "x"]
    data, offsets = words.text_buffer(pa.array(samples))
    hashes, _, bounds = words.word_hashes(data, offsets)
    split = [word_list(s) for s in samples]
    assert np.diff(bounds).tolist() == [len(s) for s in split]
    known = {}
    for word, value in zip([w for s in split for w in s], hashes.tolist(), strict=True):
        assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)
    alone = words.word_hashes(*words.text_buffer(pa.array(["cat"])))[0]
    assert alone[0] == known["cat"]


def test_hashing_holds_a_bounded_number_of_words():
    import tracemalloc

    data = np.frombuffer((b"some words and more of them " * 75_000)[:2_000_000], np.uint8)
    tracemalloc.start()
    hashes, first, _ = words.word_hashes(data, np.array([0, 700_001, 700_001, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(hashes) == len(first) > 400_000 and peak < 30e6


def test_long_words_over_block_edges(monkeypatch):
    monkeypatch.setattr(words, "BLOCK_BYTES", 16)
    text = "short words and " + "l" * 100 + " end of it"
    blocks = words.word_hashes(*words.text_buffer(pa.array([text])))[0]
    monkeypatch.undo()
    assert blocks.tolist() == words.word_hashes(*words.text_buffer(pa.array([text])))[0].tolist()


# --- 1 personal data ------------------------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), order, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def test_base_spans_equal_the_plain_patterns(spark, documents):
    odd = docs_of(
        spark, None, "", "a@b.cd_x@e.f.g 1.2.3.4.5.6.7.8 999.1.1.1", "é😀 4111 1111 1111 1111, 4111-1111-1111-1112", "+1 (415) 555-2671 +12",
        "x" * 3000 + "@" + "y" * 3000, "0" * 4000, "a@b.c " * 700, "+1-" * 500, "01.002.3.4 1.2.3.256",
    )
    frame = documents.union(odd).withColumn("spans", F.lit("clash"))
    result = pii.digest(frame).collect()
    source = {(r["doc_id"], r["text"] or "") for r in frame.collect()}
    expected = {}
    for key, text in source:
        expected.setdefault(key, set()).add(hashlib.sha256(",".join(base_spans(text)).encode()).hexdigest())
    assert len(result) == documents.count() + odd.count()
    assert {(r["doc_id"], r["base_sha256"]) for r in result} == {(k, h) for k, hs in expected.items() for h in hs}
    assert pii.digest(documents.limit(0)).count() == 0


def test_checksums_and_context_decide_on_further_kinds(spark):
    frame = docs_of(spark, "IBAN DE89 3704 0044 0532 0130 00.", "DE89370400440532013001", "SSN 123-45-6789", "part 123-45-6789", "ssn 000-45-6789")
    found = {r["doc_id"]: r["spans"] for r in pii.digest(frame).collect()}
    assert found == {0: "iban:5:32", 1: "", 2: "ssn:4:15", 3: "", 4: ""}
    scores = {r["kind"]: r["score"] for r in pii.find_spans(docs_of(spark, "call +1 415 555 2671", "write to a@b.cd")).select(F.inline("pii")).collect()}
    assert scores["phone"] == pytest.approx(0.9) and scores["email"] == pytest.approx(1.0)


def test_masking(spark):
    frame = docs_of(spark, "é a@b.cd, 10.0.0.1!", None, "nothing", "")
    result = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.mask(frame).collect()}
    assert result == {0: ("é <email>, <ip>!", 16), 1: (None, None), 2: ("nothing", 7), 3: ("", 0)}
    assert pii.mask(frame).columns == frame.columns


# --- 2 pieces -------------------------------------------------------------------------------------------------------


def test_segmentations_are_lossless_and_repeatable(spark, documents):
    odd = docs_of(spark, None, "", " ", "  two  spaces ", "▁ literal ▁▁", "tab\tand\nline\x00😀日本語", "x" * 20000, "y " * 5000)
    frame = documents.union(odd).select("doc_id", "text").withColumn("piece_ids", F.lit("clash"))
    one = pieces.encode(frame)
    assert one.where("text is not null and not lossless").count() == 0
    assert one.where("text is null").select("piece_ids", "n_pieces", "lossless").first() == (None, 0, None)
    decoded = pieces.decode(one.drop("text"))
    assert rows(decoded.select("doc_id", "text")) == rows(frame.select("doc_id", "text"))
    again = pieces.encode(frame.repartition(13))
    assert rows(one.select("doc_id", "n_pieces", F.hash("piece_ids"))) == rows(again.select("doc_id", "n_pieces", F.hash("piece_ids")))
    other = pieces.encode(frame, seed=2)
    assert rows(one.select("doc_id", F.hash("piece_ids"))) != rows(other.select("doc_id", F.hash("piece_ids")))
    assert pieces.encode(frame.limit(0)).count() == 0


def test_samples_follow_the_lattice_weights():
    """Frequencies of all segmentations of a word against their enumerated probabilities."""
    model = pieces.load_model()
    weights = {}
    from sentencepiece import SentencePieceProcessor

    vocabulary = SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    for number in range(vocabulary.get_piece_size()):
        if not (vocabulary.is_byte(number) or vocabulary.is_control(number) or vocabulary.is_unknown(number)):
            weights[vocabulary.id_to_piece(number)] = (number, (-vocabulary.get_score(number) + pieces.RANK_OFFSET) ** -pieces.ALPHA)

    def segmentations(text):
        if not text:
            yield (), 1.0
        for end in range(1, len(text) + 1):
            if text[:end] in weights:
                number, weight = weights[text[:end]]
                for rest, chance in segmentations(text[end:]):
                    yield (number, *rest), weight * chance

    every = dict(segmentations("▁there"))
    n = 40000
    ids, sizes = pieces._sampled(["there"] * n, words.mix64(np.arange(n, dtype=np.uint64)), model)
    counts = {}
    for part in np.split(ids, np.cumsum(sizes)[:-1]):
        counts[tuple(part.tolist())] = counts.get(tuple(part.tolist()), 0) + 1
    total = sum(every.values())
    assert set(counts) <= set(every)
    for segmentation, chance in every.items():
        p = chance / total
        assert abs(counts.get(segmentation, 0) / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-4


# --- 5 toxicity, 7 language -----------------------------------------------------------------------------------------


def test_toxic_words_are_learned_from_positives_and_unlabelled(spark):
    rng = np.random.default_rng(0)
    vocabulary = [f"word{i}" for i in range(200)]

    def text(toxic):
        own = list(rng.choice(vocabulary, 40))
        return " ".join([*own, *(["vile", "nasty"] if toxic else [])])

    made = [(i, text(i % 8 == 0), int(i % 8 == 0)) for i in range(2400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in made] + [(10**6, None), (10**6 + 1, ""), (None, "vile nasty")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in made if i % 2 == 0] + [(None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    result = {r["doc_id"]: r for r in toxicity.judged(docs, labels).collect()}
    assert len(result) == 2403
    wrong = [i for i, _, y in made if result[i]["predicted"] != y]
    assert not wrong
    assert result[10**6]["predicted"] == result[10**6 + 1]["predicted"] == 0 and result[None]["predicted"] == 1
    kept = toxicity.without_toxic(docs, toxicity.fit_on_labels(docs, labels))
    assert kept.columns == docs.columns and kept.count() == 2400 - 300 + 2
    nothing = toxicity.judged(docs.limit(0), labels.limit(0))
    assert nothing.count() == 0
    assert {r["predicted"] for r in toxicity.judged(docs, labels.limit(0)).collect()} == {0}


def test_the_risk_does_not_go_below_zero():
    """With far too high a prior the correction keeps weights of a useless feature small."""
    rng = np.random.default_rng(1)
    positive = np.arange(400) < 100
    on = rng.random(400) < 0.5
    weights, _ = toxicity.fit_nnpu(np.flatnonzero(on), np.zeros(on.sum(), int), positive, 1, 0.1)
    assert abs(weights[0]) < 1.5


def test_language_accuracy_and_undetermined_texts(spark, documents):
    odd = docs_of(spark, None, "", "123 456 !!", "x" * 50000)
    result = {r["doc_id"]: r for r in language.identified(documents.where("doc_id > 10").union(odd)).collect()}
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    held = [r for r in result.values() if r["held_out"] and r["doc_id"] > 10]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.85
    assert [(result[i]["lang_pred"], result[i]["score"]) for i in (0, 1, 2)] == [("und", 0.0)] * 3
    assert all(0 <= r["score"] <= 1 for r in result.values())
    assert {r["lang_pred"] for r in language.identified(odd).collect()} == {"und"}
    assert language.identified(documents.limit(0)).count() == 0


# --- 6 licenses -----------------------------------------------------------------------------------------------------


def test_licenses_equal_exact_containment(spark, documents, texts):
    long_notice = licenses.TEMPLATES["MIT-text"].replace("free of charge", "at no cost")
    extra = {10**6: "start " + long_notice + " end", 10**6 + 1: None, 10**6 + 2: "", 10**6 + 3: "Released under the MIT License"}
    frame = documents.select("doc_id", "text").union(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    found = {(r["doc_id"], r["license"]): r["containment"] for r in licenses.find_licenses(frame).collect()}

    def simple(text):
        return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]

    def grams(text):
        own = simple(text)
        return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()

    for doc, text in {**texts, **extra}.items():
        own = grams(text)
        for name, template in licenses.TEMPLATES.items():
            share = len(grams(template) & own) / len(grams(template))
            if (doc, name) in found:
                assert found[doc, name] <= share + 1e-9
            elif share >= 1:
                raise AssertionError((doc, name))
    assert found[10**6, "MIT-text"] >= 0.8 and found[10**6 + 3, "MIT"] == 1
    assert licenses.find_licenses(frame.limit(0)).count() == licenses.find_licenses(frame, {}).count() == 0


# --- 8 decontamination ----------------------------------------------------------------------------------------------


def test_leaks_equal_the_best_window(spark, documents, texts):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    item_texts = {r["item_id"]: r["text"] for r in items.collect()}
    first = word_list(item_texts[0])
    changed = [*first[:-1], "other"]
    extra = {10**6: "before " + " ".join(changed) + " after", 10**6 + 1: None, 10**6 + 2: "", 10**6 + 3: item_texts[1], 10**6 + 4: "w " * 40000 + item_texts[2]}
    frame = documents.select("doc_id", "text").union(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    more = items.select("item_id", "text").union(spark.createDataFrame([(None, "four words only here"), (900, None), (901, "")], "item_id long, text string"))
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(frame, more).collect()}
    for doc, text in {**texts, **extra}.items():
        own = word_list(text)
        have = {g for g in zip(own, own[1:], own[2:], own[3:], own[4:], strict=False)}
        for item, item_text in item_texts.items():
            target = word_list(item_text)
            grams = {g for g in zip(target, target[1:], target[2:], target[3:], target[4:], strict=False)}
            if grams <= have:
                assert found[doc, item] > 0.99
            if len(grams & have) < 0.8 * len(grams):
                assert (doc, item) not in found
    assert 0.8 <= found[10**6, 0] < 1 and found[10**6 + 3, 1] == 1 and found[10**6 + 4, 2] == 1
    clean = decontaminate.without_leaks(frame, more)
    assert {r["doc_id"] for r in clean.collect()} == set({**texts, **extra}) - {d for d, _ in found}
    passes = decontaminate.leaks(frame, more, chars_per_pass=2000)
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in passes.collect()} == found
    assert decontaminate.leaks(frame.limit(0), more).count() == decontaminate.leaks(frame, more.limit(0)).count() == 0


# --- 9 near-duplicates ----------------------------------------------------------------------------------------------


def classes_by_force(texts_):
    parent = {d: d for d in texts_}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {d: shingle_set(t) for d, t in texts_.items()}
    ids = sorted(texts_)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            same = (texts_[a] or "") == (texts_[b] or "")
            both = len(sets[a] & sets[b])
            if same or (both and both / len(sets[a] | sets[b]) >= 0.8):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in texts_}


def test_classes_equal_brute_force(spark, documents, texts):
    rng = np.random.default_rng(4)
    base = [f"w{n}" for n in rng.integers(0, 10**6, 120)]
    made = {}
    for n in range(120):  # a star of copies most of which are no near copies of each other, without its centre
        own = list(base)
        for place in rng.choice(120, 2, replace=False):
            own[place] = f"x{n}_{place}"
        made[10**6 + n] = " ".join(own)
    made |= {2 * 10**6: None, 2 * 10**6 + 1: "", 2 * 10**6 + 2: "!!", 2 * 10**6 + 3: "one", 2 * 10**6 + 4: "One.", 2 * 10**6 + 5: "long " * 30000, 2 * 10**6 + 6: "long " * 30000}
    every = {**texts, **made}
    frame = documents.select("doc_id", "text").union(spark.createDataFrame(list(made.items()), "doc_id long, text string"))
    frame = frame.withColumn("class_id", F.lit("clash")).withColumn("bucket", F.lit(1))
    result = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicates(frame).collect()}
    assert result == classes_by_force(every)
    kept = near_dedup.keep_one(frame)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(result.values()))
    assert kept.columns == frame.columns


def test_repeated_rows_null_ids_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "alone here"), (None, None)], "doc_id long, text string")
    result = near_dedup.near_duplicates(frame).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_copies"]) for r in result if r["class_id"] == 1 and r["doc_id"]) == [(1, 1, 3)] * 2
    assert len(result) == 5 and sum(r["class_id"] < 0 for r in result) == 2
    assert near_dedup.keep_one(frame).count() == 3
    assert near_dedup.near_duplicates(frame.limit(0)).count() == near_dedup.keep_one(frame.limit(0)).count() == 0


def test_texts_are_compared_not_ids(spark):
    base = [f"w{i}" for i in range(60)]
    near = " ".join([*base[:-1], "end"])
    base = " ".join(base)
    made = [
        (5, base), (None, near),  # a row without an id takes the name of its class
        (1, "one text of this id"), (1, "quite another text that shares the id only"), (1, "one text of this id"),
        (-7, "negative ids are ids"), (-3, "negative ids are ids"), (9, "Negative ids, are ids"), (2, None), (3, ""),
    ]
    frame = spark.createDataFrame([(*m, "clash", "clash") for m in made], "doc_id long, text string, _same_a string, least string")
    found = sorted(((r["doc_id"], r["class_id"], r["n_copies"]) for r in near_dedup.near_duplicates(frame).collect()), key=str)
    assert found == sorted([(5, 5, 1), (None, 5, 1), (1, 1, 2), (1, 1, 2), (1, 1, 1), (-7, -7, 2), (-3, -7, 2), (9, -7, 1), (2, 2, 2), (3, 2, 2)], key=str)
    kept = near_dedup.keep_one(frame)
    assert kept.columns == frame.columns
    expected = [(-7, "negative ids are ids"), (1, "one text of this id"), (1, "quite another text that shares the id only"), (2, None), (5, base)]
    assert rows(kept.select("doc_id", "text")) == sorted(expected, key=str)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    elements = words.mix64(np.arange(1, 301, dtype=np.uint64))
    a, b = rng.integers(1, 6, 300).astype(float), rng.integers(1, 6, 300).astype(float)
    a[:60] = b[:60] = 2.0
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    agree = np.mean([np.mean(near_dedup.dart_signature(elements, a, 64, s) == near_dedup.dart_signature(elements, b, 64, s)) for s in range(0, 4000, 100)])
    assert abs(agree - true) < 0.04


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (102, 102), (None, 5), (200, 100)]
    found = dict(rows(graph.connected_components(spark.createDataFrame(edges, "a long, b long"))))
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
