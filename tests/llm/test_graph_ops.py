"""SimHash classes, the prefix trie and hard negatives against brute force."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from lakemart.llm import hard_negatives, prefix_trie, queries, simhash, sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# --- 11 SimHash -----------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(prints, ids, radius=4):
    """Smallest id reachable over all pairs within the radius, by plain search."""
    codes = np.array(prints, np.uint64)
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= radius
    found = [None] * len(codes)
    for start in range(len(codes)):
        if found[start] is None:
            reached, queue = {start}, [start]
            while queue:
                for other in np.flatnonzero(near[queue.pop()]).tolist():
                    if other not in reached:
                        reached.add(other)
                        queue.append(other)
            least = min((ids[i] for i in reached if ids[i] is not None), default=None)
            for i in reached:
                found[i] = (least,)
    return [f[0] for f in found]


TEXTS = [
    None, "", "  \t\n", "one", "One two  THREE", "a b c d", "a b c d e", "Ä ß É b c", "x y z w v", "w" * 3000,
    "the same words again and again " * 40, "the same words again and again " * 40 + "but", "\x0b\x0cvertical\x1ctab x y z",
]


def test_fingerprints_equal_the_plain_rule(monkeypatch):
    for piece in (1 << 20, 7):  # long texts are read in pieces
        monkeypatch.setattr(simhash, "TEXT_BYTES", piece)
        for text in TEXTS:
            assert simhash.fingerprint((text or "").encode()) % 2**64 == plain_fingerprint(text)


@pytest.mark.parametrize(("block", "group"), [(8192, 1024), (32, 2)])
def test_classes_equal_all_pairs(spark, monkeypatch, block, group):
    """Whole documents, odd rows, many near fingerprints; also with small blocks, so that hot patterns fill several."""
    monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
    monkeypatch.setattr(simhash, "GROUP_ROWS", group)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    base = "many documents share these very words and differ in only one of them at the end " * 30
    odd = [(10**6 + i, t) for i, t in enumerate(TEXTS)] + [(None, "a b c d"), (10**6, "another text of one id"), (-5, TEXTS[10])]
    odd += [(2 * 10**6 + i, f"{base} w{i}") for i in range(120)]
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("fingerprint", F.lit("clash"))
    found = simhash.near_duplicates(docs).collect()
    texts = docs.collect()
    prints = [plain_fingerprint(r["text"]) for r in texts]
    expected = zip([r["doc_id"] for r in texts], prints, classes(prints, [r["doc_id"] for r in texts]), strict=True)
    assert sorted(map(str, ((r[0], r[1] % 2**64, r[2]) for r in found))) == sorted(map(str, expected))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_random_codes_are_tied_as_all_pairs_are():
    rng = np.random.default_rng(5)
    for radius, count in ((4, 600), (2, 300), (4, 17), (4, 1)):
        seeds = rng.integers(0, 2**63, max(1, count // 9), dtype=np.uint64)
        flips = [sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, radius + 3))}) for _ in range(count)]
        codes = np.unique(np.array([int(s) ^ f for s, f in zip(rng.choice(seeds, count), flips, strict=True)], np.uint64))
        for group in (1024, 1):
            orders, leading = simhash.orders_for(len(codes) * (1 if group == 1024 else 1 << 20), radius)
            root = np.arange(len(codes))
            for order in orders:
                place = np.argsort(simhash.gray_rank(codes, order))
                assert len(set(simhash.gray_rank(codes, order).tolist())) == len(codes)
                root = simhash._tie(root, place, place[simhash.ties(codes[place], simhash.leading_mask(order, leading), radius)])
            assert root.tolist() == classes(codes, list(range(len(codes))), radius)


def test_neighbours_in_gray_order_differ_in_one_bit():
    order = [(0, 32), (32, 32)]
    ranks = np.sort(simhash.gray_rank(np.arange(256, dtype=np.uint64) << np.uint64(24), order))
    codes = {int(simhash.gray_rank(np.array([c << 24], np.uint64), order)[0]): c for c in range(256)}
    walk = [codes[int(r)] for r in ranks]
    assert all((a ^ b).bit_count() == 1 for a, b in zip(walk, walk[1:], strict=False))


# --- 12 prefix trie -------------------------------------------------------------------------------------------------


def plain_trie(sequences):
    """Rows of the trie over {conv: [(role, text), ...]}, by walking every prefix."""
    members = defaultdict(list)
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    found = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        ends = ",".join(map(str, sorted(c for c in members[node] if len(sequences[c]) == len(node))))
        found[node] = (
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(children[node]),
            sum(found[c][5] for c in children[node]) or 1, own + sum(found[c][6] for c in children[node]), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return sorted(found.values(), key=str)


def grafted(sequences):
    result = {}
    for conv, turns in sequences.items():
        h = zlib.crc32(str(conv).encode()) % 4
        result[conv] = sequences.get(conv - conv % 20, [])[:h] + turns[h:]
    return result


TURNS = "conv_id long, turn long, role string, text string, depth string"


def random_conversations(seed, count):
    rng = np.random.default_rng(seed)
    return {int(c): [("u" if i % 2 == 0 else "a", "w " * int(rng.integers(0, 3))) for i in range(rng.integers(1, 24))] for c in rng.choice(400, count, replace=False)}


def as_rows(sequences):
    return [(c, i, r, t, "clash") for c, turns in sequences.items() for i, (r, t) in enumerate(turns)]


@pytest.mark.parametrize("batches", [(16,), (1, 2, 4, 8, 16), (4, 16)])
def test_trie_equals_all_prefixes(spark, monkeypatch, batches):
    """However the conversations are cut into batches; short texts make many shared prefixes and cut edges."""
    monkeypatch.setattr(prefix_trie, "BATCHES", batches)
    monkeypatch.setattr(prefix_trie, "PIECE_TURNS", 5)
    monkeypatch.setattr(prefix_trie, "IDS_AT_ONCE", 2)
    sequences = random_conversations(len(batches), 60)
    sequences[1001] = sequences[1002] = sequences[1003] = [("u", "x y")] * 40  # copies, and one turn again and again
    sequences[1004] = [("u", "x y")] * 33
    found = prefix_trie.prefix_trie(spark.createDataFrame(as_rows(sequences), TURNS))
    assert sorted(map(tuple, found.collect()), key=str) == plain_trie(sequences)


def test_grafts_nulls_ties_and_repeats(spark):
    sequences = random_conversations(9, 40)
    table = as_rows(sequences) + [
        (500, 3, "a", None, "x"), (500, None, None, "first", "x"), (500, 3, "a", "tie", "x"), (500, 3, "a", "tie", "x"),
        (None, 1, "u", "lost", "x"), (521, 0, "u", "only", "x"), (-40, 0, "u", "neg", "x"), (-41, 0, "u", "neg", "x"), (-41, 1, "u", "neg", "x"),
    ]
    digest = lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
    turns = defaultdict(list)
    for conv, turn, role, text, _ in table:
        if conv is not None:
            turns[conv].append((turn is not None, turn, role or "", digest(role or "", text or ""), text or ""))
    plain = {c: [(t[2], t[4]) for t in sorted(found, key=lambda t: t[:4])] for c, found in turns.items()}
    # A remainder has the sign of the id.
    rebuilt = {c: plain.get(c - int(np.fmod(c, 20)), [])[: zlib.crc32(str(c).encode()) % 4] + plain[c][zlib.crc32(str(c).encode()) % 4 :] for c in plain}
    found = prefix_trie.trie(*prefix_trie.regrafted(spark.createDataFrame(table, TURNS)))
    assert sorted(map(tuple, found.collect()), key=str) == plain_trie(rebuilt)
    assert any(not t for t in rebuilt.values()) and grafted({40: [("u", "a")]}) == {40: [("u", "a")]}


def test_one_conversation_and_none(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(empty).count() == 0
    one = {7: [("u", "a b"), ("a", "c")]}
    assert sorted(map(tuple, prefix_trie.prefix_trie(spark.createDataFrame(as_rows(one), TURNS)).collect()), key=str) == plain_trie(one)
    turnless = prefix_trie.trie(empty.selectExpr("conv_id", "turn depth", "role symbol", "turn words"), spark.createDataFrame([(4, 0), (3, 0)], "conv_id long, length long"))
    assert [tuple(r) for r in turnless.collect()] == plain_trie({3: [], 4: []})


def duck(sf_dir, table, text):
    connection = duckdb.connect()
    connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return sorted(connection.execute(text).fetchall(), key=str)


def test_trie_query_equals_sql(spark):
    found = queries.op12_prefix_trie(spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=str) == duck(SF_DIR, "conversations", sql.PREFIX_TRIE)


# --- 13 hard negatives ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [1, 300, 10**6, 10**9, 2**62])
@pytest.mark.parametrize("dimension", [1, 7, 64])
def test_packed_products_are_exact(limit, dimension):
    rng = np.random.default_rng(limit % 97 + dimension)
    rows_, anchors = (rng.integers(-limit, limit, (n, dimension), endpoint=True) for n in (41, 6))
    packed = hard_negatives.Packed(rows_, limit)
    assert (packed.scores(anchors).astype(object) == anchors.astype(object) @ rows_.astype(object).T).all()
    if limit == 300:
        assert packed.fields == 2  # two candidates for each multiplication
    ends = np.array([[limit] * dimension, [-limit] * dimension])
    assert (hard_negatives.Packed(ends, limit).scores(ends).astype(object) == ends.astype(object) @ ends.astype(object).T).all()


def plain_negatives(table, is_anchor):
    kept = sorted({(i, lab, tuple(int(np.floor(256.0 * x)) for x in v)) for i, lab, v in table
                   if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)})
    longest = max((len(v) for _, _, v in kept), default=0)
    kept = [(i, lab, v + (0,) * (longest - len(v))) for i, lab, v in kept]
    found = []
    for a, label, v in kept:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, lab == label) for i, lab, w in kept if i != a)
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            fit = [s for s in scored if not s[2] and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            found += [(a, positive, rank, i, -p, -s) for rank, (s, i, _) in enumerate(fit, 1)]
    return sorted(found)


@pytest.mark.parametrize("block", [16_384, 300])
def test_negatives_equal_brute_force(spark, monkeypatch, block):
    """Ties, copies under one id and under many, odd vectors and labels; also with several blocks."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    rng = np.random.default_rng(2)
    table = [(int(i), int(rng.integers(0, 3)), [float(x) for x in rng.normal(size=6) + 0.4]) for i in range(700)]
    table += [(1000 + i, i % 3, [0.5] * 6) for i in range(200)]  # one vector under many ids
    table += table[:20] + [(50, 0, [1.0] + [0.0] * 5), (50, 1, [1.0] + [0.0] * 5)]  # rows again, and an id with other rows
    table += [
        (None, 1, [1.0] * 6), (2001, None, [1.0] * 6), (2002, 1, None), (2003, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2004, 1, [float("nan")] * 6),
        (2005, 1, [float("inf")] * 6), (2050, 2, [0.0] * 6), (2100, 2, []), (2150, 0, [2.0]), (2200, 9, [1.0] * 6),
    ]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in table], "vec_id long, label int, embedding array<double>, key string, rank int")
    found = hard_negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0)
    assert rows(found) == sorted(plain_negatives(table, lambda i: i % 50 == 0), key=str)
    assert hard_negatives.hard_negatives(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_huge_components_do_not_fail(spark):
    table = [(0, 1, [1e300, -1e300]), (1, 1, [1e18, 1.0]), (2, 2, [1.0, 1.0]), (3, 1, [-1e300, 5.0])]
    frame = spark.createDataFrame(table, "vec_id long, label int, embedding array<double>")
    assert hard_negatives.hard_negatives(frame, F.col("vec_id") == 0).count() >= 0


def test_negatives_query_equals_sql(spark):
    found = queries.op13_hard_negatives(spark, SF_DIR)
    assert sorted(map(tuple, found.collect()), key=str) == duck(SF_DIR, "embeddings", sql.HARD_NEGATIVES)
