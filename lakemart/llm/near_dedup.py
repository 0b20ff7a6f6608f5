"""Near-duplicate classes by DartMinHash signatures, banded joins and exact verification.

Darts: every shingle owns a Poisson process over (weight, time), generated from its hash alone. A text keeps the darts
that land below its shingles' weights, and its signature holds, for each of k coordinates, the earliest dart. Two
texts agree in a coordinate with probability equal to their weighted Jaccard similarity, and a text needs about
k log k darts in all, however many shingles it has.

Classes: texts whose signatures agree in one band meet in a bucket. Within a bucket every text is compared with the
bucket's pivot, the text that shares most buckets, so a bucket of n texts gives n - 1 comparisons. Where that leaves
several components in one bucket, the rest is compared exactly in blocks of bounded size; a pair is left out only if
both are in one component already, if they met in an earlier band, or if the triangle inequality of the Jaccard
distance to the pivot excludes it. Blocks return a spanning set of links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.graph import connected_components
from lakemart.llm.words import mix64, seeded, text_shingles
from lakemart.operators.keys import join_to_grouped
from lakemart.session import apply_defaults, materialize

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 20
BAND_ROWS = 4
BLOCK_TEXTS = 256
# Bits of the screen that keeps most other texts out of the exchange of candidates' texts: 64 for each of these words.
SCREEN_WORDS = 1 << 17

_U64 = np.uint64


def _throw(elements: np.ndarray, weights: np.ndarray, horizon: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and times of the darts with time below ``horizon`` that land below the weights.

    The weight axis is cut into [0, 1), [1, 2), [2, 4), ...; each element has an independent Poisson process per
    strip, whose gaps come from a hash of element, strip and number of the dart.
    """
    ids, times = [], []
    low, width, strip = 0.0, 1.0, 0
    live = np.arange(len(elements))
    with np.errstate(over="ignore"):
        while True:
            live = live[weights[live] > low]
            if not len(live):
                break
            state = mix64(elements[live] ^ seeded(seed + strip, 1)[0])
            time, active = np.zeros(len(live)), np.arange(len(live))
            while len(active):
                state = mix64(state + _U64(0x9E3779B97F4A7C15))
                uniform = ((state >> _U64(11)).astype(np.float64) + 0.5) / 9007199254740992.0
                time = time - np.log(uniform) / width
                going = time < horizon
                active, time, state = active[going], time[going], state[going]
                height = low + width * (mix64(state ^ _U64(0x5851F42D4C957F2D)) >> _U64(11)).astype(np.float64) / 9007199254740992.0
                hit = height < weights[live[active]]
                ids.append(state[hit])
                times.append(time[hit])
            low, width, strip = low + width, max(1.0, low + width), strip + 1
    if not ids:
        return np.zeros(0, _U64), np.zeros(0)
    return np.concatenate(ids), np.concatenate(times)


def dart_signature(elements: np.ndarray, weights: np.ndarray, size: int, seed: int = 7) -> np.ndarray:
    """The signature of a weighted set of 64-bit elements; ``size`` numbers, empty for an empty set.

    Weights must be positive. The horizon starts where ``size * (log(size) + 3)`` darts are expected and doubles until
    every coordinate has one.
    """
    if not len(elements):
        return np.zeros(0, _U64)
    horizon = size * (np.log(size) + 3.0) / float(weights.sum())
    while True:
        ids, times = _throw(elements, weights, horizon, seed)
        order = np.argsort(-times, kind="stable")
        ids = ids[order]
        coordinate = (mix64(ids ^ _U64(0xA0761D6478BD642F)) % _U64(size)).astype(np.int64)
        signature, filled = np.zeros(size, _U64), np.zeros(size, bool)
        signature[coordinate] = ids  # of several darts the last one written, the earliest, stays
        filled[coordinate] = True
        if filled.all():
            return signature
        horizon *= 2


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band."""
    if not len(signature):
        return np.zeros(0, np.int64)
    parts = signature.reshape(bands, rows)
    key = seeded(11, bands)
    with np.errstate(over="ignore"):
        for row in range(rows):
            key = mix64((key ^ parts[:, row]) * _U64(0xD6E8FEB86659FD93))
    return key.view(np.int64)


def _long_lists(values: list[np.ndarray], kind: np.dtype) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind, copy=False)))


def sketch(docs: DataFrame, weighting: str = "set", bands: int = BANDS, rows: int = BAND_ROWS, words: int = SHINGLE_WORDS) -> DataFrame:
    """``key``, ``same_a``, ``same_b``, ``bands`` for every row of ``key, same_a, same_b, text``.

    ``weighting`` is "set" (each distinct shingle weighs 1) or "count" (it weighs as often as it occurs).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for _, hashes in text_shingles(batch.column("text"), words):
                elements, counts = np.unique(hashes, return_counts=True)
                weights = counts.astype(np.float64) if weighting == "count" else np.ones(len(elements))
                keys.append(band_keys(dart_signature(elements, weights, bands * rows), bands, rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("same_a"), batch.column("same_b"), _long_lists(keys, np.int64)],
                ["key", "same_a", "same_b", "bands"],
            )

    return docs.select("key", "same_a", "same_b", "text").mapInArrow(run, "key long, same_a long, same_b long, bands array<long>")


def _shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """``key`` and the sorted distinct 32-bit shingle hashes of every row of ``key, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique((h >> _U64(32)).astype(np.uint32)).view(np.int32) for _, h in text_shingles(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), _long_lists(sets, np.int32)], ["key", "shingles"])

    return texts.select("key", "text").mapInArrow(run, "key long, shingles array<int>")


def _screened(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``id`` and ``same_a`` may be among those of ``wanted``; none that is among them is left out.

    A bit map of hashed keys, at most ``SCREEN_WORDS`` rows however many keys there are, goes to every executor.
    """
    hashed = F.xxhash64("id", "same_a", F.lit(5))
    word, bit = F.pmod(hashed, F.lit(SCREEN_WORDS)).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hashed, 40).cast("int").bitwiseAND(63))
    bits = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    return texts.withColumn("word", word).join(F.broadcast(bits), "word").where(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of every left with every right set."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    shared = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets in (left, right):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets)
        code = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        there = both[code] == values if len(both) else np.zeros(len(values), bool)
        order = np.argsort(code[there], kind="stable")
        sides.append((owner[there][order], code[there][order]))
    for first in range(0, len(both), 4096):  # a bounded part of the common elements at a time
        dense = []
        for sets, (owner, code) in zip((left, right), sides, strict=True):
            low, high = np.searchsorted(code, [first, first + 4096])
            part = np.zeros((len(sets), 4096), np.float32)
            part[owner[low:high], code[low:high] - first] = 1
            dense.append(part)
        shared += dense[0] @ dense[1].T
    return shared


def _block_links(similarity: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """Spanning links of one pair of blocks of one bucket."""
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        rows = rows.drop_duplicates("key").reset_index(drop=True)
        left = rows[rows["block"] == low].reset_index(drop=True)
        right = rows[rows["block"] == high].reset_index(drop=True)
        sizes_l, sizes_r = left["shingles"].map(len).to_numpy(), right["shingles"].map(len).to_numpy()
        wanted = left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :]
        wanted &= np.abs(left["near"].to_numpy()[:, None] - right["near"].to_numpy()[None, :]) <= 1 - similarity + 1e-9
        band = int(rows["band"].iloc[0])
        if band and wanted.any():
            bands_l, bands_r = np.stack(left["bands"].to_list()), np.stack(right["bands"].to_list())
            for earlier in range(band):
                wanted &= bands_l[:, earlier][:, None] != bands_r[:, earlier][None, :]
        if not wanted.any():
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        shared = _overlaps(left["shingles"].to_list(), right["shingles"].to_list())
        wanted &= shared >= similarity * (sizes_l[:, None] + sizes_r[None, :] - shared) - 1e-6
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links = []
        for i, j in zip(*np.nonzero(wanted), strict=True):
            p, q = root(int(left["component"].iat[i])), root(int(right["component"].iat[j]))
            if p != q:
                parent[max(p, q)] = min(p, q)
                links.append((int(left["key"].iat[i]), int(right["key"].iat[j])))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return run


def _links(distinct: DataFrame, texts: DataFrame, bands: int, words: int, similarity: float) -> DataFrame:
    """Links ``a, b`` that connect all near-duplicate distinct texts of ``distinct`` (``key, same_a, same_b, least, bands``)."""
    spots = distinct.select("key", F.posexplode("bands").alias("band", "bucket"))
    full = materialize(spots.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = materialize(spots.join(full, "bucket"), "members")
    popular = materialize(members.groupBy("key").agg(F.sum("n").alias("popular")), "popular")
    pivots = materialize(
        members.join(popular, "key").groupBy("bucket").agg(F.max(F.struct("popular", (-F.col("key")).alias("negative"))).alias("best"))
        .select("bucket", (-F.col("best.negative")).alias("pivot")),
        "pivots",
    )
    stars = materialize(members.join(pivots, "bucket").select("bucket", "band", "key", "pivot"), "stars")
    pairs = materialize(stars.where("key <> pivot").select("key", "pivot").distinct(), "pairs")

    met = materialize(distinct.join(popular, "key").select("key", "same_a", "same_b", F.col("least").alias("id")), "met")
    # An inner join: a semi-join would be pushed below the screen. Rows that repeat both id and text are one.
    wanted = met.select("key", *[F.col(c).alias(f"{c}_2") for c in ("same_a", "same_b", "id")])
    found = _screened(texts, met).join(wanted, (F.col("same_a") == F.col("same_a_2")) & (F.col("same_b") == F.col("same_b_2")) & F.col("id").eqNullSafe(F.col("id_2")))
    found = found.dropDuplicates(["same_a", "same_b", "id"])
    sets = materialize(_shingle_sets(found, words), "shingles")
    mine = materialize(pairs.join(sets, "key"), "mine")
    other = sets.select(F.col("key").alias("pivot"), F.col("shingles").alias("theirs"))
    common = F.size(F.array_intersect("shingles", "theirs"))
    verified = materialize(
        mine.join(other, "pivot").select("key", "pivot", (common / (F.size("shingles") + F.size("theirs") - common)).alias("near")).dropDuplicates(["key", "pivot"]),
        "verified",
    )
    links = verified.where(F.col("near") >= similarity).select(F.col("key").alias("a"), F.col("pivot").alias("b"))

    # What the pivots left apart: buckets in which two or more components remain beside the pivot.
    parts = materialize(connected_components(links), "components")
    placed = materialize(
        stars.where("key <> pivot").join(verified, ["key", "pivot"])
        .join(parts.withColumnRenamed("node", "key"), "key", "left")
        .select("bucket", "band", "key", "near", F.coalesce("component", "key").alias("component")),
        "placed",
    )
    open_buckets = materialize(
        placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("first"), F.max("component").alias("last"))
        .where("first <> last").select("bucket", F.ceil(F.col("n") / BLOCK_TEXTS).cast("int").alias("blocks")),
        "open",
    )
    waiting = materialize(
        placed.join(open_buckets, "bucket").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")), "waiting"
    )
    carried = waiting.join(sets, "key").join(distinct.select("key", "bands"), "key")
    other_block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = carried.withColumn("other", other_block).select(
        "bucket", "band", "key", "near", "component", "block", "shingles", "bands",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    more = dealt.groupBy("bucket", "low", "high").applyInPandas(_block_links(similarity), "a long, b long")
    return links.union(materialize(more, "block_links"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text, same_a, same_b``: rows whose two hashes agree have the same text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    same_b = F.hash(text, F.lit(1), F.lit(text_col)).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("same_a"), same_b.alias("same_b"))


_SAME = ["same_a", "same_b"]


def _classes(base: DataFrame, weighting: str, bands: int, rows: int, words: int, similarity: float) -> DataFrame:
    """``same_a, same_b, least, n_copies, class`` of every distinct text: its smallest id, its rows, a number of its class."""
    signatures = materialize(sketch(base.withColumnRenamed("id", "key"), weighting, bands, rows, words), "signatures")
    copies = signatures.groupBy(*_SAME).agg(F.min("key").alias("least"), F.count("*").alias("n_copies"))
    # Texts are told apart by a number of their own: an id may stand for several texts, and a text for several ids.
    copies = materialize(copies.withColumn("node", F.monotonically_increasing_id()), "copies")
    numbered = copies.select(*[F.col(c).alias(f"{c}_2") for c in _SAME], "least", "node")
    own = (F.col("same_a") == F.col("same_a_2")) & (F.col("same_b") == F.col("same_b_2")) & F.col("key").eqNullSafe(F.col("least"))
    distinct = signatures.where(F.size("bands") > 0).join(numbered, own).dropDuplicates([*_SAME, "key"])
    distinct = materialize(distinct.select(F.col("node").alias("key"), *_SAME, "least", "bands"), "distinct")
    links = _links(distinct, base, bands, words, similarity)
    parts = materialize(connected_components(links), "classes")
    return materialize(
        copies.join(parts, "node", "left").select(*_SAME, "least", "n_copies", F.coalesce("component", "node").alias("class")), "class_of_text"
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    weighting: str = "set",
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    words: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row ``id, class_id, n_copies`` per input row; ``class_id`` is the smallest id of the class.

    Texts are in one class if they are equal, or joined by a chain of pairs whose distinct shingles have a Jaccard
    similarity of at least ``similarity``. Signatures find a pair at exactly 0.8 with probability 1 - 3e-5 and a
    more similar one with a higher probability. ``n_copies`` counts the rows with the very same text.

    Texts are compared, not ids: rows that share an id but not the text are in classes of their own texts. Null and
    empty texts are equal texts; a text without words is in a class with equal texts only. Rows with a null id are
    compared like others; only a class in which no row has an id is named by a negative stand-in, a hash. Negative ids are
    ids like others. Repeated rows stay repeated, an empty table gives an empty result, other columns are ignored.
    """
    apply_defaults(docs.sparkSession)
    base = _texts(docs, id_col, text_col)
    texts = _classes(base, weighting, bands, rows, words, similarity)
    stand_in = -F.shiftrightunsigned(F.min("same_a"), 2) - 1
    names = texts.groupBy("class").agg(F.coalesce(F.min("least"), stand_in).alias("class_id"))
    named = materialize(join_to_grouped(texts, names, "class").select(*_SAME, "class_id", "n_copies"), "named")
    return base.select("id", *_SAME).join(named, _SAME).select(F.col("id").alias(id_col), "class_id", "n_copies")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class, columns unchanged: one with the class's smallest id, or of ties the smallest hash.

    A text goes only if its class has another row that stays. Rows that repeat the representative's id and text are one
    document; one of them stays. Columns may have any names; nulls and empty tables as in ``near_duplicates``.
    """
    apply_defaults(docs.sparkSession)
    texts = _classes(_texts(docs, id_col, text_col), "set", BANDS, BAND_ROWS, SHINGLE_WORDS, SIMILARITY)
    first = F.min(F.struct(F.col("least").isNull().alias("no_id"), "least", *_SAME))
    heads = texts.groupBy("class").agg(first.alias("head")).select("head.least", "head.same_a", "head.same_b")
    heads = materialize(heads, "heads")
    names = {c: f"_{c}" + "_" * max([0, *[len(d) for d in docs.columns]]) for c in ("same_a", "same_b", "id")}
    text = F.coalesce(F.col(text_col), F.lit(""))
    marked = docs.withColumns({names["same_a"]: F.xxhash64(text), names["same_b"]: F.hash(text, F.lit(1), F.lit(text_col)).cast("long"), names["id"]: F.col(id_col).cast("long")})
    own = F.col(names["id"]).eqNullSafe(F.col("head_id"))
    heads = heads.select(*[F.col(c).alias(names[c]) for c in _SAME], F.col("least").alias("head_id"))
    kept = marked.alias("d").join(heads.alias("h"), [F.col(f"d.{names[c]}") == F.col(f"h.{names[c]}") for c in _SAME] + [own], "left_semi")
    return kept.dropDuplicates([names["same_a"], names["same_b"]]).drop(*names.values())
