"""SimHash classes by a hierarchical index over Gray-ordered fingerprints.

Orders: the 64 bits are cut into parts, more of them than the radius. Two fingerprints within the radius agree in all
but ``radius`` parts, so there is a set of parts that they share whole. Each such set gives one order of the distinct
fingerprints: its bits lead, and the rows are sorted by Gray rank, which puts fingerprints with few differences next
to each other. In the order of a set only pairs that agree in its bits are looked for; every other pair has an order
of its own. More fingerprints take more parts, hence longer leading patterns; no number of parts loses a pair.

Index: an order is cut into blocks of consecutive rows. Within a block 16 neighbours form a node, 16 nodes the next,
and so on. A node holds the bits all its members share, less those its parent holds already. A search walks down from
the top and adds up the differences to the held bits; a node beyond the radius is left out with all below it, and so
is one whose members are tied to the searching fingerprint already. Where fingerprints with equal leading bits fill
several blocks, the blocks' shared patterns are compared first, and the pairs of blocks that remain are searched.

A block returns each fingerprint's tie to its block's representative, never all pairs; connected components of the
ties are the classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.graph import connected_components
from lakemart.operators.keys import join_to_grouped
from lakemart.operators.ranking import global_row_number
from lakemart.session import apply_defaults, materialize

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BITS = 64
BLOCK_ROWS = 8192
FAN = 16
# So many fingerprints, on average, may share the leading bits of an order before the bits are cut into more parts.
GROUP_ROWS = 1024
TEXT_BYTES = 1 << 20
_SEARCHES = 256

_U64 = np.uint64
_ALL = _U64(2**64 - 1)
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _word_blocks(text: bytes, size: int) -> Iterator[list[bytes]]:
    """Words of a text in pieces, each beginning with the last ``size - 1`` words of the piece before."""
    position, words = 0, []
    while position < len(text):
        end = position + TEXT_BYTES
        cut = _SPACE.search(text, end) if end < len(text) else None
        end = cut.start() if cut else len(text)
        words = words[max(0, len(words) - size + 1) :] + text[position:end].lower().split()
        yield words
        position = end


def fingerprint(text: bytes, size: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The majority of each bit over the hashes of all shingles, as a signed 64-bit number; zero without words."""
    ones, count, words = np.zeros(BITS, np.int64), 0, []
    for words in _word_blocks(text, size):
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(words) else ends
        spans = list(zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)) if len(words) >= size else []
        hashes = np.fromiter((xxhash.xxh64_intdigest(line[a:b], seed) for a, b in spans), _U64, len(spans))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        count += len(spans)
    if not count and words:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], _U64)
        ones, count = np.unpackbits(hashes.view(np.uint8), bitorder="little").astype(np.int64), 1
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` (a signed long) of every row; whole texts, A-Z lower-cased, words between white space.

    Null, empty and blank texts give zero. A text of fewer words than a shingle counts as one shingle. Long texts are
    read in pieces. Other columns are not read, repeated rows stay, an empty table gives none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            found = [fingerprint(t.as_py() or b"") for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["key", "fingerprint"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(work, f"key {kind}, fingerprint long").withColumnRenamed("key", key)


def orders_for(count: int, radius: int = RADIUS) -> tuple[list[list[tuple[int, int]]], int]:
    """Orders for so many fingerprints, each a list of (lowest bit, width) from the leading part on, and the least
    number of leading bits."""
    for parts in range(radius + 1, radius + 5):
        leading = (parts - radius) * (BITS // parts)
        if count >> leading <= GROUP_ROWS:
            break
    cuts = [BITS * i // parts for i in range(parts + 1)]
    spans = [(cuts[i], cuts[i + 1] - cuts[i]) for i in range(parts)]
    chosen = combinations(range(parts), parts - radius)
    return [[spans[i] for i in c] + [spans[i] for i in range(parts) if i not in c] for c in chosen], leading


def gray_rank(codes: np.ndarray, order: list[tuple[int, int]]) -> np.ndarray:
    """Place of each code in the Gray sequence after its parts are put in order."""
    rank, low = np.zeros(len(codes), _U64), BITS
    for first, width in order:
        low -= width
        rank |= ((codes >> _U64(first)) & _U64(2**width - 1)) << _U64(low)
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> _U64(step)
    return rank


def leading_mask(order: list[tuple[int, int]], leading: int) -> int:
    """The bits of a fingerprint that lead an order."""
    mask = 0
    for first, width in order:
        taken = min(width, leading)
        mask |= (2**taken - 1) << (first + width - taken)
        leading -= taken
    return mask


def _levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """From the codes up: pattern, held bits and last place of each node; held bits exclude those of the parent."""
    both, either, last = codes, codes, np.arange(len(codes))
    found = [(both, np.full(len(codes), _ALL), last)]
    while len(both) > FAN:
        starts = np.arange(0, len(both), FAN)
        both, either = np.bitwise_and.reduceat(both, starts), np.bitwise_or.reduceat(either, starts)
        last = last[np.minimum(starts + FAN, len(last)) - 1]
        found.append((both, ~(both ^ either), last))
    return [
        (pattern, held & ~np.repeat(found[i + 1][1], FAN)[: len(held)] if i + 1 < len(found) else held, last)
        for i, (pattern, held, last) in enumerate(found)
    ]


def _tie(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each class after the classes of ``a`` and ``b`` are joined pair by pair."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return root
        np.minimum.at(root, high[apart], low[apart])
        while True:
            further = root[root]
            if (further == root).all():
                break
            root = further


def ties(codes: np.ndarray, mask: int, radius: int = RADIUS, searching: int | None = None) -> np.ndarray:
    """For each code the place of its class's first member, over pairs that agree in ``mask`` within the radius.

    ``codes`` are in Gray order. With ``searching``, the first so many are searched among the others, which are in
    Gray order on their own; without, each code is searched among those after it.
    """
    start, searches = (0, len(codes)) if searching is None else (searching, searching)
    index, root, mask = codes[start:], np.arange(len(codes)), _U64(mask)
    levels = _levels(index) if len(index) else []
    for low in range(0, searches if len(index) else 0, _SEARCHES):
        query = np.arange(low, min(low + _SEARCHES, searches))
        least = [root[start:]]
        most = least[:]
        for pattern, _, _ in levels[:-1]:
            starts = np.arange(0, len(pattern), FAN)
            least.append(np.minimum.reduceat(least[-1], starts))
            most.append(np.maximum.reduceat(most[-1], starts))
        top = len(levels[-1][0])
        node, query = np.tile(np.arange(top), len(query)), np.repeat(query, top)
        away = np.zeros(len(query), np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            pattern, held, last = levels[depth]
            differing = (codes[query] ^ pattern[node]) & held[node]
            away = away + np.bitwise_count(differing)
            tied = (least[depth][node] == root[query]) & (most[depth][node] == root[query])
            kept = (away <= radius) & ((differing & mask) == 0) & ~tied
            if searching is None:
                kept &= last[node] > query
            node, query, away = node[kept], query[kept], away[kept]
            if depth:
                below = (node[:, None] * FAN + np.arange(FAN)[None, :]).ravel()
                query, away = np.repeat(query, FAN), np.repeat(away, FAN)
                there = below < len(levels[depth - 1][0])
                node, query, away = below[there], query[there], away[there]
        root = _tie(root, query, node + start)
    return root


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: ties whose connected components are those of all pairs of fingerprints within the radius.

    ``prints`` holds distinct longs in its column ``fingerprint``. A tie joins two members of one component; it need
    not be a pair within the radius itself.
    """
    orders, leading = orders_for(prints.count(), radius)
    masks = [leading_mask(o, leading) for o in orders]

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            codes = column.to_numpy(zero_copy_only=False).astype(np.int64).view(_U64)
            for number, order in enumerate(orders):
                # Spark sorts signed numbers: turning the top bit keeps the unsigned order.
                rank = gray_rank(codes, order) ^ _U64(1 << 63)
                columns = [pa.array(np.full(len(codes), number, np.int32)), pa.array(rank.view(np.int64)), column]
                yield pa.RecordBatch.from_arrays(columns, ["sorting", "rank", "fingerprint"])

    rows = prints.select("fingerprint").mapInArrow(ranked, "sorting int, rank long, fingerprint long")
    rows = global_row_number(rows, "place", [F.col("sorting"), F.col("rank")])
    block = F.floor((F.col("place") - 1) / BLOCK_ROWS)
    lead = F.shiftrightunsigned("rank", BITS - leading)
    rows = rows.select("place", block.alias("block"), "sorting", lead.alias("lead"), "rank", "fingerprint")

    # Leading bits that run on from one block into the next: at most one for each block.
    first = rows.where((F.col("place") - 1) % BLOCK_ROWS == 0).select("sorting", "lead", F.col("block"))
    last = rows.where(F.col("place") % BLOCK_ROWS == 0).select("sorting", "lead", (F.col("block") + 1).alias("block"))
    running = first.join(last, ["sorting", "lead", "block"]).select("sorting", "lead").distinct()
    crossing = materialize(rows.join(running, ["sorting", "lead"]), "crossing")
    nodes = crossing.groupBy("sorting", "lead", "block").agg(F.bit_and("fingerprint").alias("both"), F.bit_or("fingerprint").alias("either"))
    held = F.bitwise_not(F.col("both").bitwiseXOR(F.col("either")))
    nodes = nodes.select("sorting", "lead", "block", "both", held.alias("held"))
    other = nodes.select("sorting", "lead", *[F.col(c).alias(f"{c}_2") for c in ("block", "both", "held")])
    apart = F.col("both").bitwiseXOR(F.col("both_2")).bitwiseAND(F.col("held")).bitwiseAND(F.col("held_2"))
    pairs = nodes.join(other, ["sorting", "lead"]).where((F.col("block") < F.col("block_2")) & (F.bit_count(apart) <= radius))
    pairs = materialize(pairs.select("sorting", "lead", "block", "block_2"), "blocks")

    columns = ["block", "block_2", "side", "sorting", "rank", "fingerprint"]
    work = rows.withColumn("block_2", F.col("block")).withColumn("side", F.lit(0)).select(columns)
    for side, own in ((0, "block"), (1, "block_2")):
        part = crossing.withColumnRenamed("block", "own").join(pairs.withColumn("own", F.col(own)), ["sorting", "lead", "own"])
        work = work.unionByName(part.withColumn("side", F.lit(side)).select(columns))

    def tied(group: pa.Table) -> pa.Table:
        side, sorting, rank, codes = (group.column(c).to_numpy() for c in columns[2:])
        found = []
        for number in np.unique(sorting):
            chosen = np.flatnonzero(sorting == number)
            chosen = chosen[np.lexsort((rank[chosen], side[chosen]))]
            own = codes[chosen].astype(np.int64).view(_U64)
            searching = int((side[chosen] == 0).sum())
            root = ties(own, masks[number], radius, searching if searching < len(own) else None)
            moved = np.flatnonzero(root != np.arange(len(root)))
            found.append(np.stack([own[moved].view(np.int64), own[root[moved]].view(np.int64)], axis=1))
        both = np.concatenate(found)
        return pa.table({"a": pa.array(both[:, 0]), "b": pa.array(both[:, 1])})

    return work.groupBy("block", "block_2").applyInArrow(tied, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``key, fingerprint, component_id`` of every row: the smallest id reachable over fingerprints within the radius.

    ``fingerprint`` is a signed long. Rows are the nodes, so rows that repeat an id with other texts each have their
    own class. Null, empty and blank texts have fingerprint zero and are linked like any other. A null id never names
    a class; it is null only where no member has an id. Other columns are not read; an empty table gives no rows.
    """
    apply_defaults(docs.sparkSession)
    marked = materialize(fingerprinted(docs, key, text).withColumnRenamed(key, "_key"), "marked")
    own = materialize(marked.groupBy("fingerprint").agg(F.min("_key").alias("_least")), "prints")
    nodes = connected_components(links(own, radius)).withColumnRenamed("node", "fingerprint")
    named = own.join(nodes, "fingerprint", "left").withColumn("_root", F.coalesce("component", "fingerprint"))
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = join_to_grouped(named, least, "_root").select("fingerprint", "component_id")
    found = join_to_grouped(marked, named, "fingerprint")
    return found.select(F.col("_key").alias(key), "fingerprint", "component_id")
