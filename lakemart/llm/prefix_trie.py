"""Prefix trie of conversations: a z-fast trie kept in tables.

Paths: a turn is a symbol, the digest of its role and text. The prefix of depth d has a 128-bit hash, the exclusive or
of one hash for each (depth, symbol) up to d, so running hashes of one very long conversation are built in pieces.

Trie: a compacted node is a place where a conversation ends or paths part. It owns the edge (a, b] from its parent's
depth to its own and is found by its handle, the hash of its prefix at the two-fattest depth of that interval, the one
divisible by the highest power of two. Conversations come in batches. Each searches the handles by fat binary search:
the two-fattest depth of what is left of its length is looked up, a hit goes on below the node found, a miss above the
depth tried. That takes as many joins as a length has bits. What is found is checked against the node's own hash, and the
edge on which the conversation leaves the trie is compared to the place where they part. All cuts of an edge and all new
branches of a batch are then made at once.

Result: sums over subtrees run up the compacted nodes by pointer doubling, and edges are expanded to one row for each depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.operators.keys import join_to_grouped
from lakemart.operators.ranking import global_row_number
from lakemart.session import apply_defaults, materialize

# Upper ends of the batches, in sixteenths of the conversations: each inserts into a trie that holds a fair part already.
BATCHES = (4, 16)
# Turns of one conversation whose running hash one group of a window makes.
PIECE_TURNS = 256
# Conversation ids that are joined to one text before an ends' digest reads them.
IDS_AT_ONCE = 1024


def _root() -> Column:
    """Hash of the empty prefix."""
    return F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))


def symbols(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, symbol, words`` of every turn; ``place`` counts a conversation's turns from 1.

    Turns are ordered by number, null first, then by role and symbol. Null roles and texts count as empty; rows without a
    conversation are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("symbol"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"),  # spreads equal rows over the sort's ranges
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("symbol"), F.col("tie")]
    numbered = global_row_number(turns, "n", order).select("conv_id", "n", "symbol", "words")
    first = numbered.groupBy("conv_id").agg(F.min("n").alias("first"))
    placed = join_to_grouped(numbered, first, "conv_id")
    return placed.select("conv_id", (F.col("n") - F.col("first") + 1).alias("place"), "symbol", "words")


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, p, q, words, upto`` of ``conv_id, depth, symbol, words``: hash of the prefix and of the one
    before it, and the words of the prefix."""
    term = F.struct(F.xxhash64(F.lit(1), "depth", "symbol").alias("x"), F.xxhash64(F.lit(2), "depth", "symbol").alias("y"))
    rows = turns.select("conv_id", "depth", "words", term.alias("t"), F.floor((F.col("depth") - 1) / PIECE_TURNS).alias("piece"))
    rows = materialize(rows, "turns")
    within = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"x": F.bit_xor("t.x"), "y": F.bit_xor("t.y"), "w": F.sum("words")}
    # Only conversations that fill several pieces have a row here.
    pieces = rows.join(rows.where("piece > 0").select("conv_id").distinct(), "conv_id", "left_semi")
    pieces = pieces.groupBy("conv_id", "piece").agg(*[c.alias(n) for n, c in sums.items()])
    over = {"x": F.bit_xor("x").over(earlier), "y": F.bit_xor("y").over(earlier), "w": F.sum("w").over(earlier)}
    before = pieces.select("conv_id", "piece", *[c.alias(f"before_{n}") for n, c in over.items()])
    here = rows.select("conv_id", "depth", "piece", "words", "t", *[c.over(within).alias(n) for n, c in sums.items()])
    found = here.join(before, ["conv_id", "piece"], "left")

    def whole(name: str) -> Column:
        return F.col(name).bitwiseXOR(F.coalesce(f"before_{name}", F.lit(0)))

    p = F.struct(whole("x").alias("x"), whole("y").alias("y"))
    q = F.struct(whole("x").bitwiseXOR(F.col("t.x")).alias("x"), whole("y").bitwiseXOR(F.col("t.y")).alias("y"))
    upto = F.col("w") + F.coalesce("before_w", F.lit(0))
    return found.select("conv_id", "depth", p.alias("p"), q.alias("q"), "words", upto.alias("upto"))


def _two_fattest(low: str, high: str) -> Column:
    """The depth in (low, high] that the highest power of two divides."""
    return F.expr(f"{high} & shiftleft(-1L, length(bin({low} ^ {high})) - 1)")


def _dictionary(nodes: DataFrame, path: DataFrame) -> DataFrame:
    """Nodes ``k, a, b, rep`` with the hash at their handle, the hash of their edge's first depth, their parent's hash, and
    the words of the parent's prefix and of their edge."""
    wanted = F.array(
        F.struct(F.lit("handle").alias("what"), _two_fattest("a", "b").alias("depth")),
        F.struct(F.lit("first").alias("what"), (F.col("a") + 1).alias("depth")),
        F.struct(F.lit("last").alias("what"), F.col("b").alias("depth")),
    )
    looked = nodes.select("k", "a", "b", F.col("rep").alias("conv_id"), F.explode(wanted).alias("w"))
    looked = looked.select("k", "a", "b", "conv_id", "w.what", "w.depth").join(path, ["conv_id", "depth"])

    def found(what: str, column: Column) -> Column:
        return F.max(F.when(F.col("what") == what, column))

    before = found("first", F.col("upto") - F.col("words"))
    return looked.groupBy("k", "a", "b", F.col("conv_id").alias("rep")).agg(
        found("handle", F.col("p")).alias("handle"),
        found("first", F.col("p")).alias("first"),
        found("first", F.col("q")).alias("parent"),
        before.alias("before"),
        (found("last", F.col("upto")) - before).alias("edge_words"),
    )


def _searched(lengths: DataFrame, path: DataFrame, known: DataFrame) -> DataFrame:
    """``conv_id, length, tried, k, b``: the node a fat binary search over handles ends with, or the root.

    ``tried`` is the depth at which the node's handle was met; the conversation agrees with it at least that far.
    """
    handles = known.select(F.col("handle").alias("p"), F.col("k").alias("hit"), F.col("b").alias("hit_b"))
    state = lengths.select(
        "conv_id", "length", F.lit(0).cast("long").alias("low"), F.col("length").alias("high"),
        F.lit(0).cast("long").alias("tried"), _root().alias("k"), F.lit(0).cast("long").alias("b"),
    )
    done = []
    while True:
        active = state.where("low < high")
        done.append(state.where("low >= high"))
        if active.isEmpty():
            break
        asked = active.withColumn("depth", _two_fattest("low", "high")).join(path.select("conv_id", "depth", "p"), ["conv_id", "depth"])
        met = asked.join(handles, "p", "left").withColumn("is_hit", F.col("hit").isNotNull())
        state = materialize(
            met.select(
                "conv_id", "length",
                F.when(F.col("is_hit"), F.col("hit_b")).otherwise(F.col("low")).alias("low"),
                F.when(F.col("is_hit"), F.col("high")).otherwise(F.col("depth") - 1).alias("high"),
                F.when(F.col("is_hit"), F.col("depth")).otherwise(F.col("tried")).alias("tried"),
                F.when(F.col("is_hit"), F.col("hit")).otherwise(F.col("k")).alias("k"),
                F.when(F.col("is_hit"), F.col("hit_b")).otherwise(F.col("b")).alias("b"),
            ),
            "searching",
        )
    return reduce(DataFrame.unionByName, done).select("conv_id", "length", "tried", "k", "b")


def _exits(lengths: DataFrame, path: DataFrame, known: DataFrame) -> DataFrame:
    """``conv_id, length, depth, k, a, b, rep``: how far each conversation agrees with the trie, and the edge it leaves on.

    The edge is null where it leaves at a node or ends there.
    """
    found = materialize(_searched(lengths, path, known), "searched")
    own = path.select("conv_id", F.col("depth").alias("b"), F.col("p").alias("own"))
    checked = found.join(own, ["conv_id", "b"], "left").withColumn("whole", (F.col("b") == 0) | F.coalesce(F.col("own") == F.col("k"), F.lit(False)))
    edges = known.select("k", "a", "b", "rep", "first")
    inside = checked.where("not whole").select("conv_id", "length", "tried", "k").join(edges.drop("first"), "k")
    below = checked.where("whole").select("conv_id", "length", F.col("b").alias("tried"), (F.col("b") + 1).alias("depth"))
    below = below.join(path.select("conv_id", "depth", F.col("p").alias("first")), ["conv_id", "depth"], "left").drop("depth")
    below = below.join(edges, "first", "left").drop("first")
    at = materialize(inside.unionByName(below), "edges")
    # Along the edge the conversation is compared with the edge's representative.
    walked = at.where("k is not null").select("conv_id", "rep", "tried", F.least("length", "b").alias("most"))
    walked = walked.join(path.select("conv_id", "depth", "p"), "conv_id").where("depth > tried and depth <= most")
    edge = path.select(F.col("conv_id").alias("rep"), "depth", "p")
    agreed = walked.join(edge, ["rep", "depth", "p"]).groupBy("conv_id").agg(F.max("depth").alias("agreed"))
    found = at.join(agreed, "conv_id", "left").withColumn("depth", F.coalesce("agreed", "tried"))
    return found.select("conv_id", "length", "depth", "k", "a", "b", "rep")


def _inserted(nodes: DataFrame | None, lengths: DataFrame, path: DataFrame) -> DataFrame:
    """Nodes ``k, a, b, rep`` of the trie after a batch of conversations."""
    if nodes is None:
        exits = lengths.select("conv_id", "length", F.lit(0).cast("long").alias("depth"))
        kept = None
    else:
        known = materialize(_dictionary(nodes, path), "handles")
        exits = materialize(_exits(lengths, path, known), "exits")
        cuts = exits.where("depth > a and depth < b").select("k", F.col("depth").alias("cut")).distinct()
        cuts = nodes.join(cuts, "k")
        by_depth = Window.partitionBy("k").orderBy("cut")
        ends = cuts.union(cuts.select("k", "a", "b", "rep", F.col("b").alias("cut")).distinct())
        pieces = ends.withColumn("a", F.coalesce(F.lag("cut").over(by_depth), "a")).select("a", F.col("cut").alias("b"), "rep")
        pieces = pieces.join(path.select(F.col("conv_id").alias("rep"), F.col("depth").alias("b"), F.col("p").alias("k")), ["rep", "b"])
        whole = nodes.join(cuts.select("k").distinct(), "k", "left_anti")
        kept = whole.unionByName(pieces)

    tails = path.join(exits.select("conv_id", "length", F.col("depth").alias("left_at")), "conv_id").where("depth > left_at")
    tails = materialize(tails.select("conv_id", "depth", "p", "q", "left_at", (F.col("depth") == F.col("length")).alias("ends")), "tails")
    new = tails.groupBy("p").agg(F.min("q").alias("q"), F.min("conv_id").alias("rep"), F.max("ends").alias("ends"))
    children = new.groupBy(F.col("q").alias("p")).agg(F.count(F.lit(1)).alias("children"))
    explicit = new.join(children, "p", "left").where("ends or children > 1").select("p", "rep")
    marked = tails.select("conv_id", "depth", "p", "left_at").join(explicit, "p")
    above = F.lag("depth").over(Window.partitionBy("conv_id").orderBy("depth"))
    marked = marked.withColumn("a", F.coalesce(above, "left_at")).where("conv_id = rep")
    grown = marked.select(F.col("p").alias("k"), "a", F.col("depth").alias("b"), "rep")
    return materialize(grown if kept is None else kept.unionByName(grown), "nodes")


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """Adds to each node's ``n, least, leaves, total, distinct_words`` those of all nodes below it, by pointer doubling.

    After i rounds a node holds its descendants less than 2 ** i steps away and points 2 ** i steps up.
    """
    sums = ["n", "leaves", "total", "distinct_words"]
    state = nodes.withColumn("up", F.col("parent"))
    while not (rising := state.where("up is not null")).isEmpty():
        given = rising.groupBy(F.col("up").alias("k")).agg(*[F.sum(c).alias(f"{c}_2") for c in sums], F.min("least").alias("least_2"))
        further = state.select(F.col("k").alias("up"), F.col("up").alias("next")).where("next is not null")
        added = [(F.col(c) + F.coalesce(f"{c}_2", F.lit(0))).alias(c) for c in sums]
        kept = [c for c in state.columns if c not in (*sums, "least", "up")]
        taken = state.join(given, "k", "left").select(*kept, *added, F.least("least", "least_2").alias("least"), "up")
        state = materialize(taken.join(further, "up", "left").drop("up").withColumnRenamed("next", "up"), "sums")
    return state.drop("up")


def _ends(ends: DataFrame) -> DataFrame:
    """``k, sha256`` of ``conv_id, k``: digest of the ids that end at a node, ascending and comma-joined.

    Ids are joined in pieces of bounded length wherever they lie; the digest reads a node's pieces one after the other,
    as a stream.
    """
    numbered = global_row_number(ends, "n", [F.col("k"), F.col("conv_id")])
    piece = F.floor((F.col("n") - 1) / IDS_AT_ONCE)
    joined = numbered.groupBy("k", piece.alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = joined.select("k.x", "k.y", "piece", F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            found = []
            for x, y, ids in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "ids")), strict=True):
                if (x, y) != key:
                    if key is not None:
                        found.append((*key, digest.hexdigest()))
                    key, digest = (x, y), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield _digests(found)
        if key is not None:
            yield _digests([(*key, digest.hexdigest())])

    sorted_ids = joined.repartition("x", "y").sortWithinPartitions("x", "y", "piece")
    found = sorted_ids.mapInArrow(hashed, "x long, y long, sha256 string")
    return found.select(F.struct("x", "y").alias("k"), "sha256")


def _digests(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = {"x": pa.int64(), "y": pa.int64(), "sha256": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds.values())], list(kinds))


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """All nodes of the trie over ``turns`` (``conv_id, depth, symbol, words``), one row for each distinct prefix.

    ``members`` (``conv_id, length``) names every conversation once, those without turns too. Columns as in
    ``prefix_trie``. No members give no rows.
    """
    path = materialize(paths(turns), "paths")
    members = materialize(members.withColumn("batch", F.pmod(F.xxhash64("conv_id"), F.lit(16))), "members")
    nodes, low = None, 0
    for high in BATCHES:
        nodes = _inserted(nodes, members.where((F.col("batch") >= low) & (F.col("batch") < high) & (F.col("length") > 0)), path)
        low = high
    known = _dictionary(nodes, path)

    last = path.select("conv_id", F.col("depth").alias("length"), "p", "upto")
    ends = members.join(last, ["conv_id", "length"], "left")
    ends = ends.select("conv_id", F.coalesce("p", _root()).alias("k"), F.coalesce("upto", F.lit(0)).alias("upto"))
    ends = materialize(ends, "ends")
    own = ends.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.sum("upto").alias("total"))
    none = F.lit(None)
    root = F.struct(
        _root().alias("k"), F.lit(-1).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), none.cast("long").alias("rep"),
        none.cast("struct<x: bigint, y: bigint>").alias("parent"), F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("edge_words"),
    )
    # The root stands even where no conversation has a turn.
    whole = known.select("k", "a", "b", "rep", "parent", "before", "edge_words").unionByName(
        members.agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(root.alias("r")).select("r.*")
    )
    whole = materialize(whole, "trie")
    children = whole.where("parent is not null").groupBy(F.col("parent").alias("k")).agg(F.count(F.lit(1)).alias("children"))
    counted = whole.join(own, "k", "left").join(children, "k", "left").select(
        "k", "a", "b", "rep", "parent", "before",
        F.coalesce("children", F.lit(0)).cast("long").alias("children"), F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        F.coalesce("n", F.lit(0)).alias("n"), "least", F.coalesce("total", F.lit(0)).alias("total"), F.col("edge_words").alias("distinct_words"),
    )
    summed = _subtree_sums(materialize(counted, "counted"))
    summed = summed.join(summed.select(F.col("k").alias("parent"), F.col("least").alias("parent_least")), "parent", "left")
    summed = materialize(summed.join(_ends(ends.select("conv_id", "k")), "k", "left"), "summed")

    # Edges in pieces, so that one very long edge is no single row's list.
    pieces = F.explode(F.sequence(F.floor(F.col("a") / PIECE_TURNS), F.floor((F.col("b") - 1) / PIECE_TURNS)))
    edges = summed.where("rep is not null").withColumn("piece", pieces)
    low, high = F.greatest("a", F.col("piece") * PIECE_TURNS) + 1, F.least("b", (F.col("piece") + 1) * PIECE_TURNS)
    edges = edges.withColumn("depth", F.explode(F.sequence(low, high))).withColumnRenamed("rep", "conv_id")
    places = path.select("conv_id", "depth", (F.col("upto") - F.col("words")).alias("earlier"))
    expanded = edges.join(places, ["conv_id", "depth"]).drop("conv_id", "piece")
    top = summed.where("rep is null").withColumn("depth", F.lit(0).cast("long")).withColumn("earlier", F.lit(0).cast("long"))
    expanded = expanded.unionByName(top.select(expanded.columns))
    saved = F.col("total") - F.col("n") * F.col("earlier") - F.col("distinct_words") + F.col("earlier") - F.col("before")
    is_end = F.col("depth") == F.col("b")
    return expanded.select(
        F.col("least").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == F.col("a") + 1, F.col("parent_least")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(is_end, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce(F.when(is_end, F.col("sha256")), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Trie of whole conversations ``conv_id, turn, role, text``; one row for each distinct sequence of first turns.

    ``conv_id`` is the smallest conversation that begins with the sequence, ``depth`` its length, ``parent_conv_id`` that
    of the sequence one turn shorter (null for the root), ``n_convs`` the conversations that begin with it,
    ``n_children`` the sequences one turn longer, ``n_leaves`` the longest sequences below it, ``saved_tokens`` the words
    that sharing saves in it and below, ``ends_sha256`` the digest of the ids of the conversations that end there.

    Null roles and texts count as empty, null turns come first, turns of one number follow by role and digest. Rows without
    ``conv_id`` are left out, repeated rows are repeated turns. Texts of any length are read whole, only their digests
    travel; two different prefixes share a row with a chance of 2 ** -128 for a pair. Other columns are not read; an
    empty table gives no rows.
    """
    apply_defaults(conversations.sparkSession)
    turns = materialize(symbols(conversations), "symbols").withColumnRenamed("place", "depth")
    return trie(turns, turns.groupBy("conv_id").agg(F.max("depth").alias("length")))


def regrafted(conversations: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns and members of conversations whose first turns are those of their family's first conversation.

    Conversation c takes the first h turns of c - c % ``family``, all if it has fewer and none if it is absent, with
    h = crc32 of the decimal c, modulo ``most``; its own turns after its first h follow. Nulls and ties as in
    ``prefix_trie``.
    """
    turns = materialize(symbols(conversations), "symbols")
    own = turns.groupBy("conv_id").agg(F.max("place").alias("turns"))
    own = own.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % most).withColumn("head", F.col("conv_id") - F.col("conv_id") % family)
    own = materialize(own, "members")
    heads = own.select(F.col("conv_id").alias("head"), F.col("turns").alias("head_turns"))
    own = own.join(heads, "head", "left").withColumn("taken", F.least("h", F.coalesce("head_turns", F.lit(0))))
    own = materialize(own.select("conv_id", "turns", "h", "head", "taken"), "grafts")
    first = turns.where((F.col("conv_id") % family == 0) & (F.col("place") < most)).withColumnRenamed("conv_id", "head")
    grafted = own.join(first, "head").where("place <= taken").select("conv_id", F.col("place").alias("depth"), "symbol", "words")
    kept = join_to_grouped(turns, own.select("conv_id", "h", "taken"), "conv_id").where("place > h")
    kept = kept.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "symbol", "words")
    length = F.col("taken") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))
    return grafted.unionByName(kept), own.select("conv_id", length.alias("length"))
