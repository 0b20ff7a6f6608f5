"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text is cut before each space; a space belongs to the word after it, and the text begins with one that decoding takes
off again. Pieces of the vocabulary with a space elsewhere than at their start are left out, so no piece goes over a
cut and the piece lattice of a text is the product of the lattices of its words. For each distinct word forward
filtering gives, at every place, the probability of each piece that may end there. Backward sampling then walks all
occurrences of all words of a batch at once, each with random numbers from the row's key, the word's place in the text
and the step. Characters without a piece, and U+2581 itself, which stands for the space in the vocabulary, are spelled
by byte pieces; so every text comes back exactly.

The vocabulary stores merge ranks, not log probabilities; a piece's weight is (rank + offset) ** -alpha.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.llm.words import mix64, seeded

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
RANK_OFFSET = 10.0
SPACE = "▁"

_U64 = np.uint64
# Characters whose lattices are held at a time; pieces do not depend on it.
_CHUNK_CHARS = 1 << 18
_CHUNK_ROWS = 256
_SPELLED = 1 << 24
_NO_CHARACTER = 0x7FFFFF
_SPELLED_WEIGHT = -14.0


@dataclass
class PieceModel:
    """What tasks need of a vocabulary: its beginnings as a trie in an open hash table, and what the pieces spell."""

    keys: np.ndarray  # state and character of each transition, 0 in empty slots
    targets: np.ndarray
    probes: int
    piece: np.ndarray  # piece that ends in each state, or -1
    log_weight: np.ndarray
    byte_ids: np.ndarray
    blob: np.ndarray  # bytes of all pieces, one after the other, the space as such
    starts: np.ndarray

    def step(self, states: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The state after each character, or -1."""
        keys = _transition(states, characters)
        slots = (mix64(keys) & _U64(len(self.keys) - 1)).astype(np.int64)
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for _ in range(self.probes):
            found = self.keys[slots[left]]
            hit = found == keys[left]
            out[left[hit]] = self.targets[slots[left[hit]]]
            left = left[~hit & (found != 0)]
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)
        return out


def _transition(states: np.ndarray, characters: np.ndarray) -> np.ndarray:
    return (states.astype(_U64) << _U64(24)) | (characters.astype(_U64) + _U64(1))


def load_model(path: str = MODEL_PATH, alpha: float = ALPHA) -> PieceModel:
    """Read a SentencePiece model file on the driver; its pieces are shipped with the tasks."""
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=path)
    states: dict[str, int] = {"": 0}
    ends: dict[str, tuple[int, float]] = {}
    byte_ids, spelled = np.zeros(256, np.int32), []
    for number in range(processor.get_piece_size()):
        piece = processor.id_to_piece(number)
        if processor.is_byte(number):
            byte_ids[int(piece[3:5], 16)] = number
            spelled.append(bytes([int(piece[3:5], 16)]))
            continue
        if processor.is_control(number) or processor.is_unknown(number) or processor.is_unused(number):
            spelled.append(b"")
            continue
        spelled.append(piece.replace(SPACE, " ").encode())
        if SPACE not in piece[1:]:
            ends[piece] = (number, -alpha * np.log(max(0.0, -processor.get_score(number)) + RANK_OFFSET))
            for end in range(1, len(piece) + 1):
                states.setdefault(piece[:end], len(states))
    keys = np.zeros(1 << int(np.ceil(np.log2(4 * len(states)))), _U64)
    targets, probes = np.zeros(len(keys), np.int32), 1
    for beginning, state in states.items():
        if beginning:
            key = _transition(np.array([states[beginning[:-1]]]), np.array([ord(beginning[-1])]))
            slot, tries = int(mix64(key)[0] & _U64(len(keys) - 1)), 1
            while keys[slot]:
                slot, tries = (slot + 1) & (len(keys) - 1), tries + 1
            keys[slot], targets[slot], probes = key[0], state, max(probes, tries)
    piece, weight = np.full(len(states), -1, np.int32), np.zeros(len(states))
    for text, (number, log_weight) in ends.items():
        piece[states[text]], weight[states[text]] = number, log_weight
    lengths = np.array([len(s) for s in spelled])
    return PieceModel(keys, targets, probes, piece, weight, byte_ids, np.frombuffer(b"".join(spelled), np.uint8), np.r_[0, np.cumsum(lengths)])


@dataclass
class _Lattice:
    """The filtered lattices of some words, edges grouped by the node they end in."""

    last: np.ndarray  # the node where each word ends
    begins: np.ndarray  # whether a word begins at a node
    first_edge: np.ndarray
    reach: np.ndarray  # running probability within a node's edges
    before: np.ndarray
    piece: np.ndarray  # piece id, or _SPELLED + code point for a character spelled in bytes


def _filtered(words: list[str], model: PieceModel) -> _Lattice:
    """Forward filtering of all words at once, one place in the words at a time."""
    sizes = np.array([len(w) + 1 for w in words])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    codes = np.frombuffer("".join([SPACE + w for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    looked_up = np.where(codes == ord(SPACE), _NO_CHARACTER, codes)
    looked_up[begins] = ord(SPACE)
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes))
    limit = ends[word]
    start, stop, piece, weight = [], [], [], []
    active, state, length = place, np.zeros(len(codes), np.int64), 0
    single = np.zeros(len(codes), bool)
    while len(active):
        inside = active + length < limit[active]
        active, state = active[inside], state[inside]
        state = model.step(state, looked_up[active + length])
        active, state = active[state >= 0], state[state >= 0]
        length += 1
        is_piece = model.piece[state] >= 0
        at = active[is_piece]
        if length == 1:
            single[at] = True
        start.append(at)
        stop.append(at + length)
        piece.append(model.piece[state[is_piece]].astype(np.int64))
        weight.append(model.log_weight[state[is_piece]])
    bare = np.flatnonzero(~single)
    start.append(bare)
    stop.append(bare + 1)
    piece.append(_SPELLED + codes[bare])
    weight.append(np.full(len(bare), _SPELLED_WEIGHT))
    start, stop, piece, weight = (np.concatenate(x) for x in (start, stop, piece, weight))
    # A word of n characters has n + 1 nodes; the node before character i is i + the number of the word.
    base = word[start]
    depth = stop - begins[base]
    order = np.lexsort((stop, depth))
    node_from, node_to, depth = (start + base)[order], (stop + base)[order], depth[order]
    piece, weight = piece[order], weight[order]
    groups = np.flatnonzero(np.r_[True, node_to[1:] != node_to[:-1]])
    group_of = np.repeat(np.arange(len(groups)), np.diff(np.r_[groups, len(node_to)]))
    chance = np.zeros(len(codes) + len(words))
    share = np.zeros(len(node_to))
    steps = np.searchsorted(depth, np.arange(1, int(depth[-1]) + 2))
    for low, high in zip(steps[:-1], steps[1:], strict=True):
        own = groups[group_of[low] : group_of[high - 1] + 1]
        value = chance[node_from[low:high]] + weight[low:high]
        most = np.maximum.reduceat(value, own - low)
        local = group_of[low:high] - group_of[low]
        part = np.exp(value - most[local])
        total = np.add.reduceat(part, own - low)
        chance[node_to[own]] = most + np.log(total)
        share[low:high] = part / total[local]
    reach = np.cumsum(share)
    reach -= (reach - share)[groups][group_of]
    reach[np.r_[groups[1:], len(node_to)] - 1] = 2.0  # rounding never leads past the last edge
    first_edge = np.zeros(len(chance), np.int64)
    first_edge[node_to[groups]] = groups
    first_node = np.zeros(len(chance), bool)
    first_node[begins + np.arange(len(words))] = True
    return _Lattice(ends + np.arange(len(words)), first_node, first_edge, reach, node_from, piece)


def _sampled(words: list[str], state: np.ndarray, model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all words in order and the number of pieces of each, from one random state per word."""
    numbers: dict[str, int] = {}
    which = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lattice = _filtered(list(numbers), model)
    node, active, rounds = lattice.last[which], np.arange(len(words)), []
    sizes = np.zeros(len(words), np.int64)
    with np.errstate(over="ignore"):
        while len(active):
            state = mix64(state + _U64(0x9E3779B97F4A7C15))
            drawn = (state >> _U64(11)).astype(np.float64) / 9007199254740992.0
            edge = lattice.first_edge[node]
            open_ = np.flatnonzero(lattice.reach[edge] <= drawn)
            while len(open_):
                edge[open_] += 1
                open_ = open_[lattice.reach[edge[open_]] <= drawn[open_]]
            rounds.append((active, lattice.piece[edge]))
            sizes[active] += 1
            node = lattice.before[edge]
            going = np.flatnonzero(~lattice.begins[node])
            active, node, state = active[going], node[going], state[going]
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]), np.int64)
    for step, (occurrence, ids) in enumerate(rounds, 1):
        out[ends[occurrence] - step] = ids
    spelled = np.flatnonzero(out >= _SPELLED)
    if not len(spelled):
        return out.astype(np.int32), sizes
    bytes_ = [chr(c - _SPELLED).encode("utf-8", "surrogatepass") for c in out[spelled].tolist()]
    each = np.ones(len(out), np.int64)
    each[spelled] = [len(b) for b in bytes_]
    after = np.cumsum(each)
    full = np.repeat(out, each)
    place = np.concatenate([np.arange(e - len(b), e) for e, b in zip(after[spelled], bytes_, strict=True)])
    full[place] = model.byte_ids[np.frombuffer(b"".join(bytes_), np.uint8)]
    return full.astype(np.int32), np.diff(np.r_[0, after[ends - 1]])


def _cut(text: str) -> Iterator[str]:
    """Parts of a very long text, cut at spaces, which are taken out."""
    begin = 0
    while begin < len(text) - _CHUNK_CHARS:
        end = text.find(" ", begin + _CHUNK_CHARS)
        if end < 0:
            break
        yield text[begin:end]
        begin = end + 1
    yield text[begin:]


def _encoded(texts: list[str], keys: np.ndarray, model: PieceModel) -> Iterator[np.ndarray]:
    """Piece ids of each text; texts go through together, about ``_CHUNK_CHARS`` characters at a time."""
    row, rows = 0, len(texts)
    while row < rows:
        stop, chars = row, 0
        while stop < rows and (stop == row or chars + len(texts[stop]) <= _CHUNK_CHARS):
            chars += len(texts[stop])
            stop += 1
        parts = [(r, part) for r in range(row, stop) for part in _cut(texts[r])]
        ids: dict[int, list[np.ndarray]] = {r: [] for r in range(row, stop)}
        place = 0
        for group in [parts] if stop - row > 1 else [[p] for p in parts]:
            split = [part.split(" ") for _, part in group]
            counts = np.array([len(s) for s in split])
            begins = np.cumsum(counts) - counts
            place_in_text = np.arange(counts.sum()) - np.repeat(begins, counts) + place
            with np.errstate(over="ignore"):
                state = mix64(np.repeat(keys[[r for r, _ in group]], counts) + mix64(place_in_text.astype(_U64)))
            found, sizes = _sampled([w for s in split for w in s], state, model)
            ends = np.r_[0, np.cumsum(sizes)][np.r_[begins, counts.sum()]]
            for (r, _), low, high in zip(group, ends[:-1], ends[1:], strict=True):
                ids[r].append(found[low:high])
            place += int(counts.sum())
        for r in range(row, stop):
            yield np.concatenate(ids[r]) if len(ids[r]) > 1 else ids[r][0]
        row = stop


def _decoded(ids: np.ndarray, model: PieceModel) -> bytes:
    """The bytes that the pieces spell, without the space that encoding put first."""
    starts = model.starts[ids]
    sizes = model.starts[ids + 1] - starts
    ends = np.cumsum(sizes)
    place = np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    return model.blob[place].tobytes()[1:]


def _lists(values: list[np.ndarray], there: list[bool]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = pa.array(np.concatenate(values) if values else np.zeros(0, np.int32))
    return pa.ListArray.from_arrays(pa.array(offsets, mask=np.array([*[not t for t in there], False])), flat)


def encode(docs: DataFrame, text_col: str = "text", key: str | Column = "doc_id", seed: int = 1, model: PieceModel | None = None) -> DataFrame:
    """``docs`` plus ``piece_ids``, ``n_pieces`` and ``lossless`` (the pieces spell the very text); same rows, no shuffle.

    Equal keys, texts and seeds give equal segmentations on any cluster. A null text has null ids, no pieces and a null
    ``lossless``; an empty one has the one piece of the first space. A null key counts as a key of its own; columns
    named like the new ones are replaced, others are passed on.
    """
    model = model or load_model()
    docs = docs.drop("piece_ids", "n_pieces", "lossless")
    names = docs.columns
    keyed = docs.withColumn("__key", F.xxhash64(F.col(key) if isinstance(key, str) else key, F.lit(seed)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_col)
            keys = mix64(batch.column("__key").to_numpy(zero_copy_only=False).view(_U64) ^ seeded(41, 1)[0])
            for low in range(0, batch.num_rows, _CHUNK_ROWS):
                texts = column.slice(low, _CHUNK_ROWS).to_pylist()
                there = [t is not None for t in texts]
                ids = list(_encoded([t or "" for t in texts], keys[low : low + _CHUNK_ROWS], model))
                lossless = [_decoded(i, model) == t.encode() if t is not None else None for i, t in zip(ids, texts, strict=True)]
                ids = [i if t else i[:0] for i, t in zip(ids, there, strict=True)]
                part = batch.slice(low, _CHUNK_ROWS)
                columns = [part.column(name) for name in names]
                columns += [_lists(ids, there), pa.array([len(i) for i in ids], pa.int64()), pa.array(lossless, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "piece_ids", "n_pieces", "lossless"])

    new = T.StructType.fromDDL("piece_ids array<int>, n_pieces long, lossless boolean")
    return keyed.mapInArrow(run, T.StructType([*docs.schema.fields, *new.fields]))


def decode(encoded: DataFrame, ids_col: str = "piece_ids", text_col: str = "text", model: PieceModel | None = None) -> DataFrame:
    """``encoded`` with ``text_col`` set to the text that ``ids_col`` spells; null ids give a null text."""
    model = model or load_model()
    kept = [c for c in encoded.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_col)
            texts = [_decoded(np.asarray(x.values), model).decode("utf-8", "replace") if x.is_valid else None for x in lists]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(texts, pa.string())], [*kept, text_col])

    fields = [f for f in encoded.schema.fields if f.name != text_col]
    return encoded.mapInArrow(run, T.StructType([*fields, T.StructField(text_col, T.StringType())]))
