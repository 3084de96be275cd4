"""Sampled segmentations over the piece lattice of a public SentencePiece model, and lossless decoding.

Every segmentation of a text into pieces has a weight, the product of its pieces' weights. Forward filtering sums the
weights of all ways to reach a position; backward sampling then draws a segmentation with its exact probability. The
random numbers come from the row's key, so a row is always cut alike, wherever it runs.

No piece of the model has a space behind another character or touches a line break, so a text falls into chunks (spaces
and the word behind them) whose lattices are independent. A task builds the lattice of a chunk once and samples all
places where it stands at the same time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from logspark.llm.common import apart, slices

SPACE = "▁"
CHUNK = re.compile(r" *[^ \n]+| +|\n")
ROOT_PRIME = np.uint64(0x100000001B3)
# characters of the chunks whose lattices a task keeps: about 30 bytes each
HELD_CHARS = 2 << 20
INDEX_BITS = 20
# a lattice takes some hundred bytes a character while it is built
SLICE = 1 << 19
SEED = 11
# how sharply the better segmentations are preferred: 0 all alike, large: the best only
SHARPNESS = 1.0


@dataclass
class Vocabulary:
    """Pieces of a model as tables that numpy can search."""

    hashes: np.ndarray  # sorted hashes of all beginnings of pieces
    piece: np.ndarray  # the piece that ends there, or -1
    logs: np.ndarray  # by piece id
    byte_ids: np.ndarray  # piece id of each byte
    raw: list[bytes]  # bytes of each piece
    longest: int

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each hash stands among the sorted ones, and whether it does: by its leading bits, then a few steps."""
        if not hasattr(self, "index"):
            lead = (self.hashes >> np.uint64(64 - INDEX_BITS)).astype(np.int64)
            self.index = np.searchsorted(lead, np.arange(1 << INDEX_BITS)).astype(np.int32)
            self.fullest = int(np.bincount(lead).max())
            self.fenced = np.append(self.hashes, np.full(self.fullest + 1, ~np.uint64(0)))
        spot = self.index[(h >> np.uint64(64 - INDEX_BITS)).astype(np.int64)]
        for _ in range(self.fullest):
            spot = spot + (self.fenced[spot] < h)
        known = self.fenced[spot] == h
        return np.where(known, spot, 0), known


def load_vocabulary(path: str) -> Vocabulary:
    """Read a SentencePiece model with byte pieces.

    Its pieces have ranks, not probabilities; the weight of a piece falls with its rank as in Zipf's law.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(len(model))]
    byte_ids = np.full(256, -1, np.int64)
    raw: list[bytes] = []
    plain: dict[str, int] = {}
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
            raw.append(bytes([int(name[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            raw.append(b"")
        else:
            if SPACE in name.lstrip(SPACE) or "\n" in name:
                raise ValueError("a piece has a space behind another character, or a line break")
            plain[name.replace(SPACE, " ")] = i
            raw.append(name.replace(SPACE, " ").encode())
    if (byte_ids < 0).any():
        raise ValueError("the model has no piece for some byte")
    best = sorted(plain.values(), key=lambda i: (-model.get_score(i), i))
    logs = np.full(len(names), -np.log(2.0 * len(names)))
    logs[best] = -np.log(np.arange(len(best)) + 2.0)
    logs *= SHARPNESS
    starts: dict[int, int] = {}
    for name, i in plain.items():
        h = np.zeros(1, np.uint64)
        for k, c in enumerate(name):
            h = step(h, np.array([ord(c)], np.uint64))
            key = int(h[0])
            ends = i if k == len(name) - 1 else -1
            starts[key] = max(ends, starts.get(key, -1))
    keys = np.array(sorted(starts), np.uint64)
    return Vocabulary(keys, np.array([starts[int(k)] for k in keys], np.int64), logs, byte_ids, raw, max(map(len, plain)))


def step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    h = (h ^ (code + np.uint64(1))) * ROOT_PRIME
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Lattices:
    """Edges of the lattices of many chunks: ``first[node] … first[node + 1]`` end in a node; ``upto`` is cumulative."""

    def __init__(self, chunks: list[str], vocabulary: Vocabulary) -> None:
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        stops = np.cumsum(lengths)
        # chunk c has nodes for its positions 0 … length; nodes are counted over all chunks
        chunk = np.repeat(np.arange(len(chunks)), lengths)
        place = np.arange(len(codes))
        source, target, piece = [], [], []
        live, h = place, np.zeros(len(codes), np.uint64)
        covered = np.zeros(len(codes), bool)
        for length in range(1, vocabulary.longest + 1):
            h = step(h, codes[live + length - 1])
            spot, known = vocabulary.find(h)
            live, h, spot = live[known], h[known], spot[known]
            found = vocabulary.piece[spot]
            whole = found >= 0
            source.append(live[whole])
            target.append(live[whole] + length)
            piece.append(found[whole])
            if length == 1:
                covered[live[whole]] = True
            more = live + length < stops[chunk[live]]
            live, h = live[more], h[more]
            if not len(live):
                break
        # a character without a piece of its own can always be written in bytes: piece -1 - code
        bare = place[~covered]
        size = 1 + (codes[bare] > 0x7F) + (codes[bare] > 0x7FF) + (codes[bare] > 0xFFFF).astype(np.int64)
        source.append(bare)
        target.append(bare + 1)
        piece.append(-1 - codes[bare].astype(np.int64))
        byte_log = vocabulary.logs[vocabulary.byte_ids[0]]
        src, dst, ids = np.concatenate(source), np.concatenate(target), np.concatenate(piece)
        logs = np.where(ids >= 0, vocabulary.logs[np.maximum(ids, 0)], 0.0)
        logs[len(logs) - len(bare) :] = byte_log * size
        owner = chunk[src]
        src, dst = src + owner, dst + owner  # one more node than characters in each chunk
        order = np.argsort((dst << 8) | np.minimum(dst - src, 255))
        self.src, self.piece = src[order].astype(np.int32), ids[order].astype(np.int32)
        dst, logs, owner = dst[order], logs[order], owner[order]
        nodes = len(codes) + len(chunks)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(dst, minlength=nodes)))).astype(np.int32)
        self.starts = stops - lengths + np.arange(len(chunks))
        self.ends = stops + np.arange(len(chunks))
        self.upto = self.filtered(dst, logs, dst - self.starts[owner], nodes)

    def filtered(self, dst: np.ndarray, logs: np.ndarray, depth: np.ndarray, nodes: int) -> np.ndarray:
        """Forward filtering, all chunks at once by depth; gives each edge its cumulative share at the node it ends in."""
        alpha = np.zeros(nodes)
        share = np.zeros(len(dst))
        deepest = int(depth.max()) if len(depth) else 0
        by_depth = np.argsort(depth.astype(np.uint16) if deepest < 1 << 16 else depth, kind="stable")
        bounds = np.cumsum(np.bincount(depth, minlength=deepest + 1))
        for low, high in zip(bounds[:-1], bounds[1:]):
            edges = by_depth[low:high]
            ends = dst[edges]
            first = np.flatnonzero(np.concatenate(([True], ends[1:] != ends[:-1])))
            value = alpha[self.src[edges]] + logs[edges]
            sizes = np.diff(np.append(first, len(edges)))
            top = np.repeat(np.maximum.reduceat(value, first), sizes)
            part = np.exp(value - top)
            whole = np.add.reduceat(part, first)
            alpha[ends[first]] = top[first] + np.log(whole)
            running = np.cumsum(part)
            running -= np.repeat(running[first] - part[first], sizes)
            share[edges] = running / np.repeat(whole, sizes)
        return share.astype(np.float32)

    def sample(self, chunks: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling for many places: piece ids of place after place, and how many each has."""
        node, goal = self.ends[chunks], self.starts[chunks]
        active = np.flatnonzero(node > goal)
        counts = np.zeros(len(chunks), np.int64)
        rounds = []
        turn = np.zeros(1, np.uint64)
        while len(active):
            at = node[active]
            draw = uniform(seeds[active] + turn)
            edge, last = self.first[at], self.first[at + 1] - 1
            slow = np.flatnonzero((draw >= self.upto[edge]) & (edge < last))
            while len(slow):
                edge[slow] += 1
                slow = slow[(draw[slow] >= self.upto[edge[slow]]) & (edge[slow] < last[slow])]
            rounds.append((active, self.piece[edge]))
            counts[active] += 1
            node[active] = self.src[edge]
            active = active[node[active] > goal[active]]
            turn += np.uint64(0x9E3779B97F4A7C15)
        out = np.empty(counts.sum(), np.int64)
        tail = np.cumsum(counts)
        for i, (places, ids) in enumerate(rounds):  # the last piece is drawn first
            out[tail[places] - 1 - i] = ids
        return out, counts


def uniform(x: np.ndarray) -> np.ndarray:
    """[0, 1) from 64-bit keys."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def in_bytes(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without a piece by the pieces of their bytes."""
    bare = np.flatnonzero(ids < 0)
    if not len(bare):
        return ids, counts
    written = [vocabulary.byte_ids[list(chr(-1 - c).encode("utf-8", "surrogatepass"))] for c in ids[bare].tolist()]
    sizes = np.ones(len(ids), np.int64)
    sizes[bare] = [len(w) for w in written]
    stops = np.cumsum(sizes)
    out = np.repeat(ids, sizes)
    out[np.repeat(ids < 0, sizes)] = np.concatenate(written)
    edge = np.cumsum(counts)
    total = np.where(edge > 0, stops[np.maximum(edge - 1, 0)], 0)
    return out, np.diff(total, prepend=0)


class Numbers(dict):
    """Numbers its keys in the order of asking."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Encoder:
    """Cuts texts; keeps the lattices of the chunks that it has met."""

    def __init__(self, vocabulary: Vocabulary, seed: int) -> None:
        self.vocabulary, self.seed = vocabulary, seed
        self.numbers = Numbers()
        self.parts: list[Lattices] = []
        self.sizes: list[int] = []
        self.held = 0

    def encode(self, keys: list[bytes], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and how many each text has."""
        if self.held > HELD_CHARS:
            self.numbers, self.parts, self.sizes, self.held = Numbers(), [], [], 0
        numbers = self.numbers
        known = len(numbers)
        cut = [CHUNK.findall(t) for t in texts]
        per_text = np.fromiter(map(len, cut), np.int64, len(cut))
        places = np.fromiter(map(numbers.__getitem__, chain.from_iterable(cut)), np.int64, int(per_text.sum()))
        if len(numbers) > known:
            new = list(islice(numbers, known, None))
            self.held += sum(map(len, new))
            self.parts.append(Lattices(new, self.vocabulary))
            self.sizes.append(known)
        rows = np.array([xxhash.xxh64_intdigest(k, self.seed) for k in keys], np.uint64)
        inside = np.arange(len(places)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        seeds = np.repeat(rows, per_text) + inside.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        part = np.searchsorted(self.sizes, places, side="right") - 1
        counts = np.zeros(len(places), np.int64)
        drawn = []
        for i, lattices in enumerate(self.parts):
            at = np.flatnonzero(part == i)
            ids, n = lattices.sample(places[at] - self.sizes[i], seeds[at])
            ids, n = in_bytes(ids, n, self.vocabulary)
            counts[at] = n
            drawn.append((at, ids, n))
        begins = np.cumsum(counts) - counts
        out = np.empty(counts.sum(), np.int32)
        for at, ids, n in drawn:
            offset = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(begins[at], n) + offset] = ids
        edges = np.concatenate(([0], np.cumsum(counts)))
        upto = edges[np.concatenate(([0], np.cumsum(per_text)))]
        return out, np.diff(upto)


def decode(ids: list[int], raw: list[bytes]) -> str:
    return b"".join(map(raw.__getitem__, ids)).decode("utf-8", "surrogatepass")


def encode(docs: DataFrame, model_path: str, key_col: str = "doc_id", text_col: str = "text", seed: int = SEED) -> DataFrame:
    """``docs`` plus __ids (array of piece ids) and __lossless (decoding gives the text back).

    Rows with equal keys and texts are cut alike. Null and empty texts have no pieces and are lossless. A null key is a
    key. The space sign of the model, where it stands in a text, is written in bytes, so it stays apart from a space.
    ``model_path`` is read by the driver; the vocabulary, not above a few MB, goes to the tasks.
    """
    vocabulary = load_vocabulary(model_path)
    names = [n for n in vocabulary.__dataclass_fields__]
    shared = docs.sparkSession.sparkContext.broadcast([getattr(vocabulary, n) for n in names])
    own_docs, new, old = apart(docs, ("__ids", "__lossless"))
    key, text = F.col(new[key_col]).cast("string"), F.col(new[text_col]).cast("string")
    taken = own_docs.select("*", F.coalesce(key, F.lit("")).alias("__key"), F.coalesce(text, F.lit("")).alias("__text"))

    def run(batches):
        own = Vocabulary(*shared.value)
        encoder = Encoder(own, seed)
        for batch in slices(batches, "__text", SLICE):
            texts = batch["__text"].to_pylist()
            ids, counts = encoder.encode([k.encode() for k in batch["__key"].to_pylist()], texts)
            stops = np.cumsum(counts)
            plain = ids.tolist()
            lossless = [decode(plain[e - n : e], own.raw) == t for e, n, t in zip(stops.tolist(), counts.tolist(), texts)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], stops)).astype(np.int32)), pa.array(ids))
            kept = [batch[i] for i in range(batch.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*kept, lists, pa.array(lossless, pa.bool_())], [*batch.schema.names[:-2], "__ids", "__lossless"])

    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in own_docs.schema.fields)
    return taken.mapInArrow(run, fields + "__ids array<int>, __lossless boolean").toDF(*old, "__ids", "__lossless")


def decode_ids(encoded: DataFrame, model_path: str, ids_col: str = "__ids") -> DataFrame:
    """``encoded`` plus __decoded, the text of each row's pieces. Null ids give null."""
    raw = encoded.sparkSession.sparkContext.broadcast(load_vocabulary(model_path).raw)

    @F.pandas_udf("string")
    def run(ids):
        return ids.map(lambda x: None if x is None else decode(x.tolist(), raw.value))

    return encoded.withColumn("__decoded", run(F.col(ids_col)))
