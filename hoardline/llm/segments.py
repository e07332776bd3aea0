"""Sampled SentencePiece segmentations without replacement, and their decoding.

All ways to cut a text into pieces of a vocabulary form a lattice. Pieces never reach across a line feed or from a
word into the space behind it, so the lattice of a text is a chain of small lattices, one per chunk, and equal
chunks share theirs. Backward sums turn each lattice into edge probabilities; a text's segmentations then get
Gumbel-perturbed log-probabilities from the top down: the best segmentation inherits the perturbation of the whole set,
and the set without it splits, at every edge of its path, into the segmentations that leave the path there, each
subset with a truncated Gumbel of its own. Taking the best subset again and again is a perturbed A-star search: its first k
results are k distinct segmentations sampled without replacement.
"""

from __future__ import annotations

import heapq
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.llm.common import by_batch, give_back, list_parts, mix64, row_key, text_or_empty, tidy, uniforms

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SHARPNESS = 1.0  # 0: all segmentations alike; large: the likeliest only
BLOCK_CHARS = 1 << 17
CHUNK = re.compile(r"\n| +[^ \n]*|[^ \n]+")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with a space for the word mark; ``bytes_at`` are the ids of the 256 byte pieces; ``weights`` are log-probabilities.

    The model file ranks its pieces but gives no probabilities; a piece of rank r counts as 1 / (r + 2.7)."""

    pieces: dict
    weights: np.ndarray
    bytes_at: np.ndarray
    raw: tuple  # id -> bytes


def vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces, raw = {}, [b""] * size
    ranks, bytes_at = np.full(size, float(size)), np.zeros(256, np.int64)
    for i in range(size):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_at[int(name[3:-1], 16)] = i
            raw[i] = bytes([int(name[3:-1], 16)])
        elif not (model.is_control(i) or model.is_unknown(i)):
            shown = name.replace("▁", " ")
            pieces[shown] = i
            raw[i] = shown.encode()
            ranks[i] = min(float(size), -model.get_score(i))
    return Vocabulary(pieces, -np.log(ranks + 2.7) - math.log(math.log(size)), bytes_at, tuple(raw))


class Trie:
    """The pieces as arrays: (node, character) -> node, and the piece that ends in each node or -1."""

    def __init__(self, vocab: Vocabulary):
        edges: dict[tuple[int, int], int] = {}
        ends = {}
        for piece, number in vocab.pieces.items():
            node = 0
            for c in piece:
                node = edges.setdefault((node, ord(c)), len(edges) + 1)
            ends[node] = number
        order = sorted(edges)
        self.keys = np.array([node << 21 | c for node, c in order], np.int64)
        self.child = np.array([edges[k] for k in order], np.int64)
        self.piece = np.full(len(edges) + 1, -1, np.int64)
        self.piece[list(ends)] = list(ends.values())
        inner = sorted({node for node, c in order if c < 256})
        self.row = np.full(len(edges) + 1, len(inner), np.int64)  # of the table for the first 256 characters
        self.row[inner] = np.arange(len(inner))
        self.table = np.zeros((len(inner) + 1, 256), np.int32)
        low = (self.keys & 0x1FFFFF) < 256
        self.table[self.row[self.keys[low] >> 21], self.keys[low] & 0xFF] = self.child[low]

    def step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The next nodes; 0 where no piece goes on."""
        out = self.table[self.row[node], code & 0xFF].astype(np.int64)
        high = np.flatnonzero(code > 255)
        if len(high):
            out[high] = self._search(node[high], code[high])
        return out

    def _search(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        key = node << 21 | code
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.child[at], 0)


class Lattices:
    """The lattices of a set of chunks. Character p of all chunks together is node p + 1, the end of each chunk is node 0.

    Per node: ``begin`` and ``count`` of its edges. Per edge: ``source`` and ``to``, ``piece`` (below 0: character
    -1 - piece of ``strange``, which has no piece), log-probability ``logq`` given the node, ``rest`` (that of the
    node's other edges) and ``cum`` (running sum of probabilities)."""

    def __init__(self, trie: Trie, vocab: Vocabulary, weights: np.ndarray, chunks: list[str]):
        code = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.array([len(c) for c in chunks], np.int64)
        ends = np.cumsum(size)
        self.roots = ends - size + 1
        left = np.repeat(ends, size) - np.arange(len(code))  # characters to the end of the chunk
        spots, pieces, widths = [], [], []
        at, node, width = np.arange(len(code)), np.zeros(len(code), np.int64), 0
        single = np.zeros(len(code), bool)
        while len(at):
            node = trie.step(node, code[at + width])
            width += 1
            on = node > 0
            at, node = at[on], node[on]
            hit = trie.piece[node] >= 0
            spots.append(at[hit])
            pieces.append(trie.piece[node[hit]])
            widths.append(np.full(int(hit.sum()), width))
            if width == 1:
                single[at[hit]] = True
            on = left[at] > width
            at, node = at[on], node[on]
        bare = np.flatnonzero(~single)
        strange, which = np.unique(code[bare], return_inverse=True)
        self.strange = [chr(c).encode() for c in strange.tolist()]
        price = np.array([weights[vocab.bytes_at[list(c)]].sum() for c in self.strange])
        spots.insert(0, bare)
        pieces.insert(0, -1 - which.astype(np.int64))
        widths.insert(0, np.ones(len(bare), np.int64))
        # Edges by distance to the end, then node, then width: nodes are ordered and each width fills the next place of its nodes.
        short = left.astype(np.uint16) if len(left) and left.max() < 1 << 16 else left
        by_left = np.argsort(short, kind="stable")
        each = np.bincount(np.concatenate(spots), minlength=len(code))
        free = np.empty(len(code), np.int64)
        free[by_left] = np.cumsum(each[by_left]) - each[by_left]
        edges = int(each.sum())
        spot, width, weight = np.empty(edges, np.int32), np.empty(edges, np.int32), np.empty(edges)
        self.piece = np.empty(edges, np.int32)
        for at, number, wide in zip(spots, pieces, widths, strict=True):
            place = free[at]
            free[at] += 1
            spot[place], width[place], self.piece[place] = at, wide, number
            weight[place] = weights[np.maximum(number, 0)]
        odd = np.flatnonzero(self.piece < 0)
        if len(odd):
            weight[odd] = price[-1 - self.piece[odd]]
        self.source = spot + 1
        self.to = np.where(left[spot] == width, 0, spot + width + 1)
        heads = np.flatnonzero(np.append(True, spot[1:] != spot[:-1])) if len(spot) else np.empty(0, np.int64)
        self.begin, self.count = np.zeros(len(code) + 1, np.int64), np.zeros(len(code) + 1, np.int64)
        self.begin[self.source[heads]] = heads
        self.count[self.source[heads]] = np.diff(np.append(heads, len(spot)))
        if not len(spot):
            self.logq = self.rest = self.cum = np.empty(0)
            return
        total = np.zeros(len(code) + 1)  # log of the sum over all ways to the end
        levels = np.searchsorted(left[spot], np.arange(1, int(left.max()) + 2))
        head_levels = np.searchsorted(heads, levels)
        for k in range(len(levels) - 1):
            a, b = levels[k], levels[k + 1]
            if a == b:
                continue
            own = heads[head_levels[k] : head_levels[k + 1]]
            value = weight[a:b] + total[self.to[a:b]]
            top = np.maximum.reduceat(value, own - a)
            share = np.exp(value - np.repeat(top, self.count[self.source[own]]))
            total[self.source[own]] = top + np.log(np.add.reduceat(share, own - a))
        value = weight + total[self.to]
        each = self.count[self.source[heads]]
        share = np.exp(value - np.repeat(np.maximum.reduceat(value, heads), each))
        whole = np.repeat(np.add.reduceat(share, heads), each)
        best = share == 1.0
        small = np.repeat(np.add.reduceat(np.where(best, 0.0, share), heads) + np.add.reduceat(best.astype(float), heads) - 1, each)
        others = np.where(best, small, whole - share)
        with np.errstate(divide="ignore"):
            self.rest = np.log(others / whole)
        self.rest[np.repeat(each, each) == 1] = -np.inf
        self.logq = value - total[self.source]
        run = np.cumsum(share)
        run -= np.repeat(run[heads] - share[heads], each)
        self.cum = run / whole
        self.cum[np.append(heads[1:], len(spot)) - 1] = 2.0


_OCCURRENCE, _STEP, _ROUND, _NODE_NOISE = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def _walk(lattices: Lattices, node: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled paths from ``node`` to the end of each chunk: (element, edge), elements ascending, edges in order."""
    begin, to, cum = lattices.begin, lattices.to, lattices.cum
    alive = np.flatnonzero(node)
    node, key = node[alive], key[alive]
    elements, edges = [], []
    step = 0
    with np.errstate(over="ignore"):
        while len(alive):
            u = uniforms(key + np.uint64(step) * _STEP)
            edge = begin[node]
            more = np.flatnonzero(u >= cum[edge])
            while len(more):
                edge[more] += 1
                more = more[u[more] >= cum[edge[more]]]
            elements.append(alive)
            edges.append(edge)
            node = to[edge]
            left = node != 0
            if not left.all():
                alive, node, key = alive[left], node[left], key[left]
            step += 1
    if not elements:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    element, edge = np.concatenate(elements), np.concatenate(edges)
    order = np.argsort(element, kind="stable")
    return element[order], edge[order]


def _gumbel(u):
    return -np.log(-np.log(u))


class Sampler:
    """Samples for the texts of a block; everything random follows from a row's key and the seed."""

    def __init__(self, vocab: Vocabulary, samples: int, sharpness: float, seed: int):
        self.trie, self.vocab, self.samples = Trie(vocab), vocab, samples
        self.weights = vocab.weights * sharpness
        self.seed = np.uint64(seed)

    def block(self, texts: list[str], keys: np.ndarray) -> list[list[tuple]]:
        """Per text at most ``samples`` tuples (edges, log-probability, perturbed, log-inclusion), best first."""
        cuts, occurrences, numbers = [0], [], {}
        for text in texts:
            if text:
                occurrences += [numbers.setdefault(c, len(numbers)) for c in CHUNK.findall(" " + text)]
            cuts.append(len(occurrences))
        self.lattices = lattices = Lattices(self.trie, self.vocab, self.weights, list(numbers))
        roots, cuts = lattices.roots[np.array(occurrences, np.int64)], np.array(cuts)
        begin, count, to, logq = lattices.begin, lattices.count, lattices.to, lattices.logq
        with np.errstate(over="ignore"):
            row = mix64(keys ^ (self.seed * _ROUND))
            place = np.arange(len(roots)) - np.repeat(cuts[:-1], np.diff(cuts))
            element_key = np.repeat(row, np.diff(cuts)) + place.astype(np.uint64) * _OCCURRENCE
        chunk, edge = _walk(lattices, roots, mix64(element_key))
        starts = np.searchsorted(chunk, cuts)
        paths = [[(edge[a:b], chunk[a:b])] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        found: list[list] = [[] for _ in texts]
        heaps: list[list] = [[] for _ in texts]
        root_noise = _gumbel(uniforms(row ^ _NODE_NOISE))
        live = [i for i in range(len(texts)) if len(paths[i][0][0])]
        for i in live:
            path = paths[i][0][0]
            found[i].append((path, float(logq[path].sum()), float(root_noise[i])))
        self._split(live, paths, [0] * len(texts), found, heaps, row, 0)
        for turn in range(1, self.samples):
            grown, nodes, node_keys, owners, heads = [], [], [], [], []
            for i in live:
                if not heaps[i]:
                    continue
                noise, sample, at, excluded = heapq.heappop(heaps[i])
                old, where = paths[i][sample]
                taken = {*excluded, int(old[at])}
                node = lattices.source[old[at]]
                others = [e for e in range(begin[node], begin[node] + count[node]) if e not in taken]
                with np.errstate(over="ignore"):
                    key = mix64(row[i : i + 1] + np.uint64(turn) * _ROUND)
                chances = np.exp(logq[others])
                pick = others[min(int(np.searchsorted(np.cumsum(chances), uniforms(key ^ _NODE_NOISE)[0] * chances.sum(), side="right")), len(others) - 1)]
                tail = np.arange(where[at] + 1, cuts[i + 1])
                nodes.append(np.concatenate([[to[pick]], roots[tail]]))
                with np.errstate(over="ignore"):
                    node_keys.append(mix64(key + (np.arange(len(tail) + 1) + (where[at] - cuts[i])).astype(np.uint64) * _OCCURRENCE))
                owners.append(np.concatenate([[where[at]], tail]))
                heads.append((old[:at], where[:at], pick, where[at], -noise, excluded | {int(old[at])}, at))
                grown.append(i)
            if not grown:
                break
            element, edge = _walk(lattices, np.concatenate(nodes), np.concatenate(node_keys))
            bounds = np.searchsorted(element, np.append(0, np.cumsum([len(n) for n in nodes])))
            owner = np.concatenate(owners)
            origin = [0] * len(texts)
            again = []
            for g, i in enumerate(grown):
                head, head_at, pick, spot, noise, excluded, at = heads[g]
                a, b = bounds[g], bounds[g + 1]
                path = np.concatenate([head, [pick], edge[a:b]])
                paths[i].append((path, np.concatenate([head_at, [spot], owner[element[a:b]]])))
                found[i].append((path, float(logq[path].sum()), noise))
                origin[i] = at + 1
                again.append((i, at, excluded))
            self._split(grown, paths, origin, found, heaps, row, turn)
            for i, at, excluded in again:  # what is left where the path was left
                path = paths[i][-1][0]
                gone = [*excluded, int(path[at])]
                node = lattices.source[path[at]]
                others = [e for e in range(begin[node], begin[node] + count[node]) if e not in gone]
                if others:
                    mass = float(logq[path[:at]].sum() + np.log(np.exp(logq[others]).sum()))
                    with np.errstate(over="ignore"):
                        noise = float(_gumbel(uniforms(row[i : i + 1] ^ (_NODE_NOISE + np.uint64(turn) * _OCCURRENCE)))[0]) + mass
                    bounded = -float(np.logaddexp(-found[i][-1][2], -noise))
                    heapq.heappush(heaps[i], (-bounded, turn, at, excluded))
        out = []
        for i in range(len(texts)):
            limit = -heaps[i][0][0] if heaps[i] else -math.inf
            out.append([(path, logp, noise, _log_inclusion(logp - limit)) for path, logp, noise in found[i]])
        return out

    def _split(self, rows, paths, origin, found, heaps, row, turn):
        """Adds to each heap the best subsets that leave the newest path behind ``origin``; deeper ones can never be asked for."""
        logq, rest = self.lattices.logq, self.lattices.rest
        if not rows:
            return
        parts = [paths[i][-1][0] for i in rows]
        sizes = np.array([len(p) for p in parts])
        path = np.concatenate(parts)
        starts = np.append(0, np.cumsum(sizes))
        run = np.cumsum(logq[path]) - logq[path]
        before = run - np.repeat(run[starts[:-1]], sizes)
        place = np.arange(len(path)) - np.repeat(starts[:-1], sizes)
        with np.errstate(over="ignore"):
            key = np.repeat(row[rows] + np.uint64(turn + 1) * _NODE_NOISE, sizes) + place.astype(np.uint64) * _STEP
        noise = _gumbel(uniforms(key)) + before + rest[path]
        bound = np.repeat(np.array([found[i][-1][2] for i in rows]), sizes)
        value = -np.logaddexp(-bound, -noise)
        value[place < np.repeat(np.array([origin[i] for i in rows]), sizes)] = -np.inf
        for _ in range(self.samples):  # one more than can be taken: the last bounds the inclusion scores
            best = np.maximum.reduceat(value, starts[:-1])
            hit = np.flatnonzero(value == np.repeat(best, sizes))
            spots = hit[np.unique(np.repeat(np.arange(len(rows)), sizes)[hit], return_index=True)[1]]
            some = False
            for g, spot in enumerate(spots.tolist()):
                if best[g] > -np.inf:
                    heapq.heappush(heaps[rows[g]], (-float(best[g]), turn, int(place[spot]), frozenset()))
                    some = True
            value[spots] = -np.inf
            if not some:
                break

    def ids(self, path: np.ndarray) -> np.ndarray:
        """Piece ids of a path; a character without a piece becomes its bytes."""
        pieces = self.lattices.piece[path]
        strange = np.flatnonzero(pieces < 0)
        if not len(strange):
            return pieces.astype(np.int32)
        data = [self.lattices.strange[-1 - p] for p in pieces[strange].tolist()]
        width = np.ones(len(pieces), np.int64)
        width[strange] = [len(d) for d in data]
        out = np.repeat(pieces, width)
        out[out < 0] = self.vocab.bytes_at[np.frombuffer(b"".join(data), np.uint8)]
        return out.astype(np.int32)


def _log_inclusion(excess: float) -> float:
    """log(1 - exp(-exp(excess))): the chance that a perturbed segmentation exceeds the limit."""
    if excess < -30:
        return excess
    return math.log(-math.expm1(-math.exp(min(excess, 700.0))))


class Decoder:
    """Piece ids back to text; the space in front of a text belongs to its segmentation, not to the text."""

    def __init__(self, vocab: Vocabulary):
        self.raw = np.frombuffer(b"".join(vocab.raw), np.uint8)
        self.length = np.array([len(x) for x in vocab.raw])
        self.start = np.cumsum(self.length) - self.length

    def texts(self, ids: np.ndarray, cuts: np.ndarray) -> list[str]:
        """The texts of several lists of ids; list i is ``ids[cuts[i]:cuts[i + 1]]``."""
        width = self.length[ids]
        ends = np.cumsum(width)
        spots = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - ends + width, width)
        data = self.raw[spots].tobytes()
        bounds = np.append(0, ends)[cuts].tolist()
        return [data[a + 1 : b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


FIELDS = [("ids", "array<int>", pa.list_(pa.int32())), ("log_prob", "double", pa.float64()), ("perturbed", "double", pa.float64()), ("log_inclusion", "double", pa.float64())]
DECODED = ("decoded", "string", pa.string())


def encode(
    documents: DataFrame,
    vocab: Vocabulary | None = None,
    samples: int = SAMPLES,
    sharpness: float = SHARPNESS,
    seed: int = 1,
    decoded: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, samples``: at most ``samples`` distinct segmentations of each whole text, in the order in which they were drawn,
    with ``decoded`` also the text that each of them decodes to.

    A row's draws depend on its id, its text and the seed alone, so repeated rows repeat their samples. Null and empty texts
    have no samples; a text with fewer segmentations than asked for gets them all, each with log-inclusion 0. Other columns are ignored."""
    vocab = vocab or vocabulary()
    fields = FIELDS + [DECODED] * decoded
    schema = f"doc_id long, samples array<struct<{','.join(f'{name}:{kind}' for name, kind, _ in fields)}>>"

    def run(batches):
        sampler, decoder = Sampler(vocab, samples, sharpness, seed), Decoder(vocab)
        struct = pa.struct([(name, kind) for name, _, kind in fields])

        def block(batch, start, stop):
            rows = batch.slice(start, stop - start)
            keys = rows.column(1).to_numpy().astype(np.uint64)
            drawn = sampler.block(rows.column(2).to_pylist(), keys)
            flat = [s for row in drawn for s in row]
            ids = [sampler.ids(s[0]) for s in flat]
            sampler.lattices = None
            values = np.concatenate(ids) if ids else np.empty(0, np.int32)
            cuts = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int64)
            parts = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, pa.int32()))]
            parts += [pa.array([s[k] for s in flat], pa.float64()) for k in (1, 2, 3)]
            if decoded:
                parts.append(pa.array(decoder.texts(values, cuts), pa.string()))
            items = pa.StructArray.from_arrays(parts, fields=list(struct))
            offsets = pa.array(np.append(0, np.cumsum([len(row) for row in drawn])), pa.int32())
            return pa.RecordBatch.from_arrays([rows.column(0), pa.ListArray.from_arrays(offsets, items)], ["doc_id", "samples"])

        for batch in batches:
            sizes = np.cumsum(pa.compute.utf8_length(batch.column(2)).to_numpy())
            start = 0
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, done + BLOCK_CHARS, side="right")))
                yield block(batch, start, stop)
                if sizes[stop - 1] - done > 8 * BLOCK_CHARS:
                    give_back()  # after a very long text
                start = stop

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return source.select("doc_id", row_key(source, "doc_id", "text").alias("key"), "text").mapInArrow(tidy(run), schema)


def decode(encoded: DataFrame, ids_column: str = "ids", vocab: Vocabulary | None = None) -> DataFrame:
    """``encoded`` with ``decoded``: the text of the piece ids. Null and empty lists give an empty text."""
    vocab = vocab or vocabulary()
    columns = [c for c in encoded.columns if c not in (ids_column, "decoded")]
    kinds = {f.name: f.dataType.simpleString() for f in encoded.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + (", " if columns else "") + "decoded string"

    def run(batches):
        decoder = Decoder(vocab)

        def one(batch):
            texts = decoder.texts(*list_parts(batch.column(ids_column)))
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(texts, pa.string())], [*columns, "decoded"])

        yield from by_batch(one)(batches)

    source = encoded.withColumn(ids_column, F.coalesce(F.col(ids_column), F.array().cast("array<int>"))).drop("decoded")
    return source.select(*columns, ids_column).mapInArrow(tidy(run), schema)


def drawn(documents: DataFrame, **options) -> DataFrame:
    """One row per sample: ``doc_id, sample`` (from 1), ``ids, log_prob, perturbed, log_inclusion``."""
    rows = encode(documents, **options).select("doc_id", F.posexplode("samples").alias("_at", "_s"))
    return rows.select("doc_id", (F.col("_at") + 1).alias("sample"), "_s.*")
