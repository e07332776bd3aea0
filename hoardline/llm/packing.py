"""Packing documents into sequences of bounded length by best two fit.

A sequence is filled greedily with the longest piece that still fits; then its smallest piece gives way to two unpacked pieces if
they use the room more tightly. Which piece of a length is taken never matters, so the packing is planned on the number of pieces
of each length: at most ``capacity`` numbers, whatever the size of the corpus. As long as no length runs out the next
sequence is filled like the one before, so that a plan is a list of fillings with repeats. The pieces of a length are
then ranked by Spark, in buckets, and every rank looks its place up in the plan.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.llm.common import text_or_empty, tidy
from hoardline.operators import ranking
from hoardline.session import cut_lineage

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
BLOCK_CHARS = 1 << 20
CACHE_WORDS = 700_000
CACHE_IDS = 7_000_000
BUCKET_DIGITS = 2


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Numbered(dict):
    """Numbers for parts in the order in which they are first asked for; ``fresh`` are those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.fresh.append(part)
        return number


# Closing punctuation after a letter or digit and before a blank is a match of its own.
CLOSING = re.compile(r"([.,;:!?](?<=[A-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF].)[.,;:!?]*)(?=[ \n]|$)")


# Small letters that every normal form leaves alone: such a part is one word, and only its bytes' characters are to be looked up.
PLAIN = re.compile("[a-z\u00DF-\u00F6\u00F8-\u00FF]+")
PROBE = "Straße, don't été 12 a1! naïve... X-Ray (ok)? ÉCOLE"


def byte_characters() -> dict[int, str]:
    """The characters that stand for the bytes in byte-level vocabularies: visible Latin-1 ones for themselves, then those from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


class Encoder:
    """Ids of whole texts, looked up by the parts between blanks; parts not met before go through the tokenizer, plain words
    straight through its model.

    The vocabulary drops white space and case and none of its patterns reaches over a blank, so the ids of a text are those of its
    parts in lower case. Texts that may hold special tokens, which are found before case is dropped, keep theirs. A vocabulary of another
    kind is refused."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks, not threads inside them, fill the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Numbered()
        self.lengths, self.values = array("q"), array("i")
        self.characters = byte_characters()
        if self.encode([PROBE])[0].tolist() != self.tokenizer.encode(PROBE, add_special_tokens=False).ids:
            raise ValueError("the vocabulary must drop case and white space")

    def _ids(self, part: str) -> list[int]:
        named = part if part.isascii() else part.encode().decode("latin-1").translate(self.characters)
        return [token.id for token in self.tokenizer.model.tokenize(named)]

    def _forget(self) -> None:
        """Drop the parts met last; those met first are the frequent ones."""
        kept = CACHE_WORDS // 2 if sum(self.lengths[: CACHE_WORDS // 2]) <= CACHE_IDS // 2 else 0
        known = Numbered()
        known.update((part, number) for part, number in self.known.items() if number < kept)
        self.known, self.lengths = known, self.lengths[:kept]
        self.values = self.values[: sum(self.lengths)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids end."""
        if len(self.known) > CACHE_WORDS or len(self.values) > CACHE_IDS:
            self._forget()
        parts: list[str] = []
        ends = np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            if "<|" not in text:
                text = text.encode().lower().decode()  # ASCII only, as other letters depend on their neighbours
            parts += CLOSING.sub(r" \1", text).replace("\n", " ").split(" ")
            ends[i] = len(parts)
        at = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
        fresh = self.known.fresh
        plain = [PLAIN.fullmatch(part) is not None for part in fresh]
        others = [part for part, is_plain in zip(fresh, plain, strict=True) if not is_plain]
        coded = (c.ids for at in range(0, len(others), 2048) for c in self.tokenizer.encode_batch_fast(others[at : at + 2048], add_special_tokens=False))
        for part, is_plain in zip(fresh, plain, strict=True):
            ids = self._ids(part) if is_plain else next(coded)
            self.lengths.append(len(ids))
            self.values.extend(ids)
        fresh.clear()
        lengths, values = np.array(self.lengths, np.int64), np.array(self.values, np.int32)
        starts = np.cumsum(lengths) - lengths
        taken = lengths[at]
        stops = np.cumsum(taken)
        spots = np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts[at] - stops + taken, taken)
        return values[spots], np.append(0, stops)[ends]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder: loading the vocabulary and meeting its words takes as long as many texts do."""
    return Encoder(path)


def _blocks(texts: list[str]):
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if chars and chars + len(text) > BLOCK_CHARS:
            yield start, i
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)


def pieces(
    documents: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and with ``with_ids`` also ``ids``, in pieces of at most ``capacity`` ids.

    Every whole text is encoded and closed by ``end_id``; null and empty texts are that id alone. Only longer documents are
    cut, so that all their pieces but the last are full. Repeated rows give their pieces once for each row. Ids may be null;
    other columns are ignored; an empty table gives no rows."""
    path = path or vocabulary_path()
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches):
        coder = encoder(path)
        for batch in batches:
            texts, doc_ids = batch.column(1).to_pylist(), batch.column(0)
            for first, last in _blocks(texts):
                values, ends = coder.encode(texts[first:last])
                rows, numbers, starts, lengths, sums, parts = [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True), first):
                    ids = np.append(values[a:b], np.int32(end_id)).astype("<u4")
                    for number, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        rows.append(i)
                        numbers.append(number)
                        starts.append(start)
                        lengths.append(len(part))
                        sums.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            parts.append(part)
                columns = [doc_ids.take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int32()), pa.array(sums, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cuts = np.append(0, np.cumsum(lengths))
                    flat = np.concatenate(parts).view(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return source.mapInArrow(tidy(run), schema)


def _pair(left: np.ndarray, room: int) -> tuple[int, int]:
    """Two unpacked lengths that together come closest to ``room`` from below; (0, 0) if there are none."""
    lengths = np.arange(room)
    below = np.maximum.accumulate(np.where(left[:room] > 0, lengths, 0))  # the longest one up to each length
    firsts = np.flatnonzero(left[:room])
    seconds = below[np.minimum(firsts, room - firsts)]
    single = (seconds == firsts) & (left[firsts] < 2)
    seconds = np.where(single, below[np.maximum(firsts - 1, 0)], seconds)
    sums = np.where(seconds > 0, firsts + seconds, 0)
    if not len(sums) or not sums.max():
        return 0, 0
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return int(firsts[best]), int(seconds[best])


def _filling(left: np.ndarray, capacity: int) -> tuple[list[int], np.ndarray]:
    """The lengths of the next sequence, and how many of each length were looked at as if taken."""
    room, taken, touched = capacity, [], np.zeros_like(left)
    rest = left.copy()
    while room:
        fits = np.flatnonzero(rest[: room + 1])
        if not len(fits):
            break
        longest = int(fits[-1])
        times = min(int(rest[longest]), room // longest)
        taken += [longest] * times
        rest[longest] -= times
        touched[longest] += times
        room -= longest * times
    if room and len(taken) > 1:
        smallest = taken[-1]
        first, second = _pair(rest, room + smallest)
        if first + second > smallest:
            taken[-1:] = [first, second]
            touched[first] += 1
            touched[second] += 1
    return taken, touched


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Fillings with repeats for ``counts[length]`` pieces of each length up to ``capacity``.

    A filling is repeated while every length in it stays so plentiful that no choice could turn out differently."""
    left = np.zeros(capacity + 1, np.int64)
    left[: len(counts)] = counts
    left[0] = 0
    fillings = []
    while left.any():
        taken, touched = _filling(left, capacity)
        used = np.bincount(taken, minlength=capacity + 1)
        at = np.flatnonzero(used)
        spare = int(((left[at] - touched[at] - 2) // used[at]).min())
        times = 1 + max(0, spare)
        fillings.append((times, sorted(taken, reverse=True)))
        left -= times * used
    return fillings


class Places:
    """Sequence and offset of the n-th piece of a length."""

    SPAN = 1 << 48

    def __init__(self, fillings: list[tuple[int, list[int]]]):
        keys, each, bases, at, offsets = [], [], [], [], []
        seen: dict[int, int] = {}
        base = 0
        for times, lengths in fillings:
            place, inside = 0, {}
            for length in lengths:
                inside.setdefault(length, []).append(place)
                place += length
            for length, places in inside.items():
                keys.append(length * self.SPAN + seen.get(length, 0))
                each.append(len(places))
                bases.append(base)
                at.append(len(offsets))
                offsets += places
                seen[length] = seen.get(length, 0) + times * len(places)
            base += times
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.each, self.bases, self.at = (np.array(x, np.int64)[order] for x in (keys, each, bases, at))
        self.offsets = np.array(offsets, np.int64)

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``ranks`` count from 0 within a length."""
        wanted = lengths * self.SPAN + ranks
        slot = np.searchsorted(self.keys, wanted, side="right") - 1
        repeat, nth = np.divmod(wanted - self.keys[slot], self.each[slot])
        return self.bases[slot] + repeat, self.offsets[self.at[slot] + nth]


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (from :func:`pieces`) with ``sequence_id`` and ``offset``; sequences have no gaps.

    ``parts`` is read three times, so it should be stored. Only the number of pieces of each length reaches the driver,
    at most ``capacity`` rows, and the plan made of it, which is as bounded, goes to the tasks."""
    counted = parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in counted:
        counts[row["length"]] = row["n"]
    places = Places(plan(counts, capacity))
    order = [F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32")]
    dealt = F.substring(F.md5(F.concat_ws("|", *[c.cast("string") for c in order])), 1, BUCKET_DIGITS)
    ranked = ranking.spread_row_number(parts, "_rank", bucket=dealt, order=order, by=["length"])
    names = parts.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"

    def run(batches):
        for batch in batches:
            lengths = batch.column("length").to_numpy().astype(np.int64)
            ranks = batch.column("_rank").to_numpy() - 1
            sequence, offset = places.find(lengths, ranks)
            columns = [*(batch.column(n) for n in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return ranked.select(*names, "_rank").mapInArrow(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, doc_ids, starts``: the packed ids themselves, from pieces that were made ``with_ids``; ``starts`` is
    where each document's piece begins. A sequence is one bounded row."""
    placed = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = packed.groupBy("sequence_id").agg(placed.alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))


def packed(documents: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    """Pieces of all documents with their places: ``doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset``.

    Nulls, empty texts, repeated rows, other columns and empty tables: see :func:`pieces`. Documents that tie in length are placed
    by a hash of id and content, so reruns agree."""
    stored = cut_lineage(pieces(documents, capacity=capacity, **options), "pack-pieces")
    return pack(stored, capacity)
