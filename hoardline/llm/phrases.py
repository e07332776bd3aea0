"""Phrase collocations, mined by dynamic itemset counting.

The documents are dealt to a few stored shards that are scanned in turn, again and again. Words are counted from the start. As soon as
both parts of a longer phrase (all but its last word, all but its first) have reached the threshold, the phrase is counted too, from
the next shard on and until it has seen every shard once, so that lengths are counted side by side and each count is whole.

When a phrase reached the threshold is kept in a table of fixed size, one byte a slot and two slots a phrase, that every scan
gets. A slot keeps its first step for good, so two phrases that share slots can only make another phrase be counted that
need not be; it is counted over one whole cycle all the same and then falls to the threshold. Counts are added up by the phrase's text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.llm.common import mix64, text_or_empty, tidy
from hoardline.operators.ranking import first_rows
from hoardline.session import cut_lineage, scratch_path

LONGEST = 4
LEAST = 30
SHARDS = 2
SLOT_BITS = 24  # one byte each: what a scan is sent, whatever the corpus
NEVER = 255
PAGE_BITS = 15  # slots of one of Spark's bitmaps
BLOCK_BYTES = 1 << 20
TOP = 2000
CONTAINED = (100, 80)  # a phrase goes if 100 times a longer one's count is at least 80 times its own
SCALE = 2_000_000
NO_LANG = "und"

# Bytes by class: 0 in words, 1 between words, 2 between pieces.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[0x09] = 0x20
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_MASK = (1 << 64) - 1


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as long as the longest block so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def until(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()

            def powers(base):
                out = np.full(size, base & _MASK, np.uint64)
                out[0] = 1
                return np.multiply.accumulate(out)

            self.up, self.down = powers(self.base), powers(self.inverse)
        return self.up, self.down


class Words:
    """The words of one block of bytes, all of one language.

    ``start`` and ``end`` are byte positions, ``piece`` numbers the pieces, ``sums`` are two independent 64-bit hashes of each word."""

    def __init__(self, raw: np.ndarray, seed: int, powers: list[Powers], ends: np.ndarray | None = None):
        kinds = _CLASS[raw]
        self.raw = _LOWER[raw]
        inside = kinds == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        breaks = kinds == 2
        if ends is not None and len(ends) > 1:  # texts that follow one another
            cuts = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(raw))]
            begins[cuts] |= inside[cuts]
        else:
            cuts = np.empty(0, np.int64)
        self.start = np.flatnonzero(begins)
        stops = ~inside
        closing = np.append(np.flatnonzero(stops | begins), len(raw))
        self.end = closing[np.searchsorted(closing, self.start, side="right")] if len(self.start) else self.start
        marks = np.zeros(len(raw), bool)
        marks[breaks] = True
        marks[cuts] = True
        self.piece = np.cumsum(marks, dtype=np.int64)[self.start]
        self.sums = []
        with np.errstate(over="ignore"):
            for salt, p in enumerate(powers):
                up, down = p.until(len(raw) + 1)
                running = np.zeros(len(raw) + 1, np.uint64)
                np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=running[1:])
                value = (running[self.end] - running[self.start]) * down[self.start]
                self.sums.append(mix64(value ^ np.uint64((seed * (2 * salt + 1)) & _MASK)))

    def grams(self, longest: int):
        """(n, first words, hashes) of the runs of 1 to ``longest`` words inside a piece."""
        at = np.arange(len(self.start))
        sums = self.sums
        yield 1, at, sums
        with np.errstate(over="ignore"):
            for n in range(2, longest + 1):
                same = self.piece[at[: len(at)]] == self.piece[np.minimum(at + n - 1, len(self.piece) - 1)]
                same &= at + n - 1 < len(self.piece)
                at = at[same]
                sums = [mix64(s[same] * np.uint64(0xD6E8FEB86659FD93) + w[at + n - 1]) for s, w in zip(sums, self.sums, strict=True)]
                yield n, at, sums

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        """The phrases of ``n`` words from the words ``first`` on, joined by single blanks."""
        if n == 1:
            starts, ends = self.start[first], self.end[first]
        else:
            starts, ends = self.start[first], self.end[first + n - 1]
        sizes = ends - starts
        stops = np.cumsum(sizes)
        spots = np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts - stops + sizes, sizes)
        data = self.raw[spots]
        plain = sum((self.end[first + i] - self.start[first + i] for i in range(n)), np.zeros(len(first), np.int64)) + n - 1
        if (plain == sizes).all():
            offsets = np.append(0, stops).astype(np.int32)
            return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
        whole, bounds = data.tobytes(), np.append(0, stops).tolist()
        return pa.array([b" ".join(x for x in whole[a:b].split(b" ") if x).decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.string())


def _slots(sums: list[np.ndarray], n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - bits)
    mixed = mix64(sums[0] + np.uint64(n))
    return (mixed >> shift).astype(np.int64), (mix64(mixed ^ sums[1]) >> shift).astype(np.int64)


def _reached(table: np.ndarray, sums: list[np.ndarray], n: int, bits: int) -> np.ndarray:
    """The step in which each phrase reached the threshold, ``NEVER`` where it has not."""
    first, second = _slots(sums, n, bits)
    return np.maximum(table[first], table[second])


def _counted(sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An example of each different hash pair and how often it occurs."""
    _, first, inverse, n = np.unique(sums[0], return_index=True, return_inverse=True, return_counts=True)
    if (sums[1] == sums[1][first][inverse]).all():
        return first, n
    pairs = np.rec.fromarrays(sums)
    _, first, n = np.unique(pairs, return_index=True, return_counts=True)
    return first, n


def _seed(lang: str) -> int:
    import zlib

    data = lang.encode()
    return (zlib.crc32(data) << 32 | zlib.adler32(data)) * _BASES[0] & _MASK


def _runs(batch: pa.RecordBatch):
    """(lang, bytes, ends of texts) in blocks of the texts of one language, long texts cut between pieces."""
    batch = batch.take(pa.compute.sort_indices(batch.column(0)))
    texts = batch.column(1)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
    langs = batch.column(0).to_pylist()
    start = 0
    while start < len(langs):
        stop = start + 1
        while stop < len(langs) and langs[stop] == langs[start] and offsets[stop + 1] - offsets[start] <= BLOCK_BYTES:
            stop += 1
        begin, end = offsets[start], offsets[stop]
        if stop == start + 1 and end - begin > BLOCK_BYTES:
            breaks = np.flatnonzero(_CLASS[data[begin:end]] == 2) + begin
            while end - begin > BLOCK_BYTES:
                at = np.searchsorted(breaks, begin + BLOCK_BYTES, side="right")
                if not len(breaks) or at == 0 or breaks[at - 1] <= begin:
                    if at >= len(breaks):
                        break
                    cut = breaks[at]
                else:
                    cut = breaks[at - 1]
                yield langs[start], data[begin:cut], None
                begin = cut
            yield langs[start], data[begin:end], None
        else:
            yield langs[start], data[begin:end], offsets[start + 1 : stop + 1] - begin
        start = stop


COUNT_SCHEMA = "lang string, n int, phrase string, since int, rows long"


def _scan(shard: DataFrame, step: int, shards: int, table, bits: int, longest: int) -> DataFrame:
    """Counts of all phrases that are active in this step, by task; ``since`` is the step from which a phrase is counted."""

    def run(batches):
        powers = [Powers(b) for b in _BASES]
        first_steps = table.value
        for batch in batches:
            for lang, raw, ends in _runs(batch):
                words = Words(raw, _seed(lang), powers, ends)
                if not len(words.start):
                    continue
                before = None  # (first words, steps) of the runs that are one word shorter
                for n, at, sums in words.grams(longest):
                    if n == 1:
                        chosen, since = (slice(None), np.zeros(len(at), np.int64)) if step < shards else (None, None)
                    else:
                        steps = np.full(len(words.start), NEVER, np.uint8)
                        steps[before[0]] = before[1]
                        since = np.maximum(steps[at], steps[at + 1]).astype(np.int64) + 1
                        chosen = np.flatnonzero((since <= step) & (since > step - shards))
                    if chosen is not None:
                        picked, pairs = at[chosen], [s[chosen] for s in sums]
                        since = since[chosen]
                        if len(picked):
                            first, rows = _counted(pairs)
                            phrases = words.texts(picked[first], n)
                            size = len(first)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([lang] * size, pa.string()), pa.array(np.full(size, n, np.int32)), phrases, pa.array(since[first].astype(np.int32)), pa.array(rows.astype(np.int64))],
                                ["lang", "n", "phrase", "since", "rows"],
                            )
                    if n < longest:
                        before = (at, _reached(first_steps, sums, n, bits))
                        open_ones = before[1] != NEVER
                        if not open_ones.any():
                            break

    return shard.mapInArrow(tidy(run), COUNT_SCHEMA)


def _slots_of(phrases: DataFrame, bits: int) -> DataFrame:
    """The slots of ``lang, n, phrase`` as ``page, marks``: a bitmap for each page of 2**``PAGE_BITS`` slots that has some."""

    def run(batches):
        powers = [Powers(b) for b in _BASES]
        for batch in batches:
            langs, sizes, texts = (batch.column(i).to_pylist() for i in range(3))
            by: dict[tuple, list[bytes]] = {}
            for lang, n, text in zip(langs, sizes, texts, strict=True):
                by.setdefault((lang, n), []).append(text.encode())
            for (lang, n), some in by.items():
                words = Words(np.frombuffer(b".".join(some), np.uint8), _seed(lang), powers)
                for m, _, sums in words.grams(n):
                    if m == n:
                        slots = np.unique(np.concatenate(_slots(sums, n, bits)))
                        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32))], ["slot"])

    slots = phrases.select("lang", "n", "phrase").mapInArrow(run, "slot int")
    paged = slots.select(F.shiftright("slot", PAGE_BITS).alias("page"), (F.col("slot") % (1 << PAGE_BITS)).cast("long").alias("place"))
    return paged.repartition("page").groupBy("page").agg(F.bitmap_construct_agg("place").alias("marks"))


def _mark(table: np.ndarray, pages, step: int) -> None:
    """Set the slots that ``pages`` mark to ``step`` where they have no step yet."""
    for page, marks in pages:
        part = table[page << PAGE_BITS : (page + 1) << PAGE_BITS]
        marked = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(part), bitorder="little").view(bool)
        part[marked & (part == NEVER)] = step


def frequent(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, bits: int = SLOT_BITS, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang"
) -> tuple[DataFrame, DataFrame]:
    """``lang, n, phrase, rows`` of all phrases of up to ``longest`` words that occur ``least`` times in their language, and
    ``lang, rows`` with the words of each language.

    Null texts are empty, a null language is ``und``; repeated rows count; other columns are ignored. Only table slots reach the
    driver, one bit each: at most 2**``bits`` bits a step. Steps end when no phrase is left that has not seen every shard."""
    spark = documents.sparkSession
    key = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.col(text_column)), F.lit(shards))
    narrow = documents.select(F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANG)).alias("lang"), text_or_empty(text_column).alias("text"), key.alias("shard"))
    path = scratch_path(spark, "phrase-shards")
    narrow.where("text <> ''").write.partitionBy("shard").parquet(path)
    stored = spark.read.schema("lang string, text string, shard long").parquet(path)
    firsts = np.full(1 << bits, NEVER, np.uint8)
    state, finished, totals = None, [], []
    step, busy_until = 0, shards - 1
    while step <= busy_until:
        table = spark.sparkContext.broadcast(firsts)  # of fixed size
        scanned = _scan(stored.where(F.col("shard") == step % shards).select("lang", "text"), step, shards, table, bits, longest)
        scanned = scanned.withColumn("reached", F.lit(None).cast("int"))
        both = scanned if state is None else state.unionByName(scanned)
        # A phrase has one ``since``: it follows from slots that no longer change.
        added = both.groupBy("lang", "n", "phrase").agg(F.min("since").alias("since"), F.sum("rows").alias("rows"), F.min("reached").alias("reached"))
        now = F.when(F.col("reached").isNull() & (F.col("rows") >= least), F.lit(step)).otherwise(F.col("reached"))
        added = cut_lineage(added.withColumn("reached", now), "phrase-counts")
        done = F.col("since") + shards - 1 <= step
        finished.append(added.where(done & (F.col("rows") >= least)).select("lang", "n", "phrase", "rows"))
        if step == shards - 1:
            totals.append(added.where("n = 1"))
        fresh = added.where((F.col("reached") == step) & (F.col("n") < longest))
        pages = _slots_of(fresh, bits).collect()
        _mark(firsts, pages, step)
        if pages:
            busy_until = max(busy_until, step + shards)
        state = added.where(~done)
        table.destroy()  # its counts are stored
        step += 1
        if step >= NEVER:
            raise ValueError("too many shards for one-byte steps")
    whole = finished[0]
    for more in finished[1:]:
        whole = whole.unionByName(more)
    return cut_lineage(whole, "phrases-frequent"), totals[0].groupBy("lang").agg(F.sum("rows").alias("words"))


def _words(phrase: str | Column) -> Column:
    return F.split(phrase, " ")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language by score, count and phrase.

    A phrase's score is that of its weakest cut, floor(2,000,000 a / (l + r)). Phrases go that lie inside a longer one with at least 0.8
    of their count, whether that one stays or not. Products are decimals of 38 digits. See :func:`frequent` for nulls,
    repeated rows and other columns; an empty table gives no rows."""
    counted, words = frequent(documents, least, **options)
    long = counted.where("n > 1")
    big = lambda c: F.col(c).cast("decimal(20,0)")
    # Longer phrases name the shorter ones inside them.
    w = _words("phrase")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.col("n") - size + 1), lambda at: F.array_join(F.slice(w, at, size), " "))))
    covering = long.where("n > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("rows").alias("longer"))
    covering = covering.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    more, less = CONTAINED
    free = long.join(covering, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(more).cast("decimal(5,0)") * big("longer") < F.lit(less).cast("decimal(5,0)") * big("rows"))
    )
    cuts = free.select("lang", "phrase", "rows", "n", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", F.col("rows").alias("a"), "k", F.array_join(F.slice(w, F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice(w, F.col("k") + 1, F.col("n")), " ").alias("tail")
    )
    left = counted.select(F.col("lang"), F.col("phrase").alias("head"), F.col("rows").alias("l"))
    right = counted.select(F.col("lang"), F.col("phrase").alias("tail"), F.col("rows").alias("r"))
    scored = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
    scored = scored.withColumn("score", F.expr(f"CAST(CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS LONG)"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("w")).select("lang", "phrase", "w.score", "w.a", "w.l", "w.r")
    ranked = first_rows(weakest, top, by=["lang"], order=[F.desc("score"), F.desc("a"), F.col("phrase")])
    totals = words.withColumnRenamed("words", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
