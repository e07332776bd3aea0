"""Exact removal of repeated passages with suffix arrays built by induced sorting.

Every window of ``LENGTH`` bytes has a key, the least hash among its shorter grams, so equal windows share their key wherever
they are. Windows with one key that follow one another in a text form a stretch. Keys with a single stretch are done;
keys whose stretches are all equal are repeats as a whole; the different stretches of all other keys go to
shards by key. A shard concatenates its stretches, sorts their suffixes, and marks each window whose common prefix with a
neighbour in the suffix array is long enough.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.llm.common import binary_values, by_batch, mix64, row_key, text_or_empty
from hoardline.session import cut_lineage

LENGTH = 400
GRAM_SHARE = 0.64  # of the window length
SHARD_BYTES = 1 << 20
VARIANTS = 50_000  # different stretches of one key that a shard takes; windows of more are grouped by digest
PIECE = 1 << 20  # windows of a text looked at together
_BASE = 0x9E3779B97F4A7C15


# ---- induced sorting ------------------------------------------------------------------------------------------------


def suffix_array(symbols, alphabet: int) -> np.ndarray:
    """The suffixes of ``symbols`` in order; they end with their only 0 and are below ``alphabet``."""
    s = np.asarray(symbols, np.int32)
    n = len(s)
    if n < 3:
        return np.arange(n - 1, -1, -1, dtype=np.int32)
    # A suffix is smaller than the next one if its first character that differs from the one behind it is smaller.
    turn = np.sign(s[1:] - s[:-1])
    differs = np.where(turn != 0, np.arange(n - 1), n)
    next_turn = np.minimum.accumulate(differs[::-1])[::-1]
    smaller = np.append(turn[next_turn] > 0, True)
    leftmost = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    sizes = np.bincount(s, minlength=alphabet)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    induced = _induced_by_buckets if _bucket_passes(s, sizes) * 32 < n else _induced_by_steps
    order = induced(s, smaller, leftmost, starts, ends)
    # Name the substrings between leftmost-smaller positions in their order.
    chosen = np.zeros(n, bool)
    chosen[leftmost] = True
    stop, names = np.zeros(n, np.int32), np.zeros(n, np.int32)
    stop[leftmost] = np.append(leftmost[1:], n - 1) + 1
    places = order[chosen[order]]
    names[places] = np.cumsum(_differs_from_last(s, places, stop[places] - places))
    name = int(names[places[-1]])
    reduced = names[leftmost]
    if name + 1 == len(leftmost):
        ranked = np.empty(len(leftmost), np.int32)
        ranked[reduced] = np.arange(len(leftmost))
    else:
        ranked = suffix_array(reduced, name + 1)
    return induced(s, smaller, leftmost[ranked], starts, ends)


def _bucket_passes(s: np.ndarray, sizes: np.ndarray) -> int:
    """An upper bound of the array passes that sorting by buckets takes: one for each symbol and each place in its longest run."""
    edges = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    longest = np.zeros(len(sizes), np.int64)
    np.maximum.at(longest, s[edges], np.diff(np.append(edges, len(s))))
    return len(sizes) + int(longest.sum())


def _differs_from_last(s: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether each substring (place, size) has other symbols than the one before it; False for the first."""
    other = np.append(False, sizes[1:] != sizes[:-1])
    same = np.flatnonzero(~other)[1:]
    if len(same):
        length = sizes[same].astype(np.int64)
        begins = np.cumsum(length) - length
        inside = np.arange(int(length.sum())) - np.repeat(begins, length)
        unlike = s[np.repeat(places[same], length) + inside] != s[np.repeat(places[same - 1], length) + inside]
        other[same] = np.logical_or.reduceat(unlike, begins)
    return other


def _induced_by_buckets(s, smaller, seeds, starts, ends) -> np.ndarray:
    """All suffixes, ordered as far as the order of ``seeds`` tells: larger ones from the left, then smaller ones from the right.
    Each bucket is read in a few passes, for runs of its own symbol add to it while it is read."""
    alphabet, sa = len(starts), np.empty(len(s), np.int32)
    symbols = s.astype(np.uint16) if alphabet <= 1 << 16 else s  # short numbers are sorted by radix

    def dealt(places):
        """Places by symbol, in their order within one; each one's rank there; the symbols' counts."""
        of = symbols[places]
        order = np.argsort(of, kind="stable")
        counts = np.bincount(of, minlength=alphabet)
        return places[order], of[order], np.arange(len(places)) - np.repeat(np.cumsum(counts) - counts, counts), counts

    placed, of, rank, counts = dealt(seeds)
    first_seed = ends - counts
    sa[first_seed[of] + rank] = placed
    head, tail = starts.copy(), ends.copy()
    used = np.flatnonzero(ends > starts).tolist()

    def larger(read):
        before = read[read > 0] - 1
        placed, of, rank, counts = dealt(before[~smaller[before]])
        sa[head[of] + rank] = placed
        np.add(head, counts, out=head)

    for c in used:
        done = starts[c]
        while done < head[c]:
            done, read = head[c], sa[done : head[c]]
            larger(read)
        if first_seed[c] < ends[c]:
            larger(sa[first_seed[c] : ends[c]])

    def lesser(read):
        before = read[::-1]
        before = before[before > 0] - 1
        placed, of, rank, counts = dealt(before[smaller[before]])
        sa[tail[of] - 1 - rank] = placed
        np.subtract(tail, counts, out=tail)

    for c in reversed(used):
        done = ends[c]
        while done > tail[c]:
            done, read = tail[c], sa[tail[c] : done]
            lesser(read)
        if starts[c] < head[c]:
            lesser(sa[starts[c] : head[c]])
    return sa


def _induced_by_steps(s, smaller, seeds, starts, ends) -> np.ndarray:
    """The same, suffix by suffix: for alphabets or runs that are long beside the text."""
    sa = [-1] * len(s)
    tail, symbols = ends.tolist(), s.tolist()
    for i in reversed(seeds.tolist()):
        c = symbols[i]
        tail[c] -= 1
        sa[tail[c]] = i
    # By place: the symbol before it if a larger, or a smaller, suffix starts there; else -1, also for place -1.
    nothing = np.full(1, -1, np.int32)
    to_right = np.concatenate([nothing, np.where(smaller, -1, s)[:-1], nothing]).tolist()
    to_left = np.concatenate([nothing, np.where(smaller, s, -1)[:-1], nothing]).tolist()
    head = starts.tolist()
    for i in sa:  # grows to the right of the reader
        c = to_right[i]
        if c >= 0:
            sa[head[c]] = i - 1
            head[c] += 1
    tail = ends.tolist()
    for i in reversed(sa):  # grows to the left of the reader
        c = to_left[i]
        if c >= 0:
            tail[c] -= 1
            sa[tail[c]] = i - 1
    return np.array(sa, np.int32)


def common_prefixes(symbols, sa: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """In text order: the suffix before each suffix in the array (-1 for the first), and the length of their common prefix,
    counted up to ``limit``.

    Where a suffix and its neighbour both follow on the last ones and those began alike, their prefix is the last one without its
    first symbol; so symbols are compared only at the end of each such run."""
    s = np.asarray(symbols, np.int32)
    n = len(s)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    alike = (before >= 0) & (s == s[before])
    follows = alike[:-1] & (before[1:] == before[:-1] + 1)
    last = np.flatnonzero(np.append(~follows, True))
    # Four symbols in a number, so that four are compared at once; the text ends with its only 0, so no prefix passes it.
    padded = np.append(s, np.zeros(limit + 8, np.int32)).astype(np.uint64)
    fours = padded[:-3] | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(32) | padded[3:] << np.uint64(48)
    tail = np.zeros(len(last), np.int64)
    open_ = np.flatnonzero(alike[last])
    for done in range(0, limit, 4):
        if not len(open_):
            break
        apart = fours[last[open_] + done] ^ fours[before[last[open_]] + done]
        same = sum(((apart & np.uint64((1 << 16 * k) - 1)) == 0).astype(np.int64) for k in (1, 2, 3)) + (apart == 0)
        tail[open_] = done + same
        open_ = open_[same == 4]
    reach = np.repeat(last + tail, np.diff(np.append(-1, last)))
    return before, np.minimum(reach - np.arange(n), limit)


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Per text, a mark for each of its windows that also starts anywhere else in ``texts``."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    offsets = (np.cumsum(sizes) - sizes).tolist()
    symbols = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.int64) + 2
    symbols[np.cumsum(sizes) - 1] = 1  # between texts
    symbols = np.append(symbols, 0)  # the end
    room = np.zeros(len(symbols), bool)
    for start, text in zip(offsets, texts, strict=True):
        room[start : start + max(0, len(text) - length + 1)] = True
    before, lengths = common_prefixes(symbols, suffix_array(symbols, 258), length)
    hit = np.flatnonzero((lengths >= length) & room)
    marks = np.zeros(len(symbols), bool)
    marks[hit] = True
    marks[before[hit]] = True
    return [marks[a : a + max(0, len(t) - length + 1)] for a, t in zip(offsets, texts, strict=True)]


# ---- stretches of windows with one key --------------------------------------------------------------------------------


class Grams:
    """Hashes of all grams of a text and the stretches that its windows form."""

    def __init__(self, length: int):
        self.length = length
        self.gram = max(1, int(length * GRAM_SHARE))
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers))
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.append(np.uint64(1), np.full(size - 1, _BASE, np.uint64)))
                self.inverse = np.cumprod(np.append(np.uint64(1), np.full(size - 1, pow(_BASE, -1, 1 << 64), np.uint64)))

    def stretches(self, text: bytes) -> list[np.ndarray]:
        """key, first and last window, and a hash of the bytes of each stretch, in order."""
        windows = len(text) - self.length + 1
        parts = [self._piece(text[a : min(a + PIECE, windows) + self.length - 1], a) for a in range(0, max(windows, 0), PIECE)]
        return [np.concatenate(v) for v in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 4

    def _piece(self, text: bytes, base: int) -> tuple:
        data = np.frombuffer(text, np.uint8)
        n, grams, windows = len(data), len(data) - self.gram + 1, len(data) - self.length + 1
        span = self.length - self.gram + 1  # grams of a window
        self._grow(n + 1)
        low = np.uint64((1 << 24) - 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
            hashes = mix64((sums[self.gram :] - sums[: -self.gram]) * self.inverse[:grams])
            # The least hash of a window, the leftmost of equal ones: upper bits of the hash, then the place.
            placed = (hashes & ~low) | np.arange(grams, dtype=np.uint64)
            padded = np.append(placed, np.full(-grams % span, ~np.uint64(0))).reshape(-1, span)
            forward = np.minimum.accumulate(padded, 1).ravel()
            backward = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
            least = np.minimum(backward[:windows], forward[span - 1 : span - 1 + windows])
            first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
            last = np.append(first[1:], windows) - 1
            key = hashes[(least[first] & low).astype(np.int64)]
            body = mix64((sums[last + self.length] - sums[first]) * self.inverse[first]) ^ mix64((last - first).astype(np.uint64))
        return key.view(np.int64), first + base, last + base, body.view(np.int64)


def _stretches(source: DataFrame, length: int) -> DataFrame:
    def run(batches):
        grams = Grams(length)

        def one(batch):
            rows, parts = [], []
            for row, text in enumerate(binary_values(batch.column("text"))):
                if len(text) >= length:
                    found = grams.stretches(text)
                    parts.append(found)
                    rows.append(np.full(len(found[0]), row))
            owner = np.concatenate(rows) if rows else np.empty(0, np.int64)
            key, first, last, body = (np.concatenate(v) for v in zip(*parts, strict=True)) if parts else [np.empty(0, np.int64)] * 4
            arrays = [batch.column("row").take(pa.array(owner)), *(pa.array(v) for v in (key, first, last, body))]
            return pa.RecordBatch.from_arrays(arrays, ["row", "key", "first", "last", "body"])

        yield from by_batch(one)(batches)

    return source.mapInArrow(run, "row long, key long, first long, last long, body long")


def _ranges(marks: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [{"a": int(a), "b": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]


RANGES = "array<struct<a:long,b:long>>"


def repeated(source: DataFrame, length: int = LENGTH, variants: int = VARIANTS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``row, ranges``: for each key ``row`` of ``source`` (row, text as bytes) the first and last windows that also start elsewhere."""
    every = cut_lineage(_stretches(source, length), "suffix-stretches")
    keys = every.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.min("body").alias("_low"), F.max("body").alias("_high"))
    keys = keys.where("_n > 1").select("_key", (F.col("_low") != F.col("_high")).alias("mixed"))
    hits = cut_lineage(every.join(keys, F.col("key") == F.col("_key")).drop("_key"), "suffix-hits")
    whole = hits.where("NOT mixed").select("row", F.col("first").alias("a"), F.col("last").alias("b"))
    # One text for each different stretch of the other keys.
    different = hits.where("mixed").groupBy("key", "body").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "last")).alias("at"))
    wanted = different.select(F.col("at.row").alias("_row"), F.struct("key", "body", "n", "at.first", "at.last").alias("s"))
    wanted = wanted.groupBy("_row").agg(F.collect_list("s").alias("wanted"))  # stretches of one text
    carriers = source.join(wanted, F.col("row") == F.col("_row")).select("text", F.explode("wanted").alias("s"))
    cut = F.substring(F.col("text"), (F.col("s.first") + 1).cast("int"), (F.col("s.last") - F.col("s.first") + length).cast("int"))
    stretches = carriers.select("s.key", "s.body", "s.n", cut.alias("text")).dropDuplicates(["key", "body"])
    stretches = cut_lineage(stretches, "suffix-texts")
    many = stretches.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > variants).select("_key")
    few = stretches.join(many, F.col("key") == F.col("_key"), "left_anti")
    size = few.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))

    def shard(table):
        texts = binary_values(table.column("text"))
        marks = repeated_windows(texts, length)
        counts = table.column("n").to_pylist()
        found = [[{"a": 0, "b": len(m) - 1}] if n > 1 else _ranges(m) for m, n in zip(marks, counts, strict=True)]
        ranges = pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
        return pa.table({"key": table.column("key"), "body": table.column("body"), "ranges": ranges})

    dealt = few.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).repartition(shards, "shard")
    sorted_out = dealt.groupBy("shard").applyInArrow(shard, f"key long, body long, ranges {RANGES}")
    # Keys with very many different stretches: equal windows are found by digest, whatever their number.
    opened = stretches.join(many, F.col("key") == F.col("_key"), "left_semi").select(
        "key", "body", "n", "text", F.explode(F.sequence(F.lit(0), (F.octet_length("text") - length))).alias("o")
    )
    opened = opened.select("key", "body", "n", F.col("o").cast("long").alias("o"), F.sha2(F.substring(F.col("text"), F.col("o") + 1, F.lit(length)), 256).alias("w"))
    twice = opened.groupBy(F.col("w").alias("_w")).agg(F.sum("n").alias("_n")).where("_n > 1").select("_w")
    digested = opened.join(twice, F.col("w") == F.col("_w")).groupBy("key", "body").agg(F.collect_list(F.struct(F.col("o").alias("a"), F.col("o").alias("b"))).alias("ranges"))
    ranges = cut_lineage(sorted_out.unionByName(digested).where(F.size("ranges") > 0), "suffix-ranges")
    ranges = ranges.select(F.col("key").alias("_key"), F.col("body").alias("_body"), "ranges")
    mixed = hits.where("mixed").join(ranges, (F.col("key") == F.col("_key")) & (F.col("body") == F.col("_body")))
    parts = mixed.select("row", "first", F.explode("ranges").alias("r")).select("row", (F.col("first") + F.col("r.a")).alias("a"), (F.col("first") + F.col("r.b")).alias("b"))
    return whole.unionByName(parts).groupBy("row").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))


def without_repeats(documents: DataFrame, length: int = LENGTH, variants: int = VARIANTS, shard_bytes: int = SHARD_BYTES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, kept, removed``: every text as UTF-8 without the bytes covered by a window of ``length`` bytes that starts anywhere
    else too, and the removed spans (start, end exclusive) in bytes of the input.

    Matches never cross texts; null is an empty text; texts shorter than ``length`` stay whole; repeated rows are repeats of one
    another. What is kept need not be valid UTF-8 and is therefore binary. Other columns are ignored. Stretches of bytes count as
    equal if their 64-bit polynomial hashes are; the suffix arrays compare bytes."""
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).cast("binary").alias("text"))
    rows = rows.withColumn("row", row_key(rows, "doc_id", "text"))
    found = repeated(rows.select("row", "text"), length, variants, shard_bytes).withColumnRenamed("row", "_row")
    joined = rows.join(found, F.col("row") == F.col("_row"), "left").select("doc_id", "text", "ranges")
    schema = "doc_id long, n_bytes long, kept binary, removed array<struct<start:long,end:long>>"

    def one(batch):
        out = ([], [], [])
        for text, ranges in zip(binary_values(batch.column("text")), batch.column("ranges").to_pylist(), strict=True):
            spans: list[dict] = []
            for r in sorted(ranges or [], key=lambda r: r["a"]):
                end = r["b"] + length
                if spans and r["a"] <= spans[-1]["end"]:
                    spans[-1]["end"] = max(end, spans[-1]["end"])
                else:
                    spans.append({"start": r["a"], "end": end})
            edges = [0, *(e for s in spans for e in (s["start"], s["end"])), len(text)]
            out[0].append(len(text))
            out[1].append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            out[2].append(spans)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], kind)], ["doc_id", "n_bytes", "kept", "removed"])

    return joined.mapInArrow(by_batch(one), schema)


def digest(cleaned: DataFrame) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cleaned.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


