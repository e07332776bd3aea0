"""Toxicity by a factorization machine over hashed terms.

The score of a text is ``sigmoid(bias + sum of term weights + sum over term pairs of <v_a, v_b>)``: besides its own weight,
each term has a short vector, so that two terms which are harmless alone count when they meet. Terms are the distinct
words of the lower-cased text and their beginnings, hashed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.llm.common import by_batch, list_parts, mix64, text_or_empty, tidy
from hoardline.session import cut_lineage

BITS = 18
BLOCK_BYTES = 1 << 20
PREFIXES = (4, 5, 6)
_WORD_BYTE = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
_POWERS = np.cumprod(np.full(1 << 16, 0x100000001B3, dtype=np.uint64))


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows that the model is fitted on; scoring covers every row.
    Every term in ``least_texts`` of them or more gets a weight and factors, whatever it tells alone: what counts only in pairs is not seen
    in single terms. ``least_chi`` above zero leaves out terms with a smaller chi-square statistic."""

    sample_rows: int = 12_000
    least_texts: int = 3
    least_chi: float = 0.0
    factors: int = 8
    steps: int = 4_000
    batch: int = 64
    rate: float = 0.02
    pull: float = 1.5
    linear_decay: float = 1e-4
    factor_decay: float = 1e-3
    seed: int = 11


def hashed_terms(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms per text as (terms, offsets) from UTF-8 bytes; text i is ``data[offsets[i]:offsets[i + 1]]``.
    ``wanted`` marks the terms that matter, if not all do.
    A word is a run of letters, digits and bytes above 127; a very long one counts by its first 65,536 bytes and its length."""
    inside = _WORD_BYTE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = inside[cuts]  # words end with their text
    at = np.flatnonzero(begins)
    texts = len(offsets) - 1
    if not len(at):
        return np.empty(0, np.int64), np.zeros(texts + 1, np.int64)
    spots = np.flatnonzero(inside)
    word = np.cumsum(begins[spots]) - 1
    place = spots - at[word]
    first = np.searchsorted(spots, at)
    value = (data[spots].astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(place, len(_POWERS) - 1)]
    length = np.diff(np.append(first, len(spots)))
    hashes = [np.add.reduceat(value, first) ^ (length.astype(np.uint64) << np.uint64(40))]
    owner = np.searchsorted(offsets, at, side="right") - 1
    owners = [owner]
    for n in PREFIXES:
        longer = length > n
        part = np.add.reduceat(np.where(place < n, value, np.uint64(0)), first)
        hashes.append(part[longer] + np.uint64(n << 48))
        owners.append(owner[longer])
    term = (mix64(np.concatenate(hashes)) & np.uint64((1 << BITS) - 1)).astype(np.int64)
    owner = np.concatenate(owners).astype(np.int64)
    if wanted is not None:
        kept = wanted[term]
        owner, term = owner[kept], term[kept]
    keys = np.unique((owner << BITS) | term)
    return keys & ((1 << BITS) - 1), np.searchsorted(keys >> BITS, np.arange(texts + 1))


def blocks(column: pa.Array):
    """(first row, bytes, offsets) of runs of rows with about ``BLOCK_BYTES``; a longer text is a block of its own."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1)
        stop = min(stop, len(column))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # per hashed term; zero for terms without a weight
    factors: np.ndarray  # per hashed term

    def margin(self, terms: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        owner = np.repeat(np.arange(n), np.diff(offsets))
        out = self.bias + np.bincount(owner, self.weights[terms], minlength=n)
        v = self.factors[terms]
        for f in range(v.shape[1]):
            total = np.bincount(owner, v[:, f], minlength=n)
            out += 0.5 * (total**2 - np.bincount(owner, v[:, f].astype(np.float64) ** 2, minlength=n))
        return out

    @property
    def wanted(self) -> np.ndarray:
        return self.weights != 0

    def score(self, terms: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(terms, offsets), -30, 30)))


def _trained(terms: np.ndarray, owner: np.ndarray, labels: np.ndarray, s: Settings) -> np.ndarray:
    """The terms that get weights, in order."""
    size = 1 << BITS
    seen, toxic = np.bincount(terms, minlength=size), np.bincount(terms, labels[owner], minlength=size)
    n, p = len(labels), labels.mean()
    spread = np.maximum(seen * (1 - seen / n) * p * (1 - p), 1e-12)
    chi = np.where(seen >= s.least_texts, (toxic - seen * p) ** 2 / spread, -1.0)
    return np.flatnonzero(chi >= max(s.least_chi, 0.0))


def _descend(params: np.ndarray, bias: float, local: np.ndarray, starts: np.ndarray, labels: np.ndarray, steps: range, shrink: float, s: Settings, rng) -> float:
    """Mini-batch Adam steps on ``params`` (a weight and factors per term) in place; gives the bias. With ``shrink``, each step also
    moves weights, and the factors of a term as a whole, towards zero, so that only those stay whose slope keeps its sign."""
    n, width = len(labels), params.shape[1]
    first, second, slope, room = (np.zeros_like(params) for _ in range(4))
    decay = np.array([s.linear_decay] + [s.factor_decay] * s.factors, np.float32)
    columns = np.arange(width)
    order = rng.permutation(n)
    for number, step in enumerate(steps, 1):
        at = (number - 1) * s.batch % n
        rows = order[at : at + s.batch]
        if at + s.batch >= n:
            order = rng.permutation(n)
        counts = starts[rows + 1] - starts[rows]
        group = np.repeat(np.arange(len(rows)), counts)
        spot = np.arange(counts.sum()) + np.repeat(starts[rows] - np.cumsum(counts) + counts, counts)
        feature = local[spot]
        value = params[feature]
        sums = np.stack([np.bincount(group, value[:, c], minlength=len(rows)) for c in columns], 1).astype(np.float32)
        squares = np.bincount(group, (value[:, 1:] ** 2).sum(1), minlength=len(rows))
        margin = bias + sums[:, 0] + 0.5 * ((sums[:, 1:] ** 2).sum(1) - squares)
        error = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[rows]) / len(rows)).astype(np.float32)
        push = sums[group] - value
        push[:, 0] = 1
        push *= error[group][:, None]
        np.multiply(params, decay, out=slope)
        np.add.at(slope.reshape(-1), (feature[:, None] * width + columns).ravel(), push.ravel())
        first *= np.float32(0.9)
        np.multiply(slope, np.float32(0.1), out=room)
        first += room
        second *= np.float32(0.999)
        np.square(slope, out=room)
        room *= np.float32(0.001)
        second += room
        rate = s.rate * (1 - step / (s.steps + 1))
        np.sqrt(second, out=room)
        room *= np.float32((1 - 0.999**number) ** -0.5)
        room += np.float32(1e-8)
        np.divide(first, room, out=room)
        room *= np.float32(rate / (1 - 0.9**number))
        params -= room
        if shrink:
            less = np.float32(rate * shrink)
            weight, pairs = params[:, 0], params[:, 1:]
            weight -= np.clip(weight, -less, less)
            norm = np.sqrt(np.einsum("ij,ij->i", pairs, pairs))
            pairs *= np.maximum(1 - less * np.float32(np.sqrt(s.factors)) / np.maximum(norm, np.float32(1e-9)), 0)[:, None]
        bias -= rate * error.sum() * 5
    return float(bias)


def fit(terms: np.ndarray, offsets: np.ndarray, labels: np.ndarray, s: Settings) -> Machine:
    """Mini-batch training with the Adam rule on the logistic loss; the order of rows and the start come from the seed.

    All terms are trained together, weights and factors, under a pull to zero of ``pull`` standard deviations of a pass over the rows. What it
    has put to zero after half of the steps tells nothing there, alone or in a pair; the second half goes on with the others."""
    size, n = 1 << BITS, len(labels)
    weights, factors = np.zeros(size, np.float32), np.zeros((size, s.factors), np.float32)
    p = labels.mean() if n else 0.0
    if not 0 < p < 1:
        return Machine(float(np.clip(np.log((p + 1e-3) / (1 - p + 1e-3)), -6, 6)), weights, factors)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    chosen = _trained(terms, owner, labels, s)
    rng = np.random.default_rng(s.seed)
    bias, params = float(np.log(p / (1 - p))), None
    shrink = s.pull / np.sqrt(max(n / s.batch, 1.0))
    for steps in (range(1, s.steps // 2 + 1), range(s.steps // 2 + 1, s.steps + 1)):
        index = np.full(size, -1)
        index[chosen] = np.arange(len(chosen))
        used = index[terms] >= 0
        local, starts = index[terms[used]], np.searchsorted(owner[used], np.arange(n + 1))
        if params is None:  # the start of long texts is as quiet as that of short ones
            spread = min(0.02, 0.1 / np.sqrt(max(len(local) / n, 1.0)))
            params = np.concatenate([np.zeros((len(chosen), 1)), rng.normal(0, spread, (len(chosen), s.factors))], axis=1).astype(np.float32)
        bias = _descend(params, bias, local, starts, labels, steps, shrink, s, rng)
        some = params.any(axis=1)
        chosen, params = chosen[some], params[some]
    weights[chosen] = np.where(params[:, 0] == 0, 1e-9, params[:, 0])
    factors[chosen] = params[:, 1:]
    return Machine(bias, weights, factors)


def held_out(id_column: Column) -> Column:
    """Whether a document is kept out of training."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


def _terms_column(documents: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the distinct terms of ``text``."""
    schema = ", ".join(f"{c} {dict(documents.dtypes)[c]}" for c in columns) + ", terms array<int>"

    def one(batch):
        column, found = batch.column("text"), []
        for _, data, offsets in blocks(column):
            terms, cuts = hashed_terms(data, offsets)
            found += [terms[a:b].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        arrays = [batch.column(c) for c in columns] + [pa.array(found, pa.list_(pa.int32()))]
        return pa.RecordBatch.from_arrays(arrays, [*columns, "terms"])

    return documents.mapInArrow(tidy(by_batch(one)), schema)


def _prepared(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return documents.select(F.col(id_column).cast("long").alias("doc_id"), F.lower(text_or_empty(text_column)).cast("binary").alias("text"))


def train(documents: DataFrame, labels: DataFrame, settings: Settings | None = None, id_column: str = "doc_id", text_column: str = "text") -> Machine:
    """A machine fitted on at most ``sample_rows`` of the labelled documents outside the held-out fifth.

    The sample is taken by a hash of the id, so reruns agree. An id labelled twice counts as toxic if one label
    says so; null labels and ids are left out. Without both classes the machine answers the share of toxic labels."""
    s = settings or Settings()
    known = labels.where(F.col("toxic").isNotNull() & F.col(id_column).isNotNull() & ~held_out(F.col(id_column)))
    known = known.groupBy(F.col(id_column).cast("long").alias("_id")).agg((F.max("toxic") > 0).cast("double").alias("toxic"))
    count = known.count()
    share = int(min(1.0, 0.97 * s.sample_rows / max(count, 1)) * (1 << 30))
    sample = known.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < share).limit(s.sample_rows)
    sample = cut_lineage(sample, "toxicity-sample")
    texts = _prepared(documents, id_column, text_column).join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    rows = _terms_column(texts.select("doc_id", "toxic", "text"), ["doc_id", "toxic"])

    def fit_all(batches):
        ids, labels_, parts = [], [], []
        for batch in batches:
            ids.append(batch.column("doc_id").to_numpy())
            labels_.append(batch.column("toxic").to_numpy())
            values, offsets = list_parts(batch.column("terms"))
            parts += [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        ids = np.concatenate(ids) if ids else np.empty(0, np.int64)
        order = np.lexsort((np.array([len(p) for p in parts]), ids))  # whatever way the rows came
        terms = np.concatenate([parts[i] for i in order]).astype(np.int64) if parts else np.empty(0, np.int64)
        offsets = np.append(0, np.cumsum([len(parts[i]) for i in order])).astype(np.int64)
        toxic = np.concatenate(labels_)[order] if labels_ else np.empty(0)
        machine = fit(terms, offsets, toxic, s)
        used = np.flatnonzero(machine.wanted)
        parts = [a.tobytes() for a in (used.astype(np.int32), machine.weights[used], machine.factors[used])]
        yield pa.RecordBatch.from_arrays([pa.array([machine.bias]), *(pa.array([p], pa.binary()) for p in parts)], ["bias", "terms", "weights", "factors"])

    fitted = rows.coalesce(1) if rows.rdd.getNumPartitions() == 1 else rows.repartition(1)
    row = fitted.mapInArrow(tidy(fit_all), "bias double, terms binary, weights binary, factors binary").first()
    machine = Machine(row.bias, np.zeros(1 << BITS, np.float32), np.zeros((1 << BITS, s.factors), np.float32))
    used = np.frombuffer(row.terms, np.int32)
    machine.weights[used] = np.frombuffer(row.weights, np.float32)
    machine.factors[used] = np.frombuffer(row.factors, np.float32).reshape(len(used), s.factors)
    return machine


def with_scores(rows: DataFrame, machine: Machine, text_column: str) -> DataFrame:
    """``rows`` with ``score``, from the lower-cased text in bytes in ``text_column``; nothing but that column is looked at."""
    columns = [f for f in rows.schema if f.name != "score"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in columns), "score double"])
    used = np.flatnonzero(machine.wanted)
    compact = (machine.bias, used, machine.weights[used], machine.factors[used])  # what tasks get: a row per used term

    def run(batches):
        bias, terms, weights, factors = compact
        own = Machine(bias, np.zeros(1 << BITS, np.float32), np.zeros((1 << BITS, factors.shape[1]), np.float32))
        own.weights[terms], own.factors[terms] = weights, factors
        wanted = own.wanted

        def one(batch):
            out = np.empty(batch.num_rows)
            for row, data, offsets in blocks(batch.column(text_column)):
                out[row : row + len(offsets) - 1] = own.score(*hashed_terms(data, offsets, wanted))
            names = [f.name for f in columns]
            return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out)], [*names, "score"])

        yield from by_batch(one)(batches)

    return rows.select(*[f.name for f in columns]).mapInArrow(tidy(run), schema)


def accepted(documents: DataFrame, machine: Machine, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that are not toxic, with all of their columns."""
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(documents.columns)]
    rows = documents.select(*columns, F.lower(text_or_empty(text_column)).cast("binary").alias("lowered"))
    kept = with_scores(rows, machine, "lowered").where(F.col("score") < threshold)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)])


def score(documents: DataFrame, machine: Machine, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; only the text is looked at. Null and empty texts get the
    score of a text without terms; a null id is not held out. Repeated rows get equal scores, and other columns are ignored."""
    scored = with_scores(_prepared(documents, id_column, text_column), machine, "text").drop("text")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
