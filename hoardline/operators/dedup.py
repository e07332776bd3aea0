"""Pair hashes, duplicate marking and picture hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions.text import blank_to_null
from hoardline.operators.ranking import or_unmatched

HASH_SIDE = 8
PICTURE_SIDE = 32


def pair_hash(a: Column, b: Column) -> Column:
    """Order-independent hash of two sides; one side alone stands for both, none is blank."""
    sides = F.array_sort(F.array_compact(F.array(blank_to_null(a), blank_to_null(b))))
    return F.array_join(sides, ":")


def mark_duplicates(pairs: DataFrame, hash_column: str = "pair_hash", key: str = "coin_id") -> DataFrame:
    """Flag all but the lowest id per hash and name that primary; blank hashes are never duplicates.

    The primary is a combinable minimum, joined back to the rows, so a hash shared by a large part of
    the table is never gathered.
    """
    filled = F.col(hash_column).isNotNull() & (F.col(hash_column) != "")
    primaries = (
        pairs.where(filled)
        .groupBy(F.col(hash_column).alias("_hash"))
        .agg(F.min(key).alias("_primary"))
    )
    duplicate = F.coalesce(F.col("_primary") != F.col(key), F.lit(False))
    return (
        pairs.withColumn("_lookup", or_unmatched(F.col(hash_column), filled, key))
        .join(primaries, F.col("_lookup") == F.col("_hash"), "left")
        .withColumns(
            {
                "is_duplicate": duplicate,
                "duplicate_of_coin_id": F.when(duplicate, F.col("_primary")),
            }
        )
        .drop("_lookup", "_hash", "_primary")
    )


def primary_of_hash(hashes: DataFrame, pairs: DataFrame, hash_column: str = "pair_hash") -> DataFrame:
    """For each non-blank hash, the lowest non-duplicate coin that already carries it."""
    known = (
        pairs.where((F.col("is_duplicate") == 0) & (F.col(hash_column) != ""))
        .groupBy(F.col(hash_column).alias("_hash"))
        .agg(F.min("coin_id").alias("existing_coin_id"))
    )
    return hashes.join(known, F.col(hash_column) == F.col("_hash"), "left").drop("_hash")


def new_by_hash(rows: DataFrame, target: DataFrame, hash_column: str, key: str) -> DataFrame:
    """Rows to insert under a unique hash: unknown to ``target``, lowest key per hash.

    Rows with a blank or missing hash are always inserted.
    """
    blank = F.coalesce(F.col(hash_column), F.lit("")) == ""
    hashed = rows.where(~blank)
    known = target.select(F.col(hash_column).alias("_known"))
    fresh = hashed.join(known, F.col(hash_column) == F.col("_known"), "left_anti")
    lowest = fresh.groupBy(F.col(hash_column).alias("_hash")).agg(F.min(key).alias("_key"))
    first = fresh.join(
        lowest, (F.col(hash_column) == F.col("_hash")) & (F.col(key) == F.col("_key")), "left_semi"
    )
    return first.unionByName(rows.where(blank))


def content_hash(files: DataFrame) -> DataFrame:
    """MD5 of whole files read with the ``binaryFile`` source."""
    return files.select("path", F.md5("content").alias("image_hash"))


def _cosine_basis(side: int) -> np.ndarray:
    """Orthonormal DCT-II matrix."""
    k = np.arange(side)[:, None]
    basis = np.cos(np.pi * (2 * np.arange(side)[None, :] + 1) * k / (2 * side)) * np.sqrt(2 / side)
    basis[0] /= np.sqrt(2)
    return basis


def perceptual_hash(pixels: Column) -> Column:
    """64-bit hex hash of a 32x32 luminance array: low frequencies above their median. Null for an array of another size, or none."""

    @F.pandas_udf("string")
    def hashed(batch: pd.Series) -> pd.Series:
        basis = _cosine_basis(PICTURE_SIDE)[:HASH_SIDE]
        out = pd.Series([None] * len(batch), dtype=object)
        whole = np.flatnonzero([p is not None and len(p) == PICTURE_SIDE**2 for p in batch])
        if len(whole):
            images = np.stack(batch.iloc[whole].to_numpy()).astype(np.float64)
            images = images.reshape(-1, PICTURE_SIDE, PICTURE_SIDE)
            low = (basis @ images @ basis.T).reshape(len(whole), -1)
            bits = low > np.median(low, axis=1, keepdims=True)
            out.iloc[whole] = [row.tobytes().hex() for row in np.packbits(bits, axis=1)]
        return out

    return hashed(pixels)
