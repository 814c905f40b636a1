"""Fixed-size bitmaps of 64-bit hashes, built by Spark and small enough to broadcast at any size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """2**bits flags; the flag of a hash is named by its first `bits` bits."""
    spot = f"shiftrightunsigned(`{column}`, {64 - bits})"
    rows = (
        df.where(f"`{column}` is not null")
        .selectExpr(f"shiftright({spot}, 6) as word", f"shiftleft(1L, cast({spot} & 63 as int)) as bit")
        .groupBy("word")
        .agg({"bit": "bit_or"})
        .toDF("word", "flags")
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[rows.column("word").to_numpy()] = rows.column("flags").to_numpy()
    return out.view(np.uint64)


def member(flags: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether each hash's flag is set: always for members, now and then for others."""
    spot = value.view(np.uint64) >> np.uint64(64 - int(len(flags) * 64).bit_length() + 1)
    return ((flags[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1)).astype(bool)
