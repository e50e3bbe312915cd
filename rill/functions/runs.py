"""Runs of equal keys in sorted Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa


def key_changes(batch: pa.RecordBatch, keys: Sequence[str]) -> list[int]:
    """Places in a sorted batch where a new key starts, the first row left out."""
    changed = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
    for k in keys:
        codes = batch.column(k).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        changed |= codes[1:] != codes[:-1]
    return (np.flatnonzero(changed) + 1).tolist()


def runs_of(batch: pa.RecordBatch, keys: Sequence[str]) -> list[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) of each run of a sorted batch; a not-a-number key is the text ``NaN``."""
    cuts = [0, *key_changes(batch, keys), batch.num_rows] if batch.num_rows else []
    plain = lambda v: "NaN" if isinstance(v, float) and v != v else v
    return [
        (tuple(plain(batch.column(k)[lo].as_py()) for k in keys), batch.slice(lo, hi - lo))
        for lo, hi in zip(cuts[:-1], cuts[1:])
    ]
