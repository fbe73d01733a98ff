"""Windows and batches over arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_tokens(tokens: Column, size: int, overlap: int) -> Column:
    """Windows of `size` tokens, `overlap` of them shared with the one before; the last covers the end."""
    overlap = max(0, min(overlap, size - 1))
    step = max(1, size - overlap)
    last = F.greatest(F.lit(0), F.ceil((F.size(tokens) - size) / F.lit(step)).cast("int"))
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(tokens, i * step + 1, F.lit(size)))
    return F.when(F.size(tokens) > 0, windows).otherwise(F.slice(windows, 1, 0))


def batch_array(items: Column, size: int) -> Column:
    """Batches of `size` items, the last may be shorter."""
    return chunk_tokens(items, size, 0)


def batch_number(row_number: Column, size: int) -> Column:
    """The batch, from 0, of a row numbered from 1."""
    return F.floor((row_number - 1) / size).cast("long")
