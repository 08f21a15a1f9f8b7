"""Quantiles by mergeable KLL sketches of bounded size."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

SKETCH = 4096  # items a sketch keeps at its base: exact up to as many values, then ranks within about 0.1 %


def sketch(col: str) -> Column:
    """Sketch of a double column; sketches of parts merge into that of the whole (`kll_merge_agg_double`)."""
    return F.kll_sketch_agg_double(col, SKETCH)


def quantile(col: str, rank: float) -> Column:
    """The least value with at least that share of all values up to it; NULL for a sketch of none."""
    return F.when(F.kll_sketch_get_n_double(col) > 0, F.kll_sketch_get_quantile_double(col, F.lit(rank)))
