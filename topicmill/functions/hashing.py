"""Uniform numbers that depend on the row's id alone.

`rand` and `sampleBy` draw by partition and row order, so a lost executor or
another partitioning changes the sample. A hash of the id does not.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform_from_id(id_col: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from the id and a seed."""
    digest = F.md5(F.concat_ws("#", F.lit(str(seed)), id_col.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def fold_of(id_col: Column, num_folds: int, seed: int = 0) -> Column:
    """Fold number 0..num_folds-1 of a row."""
    return F.floor(uniform_from_id(id_col, seed) * num_folds).cast("int")
