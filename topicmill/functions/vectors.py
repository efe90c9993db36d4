"""Reading pyspark.ml vectors with column expressions."""

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def vector_entries(vector: Column) -> Column:
    """Non-zero entries as `array<struct<idx: int, value: double>>`, by idx.

    Reads the vector's own storage (type 0 is sparse), so a sparse vector over
    a million features costs its few entries only.
    """
    v = F.unwrap_udt(vector)
    sparse = F.arrays_zip(v["indices"].alias("idx"), v["values"].alias("value"))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("idx"), x.alias("value")))
    entry = "array<struct<idx:int,value:double>>"
    entries = F.when(v["type"] == 0, sparse.cast(entry)).otherwise(dense.cast(entry))
    return F.filter(entries, lambda e: e["value"] != 0.0)


def bare(column: str) -> Column:
    """The column without ML attributes.

    Count models and assemblers describe every feature in the column's metadata.
    With a large vocabulary that is megabytes, copied into every plan and every
    parquet footer, and nothing here reads it: names come from `feature_names`.
    """
    return F.col(column).alias(column, metadata={})


def positive_score(df: DataFrame, score_col: str) -> Column:
    """A scalar score: element 1 of a probability vector, else the column."""
    if isinstance(df.schema[score_col].dataType, VectorUDT):
        return vector_to_array(F.col(score_col))[1]
    return F.col(score_col).cast("double")
