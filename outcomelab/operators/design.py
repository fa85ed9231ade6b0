"""Sparse design matrices (O49, O65 into O76).

One-hot cells of any vocabulary arrive as (id, feature, value) rows.  The
feature index, the rank of each name among the sorted distinct names, comes
from a distributed ordered pass.  The rows of an id become one MLlib sparse
vector; they are assembled as plain structs and written once, and reading the
table back under the vector type makes them vectors, so no Python touches them.
Nothing grows with the vocabulary but the tables themselves (and the fitted
coefficients).
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelab.operators.ordered import running_totals
from outcomelab.session import materialize


def feature_index(cells: DataFrame) -> DataFrame:
    """(feature, index): names in sorted order, from 0."""
    names = cells.select("feature").where(F.col("feature").isNotNull()).distinct()
    return running_totals(names, order=["feature"]).select("feature", F.col("n_before").cast("int").alias("index"))


def sparse_rows(cells: DataFrame, index: DataFrame, id_col: str = "id", ids: DataFrame | None = None,
                out_col: str = "features") -> DataFrame:
    """One row per id: a sparse vector of its cells.  Cells of features the index lacks
    are left out, repeated cells of an id and feature are summed, zeros
    are not stored.  ``ids`` adds ids without cells (empty vectors)."""
    size = index.count()
    known = cells.select(id_col, "feature", F.col("value").cast("double").alias("value")).join(index, "feature")
    summed = known.groupBy(id_col, "index").agg(F.sum("value").alias("value")).where("value <> 0")
    rows = summed.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("index", "value"))).alias("c"))
    if ids is not None:
        rows = ids.select(id_col).join(rows, id_col, "left")
    none = F.array().cast("array<struct<index: int, value: double>>")
    c = F.coalesce("c", none)
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.transform(c, lambda x: x["index"]).alias("indices"),
                      F.transform(c, lambda x: x["value"]).alias("values"))
    table = materialize(rows.select(id_col, vector.alias(out_col)), "design")
    path = getattr(table, "_written_to", None)
    schema = T.StructType([table.schema[id_col], T.StructField(out_col, VectorUDT())])
    if path is None:
        raise RuntimeError("sparse rows need spark.checkpoint.dir for their table")
    out = table.sparkSession.read.schema(schema).parquet(path)
    out._written_to = path
    return out
