"""Categories of any number as one sparse vector column.

The one-hot columns of ``features.category_features`` are a projection list and
stay small.  Here a category is a position in a written index table and one
entry of a sparse vector, so a row costs one number whatever the vocabulary:

* ``category_index`` ranks the distinct values (a distributed rank, written
  once; nothing but their number reaches the driver);
* ``with_category_vector`` joins the index and encodes it with Spark ML's
  ``OneHotEncoder``, which needs the number of categories only.  Values that the
  index does not have get the last entry.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopsignals.operators.running import global_rank
from shopsignals.session import materialize


def category_index(df: DataFrame, category_col: str) -> DataFrame:
    """``category, position``: distinct values in order, from 0; null is no category."""
    names = df.select(F.col(category_col).alias("category")).where("category IS NOT NULL").distinct()
    return materialize(global_rank(names, "category", "rank").select("category", (F.col("rank") - 1).alias("position")))


def with_category_vector(df: DataFrame, index: DataFrame, category_col: str, out_col: str = "category_vector") -> DataFrame:
    """``df`` with a sparse one-hot vector of as many entries as the index has, and one more for all other values."""
    size = index.count()
    position, vector = f"_{out_col}_position", F.coalesce(F.col("position"), F.lit(size)).cast("double")
    coded = df.join(index, F.col(category_col) == F.col("category"), "left").withColumn(position, vector).drop("category", "position")
    # the encoder learns the number of entries from one row
    width = df.sparkSession.range(1).select(F.lit(float(size)).alias(position))
    encoder = OneHotEncoder(inputCols=[position], outputCols=[out_col], dropLast=False).fit(width)
    return encoder.transform(coded).drop(position)
