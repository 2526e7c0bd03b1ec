"""One-hot places of the most common state and county, per fold.

A fold's dictionary holds the values of its own years in alphabetical order.  Its labels make the
fold's ``StringIndexer`` model, which puts values that the dictionary lacks behind the last label; the encoder
drops that last place, so an unseen or missing value has no hot place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_dictionaries(obs: DataFrame, folds: DataFrame, columns: tuple[str, ...] = ("state", "county"),
                      roles: tuple[str, ...] = ("train", "test")) -> DataFrame:
    """(fold, column, labels): the sorted distinct values of each column over a fold's years.

    ``roles`` picks the years: those of all the fold's pairs, or of its training pairs only.  A row holds one
    dictionary (a few dozen states, a few thousand counties).
    """
    years = (folds.where(F.col("role").isin(*roles))
             .select("fold", F.explode(F.array("year_from", "year_to")).alias("year")).distinct())
    values = obs.select("year", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])).alias("c")) \
        .select("year", "c.column", "c.value").where("value is not null").distinct()
    return (values.join(F.broadcast(years), "year")           # a fold table: years x folds rows at most
            .groupBy("fold", "column").agg(F.array_sort(F.collect_set("value")).alias("labels")))


def onehot_vectors(rows: DataFrame, dictionaries: DataFrame,
                   columns: dict[str, str] | None = None) -> DataFrame:
    """``rows`` with a sparse vector ``<column>_onehot`` per column, each fold by its own dictionary.

    ``rows`` has fold and the columns that hold the values: ``columns`` maps state and county to their names
    (top_state, top_county).
    """
    columns = columns or {"state": "top_state", "county": "top_county"}
    labels = {(r["fold"], r["column"]): list(r["labels"]) for r in dictionaries.collect()}
    spark, parts = rows.sparkSession, []
    for fold in sorted({f for f, _ in labels}):
        part = rows.where(F.col("fold") == fold)
        for column, name in columns.items():
            index, out = f"{column}_index", f"{column}_onehot"
            model = StringIndexerModel.from_labels(labels.get((fold, column), []), inputCol=name, outputCol=index,
                                                   handleInvalid="keep")
            size = len(labels.get((fold, column), []))
            part = model.transform(part)
            fit_on = spark.createDataFrame([(float(size),)], f"{index} double")       # the place of unseen values
            part = OneHotEncoder(inputCols=[index], outputCols=[out], dropLast=True).fit(fit_on).transform(part).drop(index)
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)


def hot_features(vectors: DataFrame, dictionaries: DataFrame, keys: list[str],
                 columns: tuple[str, ...] = ("state", "county")) -> DataFrame:
    """(*keys, feature, value): the hot places by name (``state_X``), one row each; rows without one give none."""
    named = vectors.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.array_position(vector_to_array(f"{c}_onehot"), F.lit(1.0)).alias("place"))
        for c in columns])).alias("h")).select(*keys, "h.column", "h.place").where("place > 0")
    return (named.join(dictionaries, ["fold", "column"])
            .select(*keys, F.concat_ws("_", "column", F.element_at("labels", F.col("place").cast("int"))).alias("feature"),
                    F.lit(1.0).alias("value")))
