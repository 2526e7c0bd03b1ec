"""Hand-sized species-set table (FIXTURES §3.1) and its derived data."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flyway.operators.folds import assign_folds, cv_folds
from flyway.operators.species import all_species
from flyway.operators.transitions import transitions
from flyway.plans.pipeline import FoldedData

SETS = {
    1: {2018: "AB", 2019: "ABC", 2020: "ACD", 2021: "BC"},
    2: {2018: "AC", 2019: "AD", 2021: "AB"},
    3: {2019: "B", 2020: "BE"},
    4: {2020: "ABCDEF", 2021: "A"},
    5: {2018: "F"},
}


def species_sets(spark):
    rows = [(o, y, sorted(s)) for o, ys in SETS.items() for y, s in ys.items()]
    schema = T.StructType([T.StructField("observer_id", T.LongType()),
                           T.StructField("year", T.IntegerType()),
                           T.StructField("scientific_name", T.ArrayType(T.StringType()))])
    return spark.createDataFrame(rows, schema)


def data(spark, consecutive_only=False, mode="consecutive"):
    t = transitions(species_sets(spark), consecutive=consecutive_only)
    folds = cv_folds(t, n_folds=4, mode=mode)
    ft = assign_folds(t, folds)
    cat = all_species(t)
    return FoldedData(t, folds, ft, cat, cat.agg(F.count(F.lit(1)).alias("n_species")), 4)
