"""Species tables: catalogue, viewer counts, popularity labels, rankings.

The catalogue is bounded by the number of distinct species S (about a thousand in
the full reference data); whether a table keyed by species is broadcast is left to
Spark's own size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def all_species(trans: DataFrame) -> DataFrame:
    """Distinct species over species_from and species_to -- A3 (the catalogue)."""
    return (trans.select(F.explode(F.array_union("species_from", "species_to")).alias("species"))
                 .distinct())


def species_index(catalogue: DataFrame) -> DataFrame:
    """Alphabetical species -> 0-based index -- J8 / O2 (StringIndexer alphabetAsc).

    A catalogue per fold (it has a column ``fold``) is numbered per fold.
    """
    keys = [c for c in ("fold",) if c in catalogue.columns]
    w = Window.partitionBy(*keys).orderBy("species")  # S rows: one small task
    return catalogue.select(*keys, "species", (F.row_number().over(w) - 1).cast("int").alias("species_idx"))


def interaction_long(trans: DataFrame, keys: list[str]) -> DataFrame:
    """Binary interaction 'matrices' in long form -- M0b.

    One row per (key, side, species), side 'X' = species_from, 'y' = species_to.
    """
    x = trans.select(*keys, F.lit("X").alias("side"), F.explode("species_from").alias("species"))
    y = trans.select(*keys, F.lit("y").alias("side"), F.explode("species_to").alias("species"))
    return x.unionByName(y)


def species_viewers(trans: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Viewer counts per species, by year and in total -- A4.

    Every transition counts its source year and its target year, so a middle year
    of a chain is counted twice (as the reference does).
    Output: (*group, species, viewers_by_year MAP<INT,BIGINT>, total_viewers BIGINT).
    """
    g = list(group or [])
    side = (trans.select(*g, F.col("year_from").alias("year"), F.explode("species_from").alias("species"))
                 .unionByName(trans.select(*g, F.col("year_to").alias("year"),
                                           F.explode("species_to").alias("species"))))
    by_year = side.groupBy(*g, "species", "year").agg(F.count(F.lit(1)).alias("n"))
    return (by_year.groupBy(*g, "species")
                   .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("year", "n"))))
                          .alias("viewers_by_year"),
                        F.sum("n").cast("bigint").alias("total_viewers")))


def species_features(trans: DataFrame, group: list[str] | None = None) -> DataFrame:
    """A4 + popularity label and score -- A5.

    median / mean of total viewers over the species of a group; 'common' if
    total >= median else 'rare'; score = total / max(mean, 1).
    """
    g = list(group or [])
    sv = species_viewers(trans, g)
    w = Window.partitionBy(*g) if g else Window.partitionBy()
    med = F.median("total_viewers").over(w)
    mean = F.avg("total_viewers").over(w)
    return (sv.withColumn("_med", med).withColumn("_mean", mean)
              .withColumn("popularity", F.when(F.col("total_viewers") >= F.col("_med"), "common")
                                         .otherwise("rare"))
              .withColumn("popularity_score",
                          F.col("total_viewers") / F.greatest(F.col("_mean"), F.lit(1.0)))
              .drop("_med", "_mean"))


def fold_species_features(fold_trans: DataFrame, all_trans: DataFrame | None = None,
                          scope: str = "train") -> DataFrame:
    """Species features for the boost of the co-occurrence model.

    ``scope='train'``: per fold, from that fold's training rows only -> keyed (fold, species).
    ``scope='all'``: from every transition, test rows included (the reference's
    leak) -> keyed (species); consumers join on the columns present.
    """
    if scope == "train":
        return species_features(fold_trans.where(F.col("role") == "train"), ["fold"])
    if scope == "all":
        if all_trans is None:
            raise ValueError("scope='all' needs all_trans")
        return species_features(all_trans)
    raise ValueError("scope must be 'train' or 'all'")


def target_popularity(targets: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Viewers per species over target sets, ranked -- A6 / W5.

    ``targets`` has a ``species_to`` set column.  Every catalogue species gets a row
    (zero-count species rank last, alphabetically); order = count desc, species asc.
    The result has S rows (catalogue-bounded).
    """
    counts = (targets.select(F.explode("species_to").alias("species"))
                     .groupBy("species").agg(F.count(F.lit(1)).alias("n_viewers")))
    full = (catalogue.join(counts, "species", "left")
                     .withColumn("n_viewers", F.coalesce("n_viewers", F.lit(0)).cast("bigint")))
    w = Window.orderBy(F.desc("n_viewers"), "species")
    return full.withColumn("pop_rank", F.row_number().over(w))


def history_popularity(rows: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Normalised species frequency over history rows -- A8 / W6.

    ``rows`` has (*group, species) with one row per (history row, species);
    p = n / sum(n) within the group.  (A group with no rows has no entries; the
    uniform fallback is applied by the caller on the catalogue.)
    """
    g = list(group or [])
    counts = rows.groupBy(*g, "species").agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy(*g) if g else Window.partitionBy()
    return counts.withColumn("share", F.col("n_rows") / F.sum("n_rows").over(w))
