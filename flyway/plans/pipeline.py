"""Shared lazy building blocks from (spark, sf_dir) to the tables every job uses.

Nothing here runs a job: each function returns a DataFrame over the given
parquet tables, so Catalyst sees -- and prunes -- the whole plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.folds import assign_folds, cv_folds
from ..operators.species import all_species
from ..operators.summaries import observer_year_species, observer_year_summary
from ..operators.transitions import transitions
from ..session import cut_lineage
from ..sources.fixture import raw_observations
from ..sources.scan import scan_observed


def observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_observed(raw_observations(spark, sf_dir))


def species_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observer_year_species(observed(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observer_year_summary(observed(spark, sf_dir))


def all_transitions(spark: SparkSession, sf_dir: str, consecutive: bool = False) -> DataFrame:
    return transitions(species_sets(spark, sf_dir), consecutive=consecutive)


@dataclass
class FoldedData:
    transitions: DataFrame      # all adjacent-present transitions
    folds: DataFrame            # (fold, role, year_from, year_to)
    fold_trans: DataFrame       # transitions x folds: + fold, role
    catalogue: DataFrame        # (species) over all transitions
    n_species: DataFrame        # one row: n_species
    n_folds: int                # requested folds (the table may hold fewer)


def folded(spark: SparkSession, sf_dir: str, mode: str = "consecutive", n_folds: int = 4,
           trans: DataFrame | None = None, materialize: bool = True) -> FoldedData:
    """Transitions, folds and the species catalogue of one job.

    The transitions (one row per observer-year pair -- the whole raw scan reduced
    by orders of magnitude) are written once to the shared checkpoint folder:
    every model and metric below reads them back instead of re-running the raw
    join, and the written copy survives executor loss.
    """
    t = trans if trans is not None else all_transitions(spark, sf_dir)
    if materialize:
        t = cut_lineage(t)
    folds = cv_folds(t, n_folds=n_folds, mode=mode)
    ft = assign_folds(t, folds)
    cat = all_species(t)
    if materialize:
        # Fold table (<= years^2 x folds rows) and catalogue (S rows) are tiny;
        # the fold-expanded transitions (<= folds x transitions) feed every model.
        folds, cat, ft = cut_lineage(folds), cut_lineage(cat), cut_lineage(ft)
    n = cat.agg(F.count(F.lit(1)).alias("n_species"))
    return FoldedData(t, folds, ft, cat, n, n_folds)
