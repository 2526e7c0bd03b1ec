"""The rows that count fits read."""

import glob
import os


def test_count_fits_read_their_own_fold(spark):
    from flyway.models.learned import count_regression
    from tests.micro import data
    rows = [(o, y, 1.0 + o % 3) for o in range(1, 6) for y in range(2018, 2022)]
    summary = spark.createDataFrame(rows, "observer_id long, year int, total_observations double")
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(os.path.join(base, "count-rows-*")))
    predicted, actual = count_regression(data(spark), summary, use_features=False)
    assert predicted.count() == actual.count() > 0
    written, = set(glob.glob(os.path.join(base, "count-rows-*"))) - before
    assert len(glob.glob(os.path.join(written, "fold=*"))) >= 2
    assert "species_from" not in spark.read.parquet(written).columns
