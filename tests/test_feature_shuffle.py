"""Features are aggregated where one narrow shuffle of the raw rows has put them."""

import random
import statistics as st
from collections import Counter
from datetime import date

import pytest

from flyway.operators import features as FE

SCHEMA = ("observer_id long, year int, state string, county string, locality_id long, scientific_name string, "
          "observation_date date, observation_count double, day_of_year int, hours_of_day double, effort_hours double, "
          "duration_minutes double, latitude double, longitude double")


def rows():
    r = random.Random(5)
    out = [(o, 2020, r.choice(["A", "B", None]), r.choice(["x", "y", None]), r.choice([1, 2, 3, None]), r.choice("pqrs"),
            date(2020, r.randrange(1, 13), 3), r.choice([None, 2.0, 5.0]), r.randrange(1, 366), r.choice([None, 6.5]),
            r.uniform(0, 3), 15.0, r.uniform(40, 41), r.choice([None, -70.5])) for o in (1, 2, 3) for _ in range(60)]
    return out + out[:7] + [(4, 2020, *[None] * 12), (None, 2020, "A", *[None] * 11), (5, None, "A", *[None] * 11)]


@pytest.mark.parametrize("build", [FE.temporal_features, FE.geo_features, FE.observer_year_features])
def test_raw_rows_are_shuffled_once(spark, build):
    df = build(spark.createDataFrame(rows(), SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Final Plan ==")[0].count("Exchange hashpartitioning") == 1


def test_against_plain_values(spark):
    got = {g.observer_id: g for g in FE.observer_year_features(spark.createDataFrame(rows(), SCHEMA)).collect()}
    assert set(got) == {1, 2, 3, 4}
    for o in (1, 2, 3):
        own = [x for x in rows() if x[0] == o]
        g, effort = got[o], [x[10] for x in own]

        def held(i):
            return [x[i] for x in own if x[i] is not None]
        assert (g.num_states, g.num_counties, g.num_localities, g.num_checklists, g.num_species) == tuple(
            len(set(held(i))) for i in (2, 3, 4, 4, 5))
        for top, i in ((g.top_state, 2), (g.top_county, 3)):
            assert top == min(Counter(held(i)).items(), key=lambda x: (-x[1], x[0]))[0]
        assert g.total_observations == pytest.approx(sum(held(7)), rel=1e-12)
        assert g.effort_std == pytest.approx(st.stdev(effort), rel=1e-12)
        assert (g.effort_max, g.duration_std, g.hod_mean) == (max(effort), 0.0, 6.5)
        assert g.month_3_freq == pytest.approx(sum(x[6].month == 3 for x in own) / len(own))
        assert g.geographic_spread == pytest.approx(st.stdev(held(12)), rel=1e-12)
    empty = got[4]
    assert (empty.num_states, empty.num_species, empty.top_state, empty.doy_mean, empty.effort_std,
            empty.state_diversity, empty.month_1_freq) == (0, 0, None, None, 0.0, 0.0, 0.0)


def test_ties_take_the_smallest(spark):
    df = spark.createDataFrame([(1, 2020, s, s + "-1", *[None] * 10) for s in ("B", "A", "C", "A", "B")], SCHEMA)
    g = FE.geo_features(df).first()
    assert (g.top_state, g.top_county) == ("A", "A-1")
