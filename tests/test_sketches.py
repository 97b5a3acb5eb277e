"""Stored sketches: states of days merge to those of their rows, repeated loads add nothing."""

import random

import pytest
from pyspark.sql import functions as F
from support import rows

from gable.operators import sketches
from gable.runtime import scratch_path

SCHEMA = "place string, day int, value double, who string"


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(4)
    data = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), rng.randrange(12), rng.choice([None, rng.gauss(10, 3), 7.0]), f"u{rng.randrange(900)}") for i in range(9000)]
    return spark.createDataFrame([*data, ("empty", 1, None, None)], SCHEMA)


def test_any_period_is_within_the_stated_errors(facts):
    states = sketches.day_states(facts, ["place"], "day", "value", "who")
    got = sketches.figures(sketches.merged(states, ["place"], F.col("day").between(3, 9)), {"p10": 0.1, "p50": 0.5}, "people")
    exact = {}
    for r in facts.where("day BETWEEN 3 AND 9").collect():
        exact.setdefault(r.place, []).append(r)
    found = {r.place: r for r in got.collect()}
    assert set(found) == set(exact)
    for place, members in exact.items():
        values = [r.value for r in members if r.value is not None]
        assert (found[place].row_count, found[place].value_count) == (len(members), len(values))
        slack = 2 * sketches.rank_error()
        for name, p in (("p10", 0.1), ("p50", 0.5)):
            value = found[place][name]
            assert sum(v <= value for v in values) >= (p - slack) * len(values) and sum(v < value for v in values) <= (p + slack) * len(values)
        people = len({r.who for r in members})
        assert abs(found[place].people - people) <= 4 * sketches.distinct_error() * people + 1


def test_groups_without_values_and_empty_tables(facts):
    states = sketches.day_states(facts.where("place = 'empty'"), ["place"], "day", "value", "who")
    got = sketches.figures(sketches.merged(states, ["place"]), {"p50": 0.5}, "people")
    assert rows(got, "place", "row_count", "value_count", "p50", "people") == [("empty", 1, 0, None, 0)]
    none = sketches.day_states(facts.limit(0), ["place"], "day", "value", "who")
    assert sketches.merged(none, ["place"]).count() == 0


def test_a_day_is_stored_once(spark, facts):
    path = scratch_path(spark, "states-test")
    name = "states_test_" + spark.sparkContext.applicationId.replace("-", "_")
    for load in (facts.where("day < 5"), facts.where("day < 8"), facts.where("day < 8")):
        sketches.add_days(sketches.day_states(load, ["place"], "day", "value", "who"), name, ["place"], "day", path)
    stored = sketches.merged(spark.table(name), ["place"])
    assert rows(stored, "place", "row_count") == rows(facts.where("day < 8").groupBy("place").agg(F.count("*").alias("row_count")))
    spark.sql(f"DROP TABLE {name}")
