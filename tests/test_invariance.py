"""Results must not depend on how the input is partitioned:
the same rows in 1 and in 8 partitions give the same answer."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from roomrate.operators import aggregates as agg
from roomrate.operators import filters as flt
from roomrate.operators.comparables import comparables_report
from roomrate.operators.evaluate import error_metrics
from roomrate.operators.split import split_flag
from roomrate.plans.prepare import prepare_listings
from roomrate.plans.tables import load, located_customers


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.collect())


@pytest.mark.parametrize("op", [
    lambda e: flt.zscore_filter(e, "value", 2.5),
    lambda e: flt.zscore_filter_by(e, "event_type", "value", 2.5),
    lambda e: flt.frequency_filter(e, "user_id", 1 / 200),
    lambda e: agg.annotate_count(e, "user_id"),
    lambda e: agg.moments(e, "value", by="event_type"),
    lambda e: split_flag(e, "event_id").groupBy("is_train").count(),
    lambda e: prepare_listings(e, "user_id", ["event_type"], "value", drop=["ts", "props"]),
    lambda e: error_metrics(e.withColumn("p", F.col("value") * 0.9), "value", "p",
                            by="event_type"),
])
def test_same_result_for_1_and_8_partitions(spark, op):
    e = load(spark, SF001, "events").select("event_id", "ts", "user_id", "event_type",
                                            "value", "props")
    one = op(e.repartition(1))
    many = op(e.repartition(8, "event_id"))
    assert _rows(one) == _rows(many)


def test_comparables_report_invariant(spark):
    c = located_customers(spark, SF001)
    r1, s1 = comparables_report(c.repartition(1), "c_custkey", 0, {"c_mktsegment": "HOUSEHOLD"},
                                {"price": 0})
    r8, s8 = comparables_report(c.repartition(8), "c_custkey", 0, {"c_mktsegment": "HOUSEHOLD"},
                                {"price": 0})
    assert [r.c_custkey for r in r1.collect()] == [r.c_custkey for r in r8.collect()]
    assert _rows(s1) == _rows(s8)
