
from pyspark.sql import functions as F

from odoflow.operators import cohorts as co
from odoflow.operators.staging import stage
from odoflow.params import CohortSpec
from odoflow.plans.stages import PROXY_RULES, Stages
from odoflow.sources import proxy

SF = "/root/testdata/sf0.001"


def test_staging_idempotent_under_duplicate_input(spark):
    p = Stages(spark, SF)
    once = p.staging
    twice = stage(p.raw.unionByName(p.raw), p.station_labels, p.division_labels, PROXY_RULES)
    assert once.count() == twice.count()
    assert once.exceptAll(twice).count() == 0


def test_hour_sums_equal_day_sums(spark):
    p = Stages(spark, SF)
    hourly = p.hourly_clean
    by_day = hourly.groupBy("date").agg(F.sum("entries").alias("e"))
    daily = co.cohort_daily(co.tag_cohorts(hourly, [CohortSpec("all")]))  # an open range: every row
    by_day2 = daily.groupBy("date").agg(F.sum("entries").alias("e"))
    assert by_day.exceptAll(by_day2).count() == 0 and by_day2.exceptAll(by_day).count() == 0


def test_profile_rows_equal_sum_of_branches(spark):
    p = Stages(spark, SF)
    summary = p.summary
    prof = co.dow_profile(summary)
    per_branch = sum(summary.filter(F.col("cohort") == c.name).select("dow").distinct().count() for c in proxy.PROXY_COHORTS)
    assert prof.count() == per_branch
    # and every day of a cohort is counted exactly once in its weekday rows
    assert prof.agg(F.sum("n")).first()[0] == summary.count()


def test_diff_keeps_only_rows_with_a_previous_reading(spark):
    p = Stages(spark, SF)
    d = p.diff_all
    firsts = d.filter(F.col("seconds_diff").isNull()).count()
    series = p.staging.select("station", "turnstile").distinct().count()
    assert firsts == series
