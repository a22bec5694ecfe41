from datetime import date, timedelta

from pyspark.sql import functions as F

from odoflow.operators import cohorts as co
from odoflow.params import CohortFilter, CohortSpec


def _hourly(spark):
    rows = []
    for i in range(20):
        d = date(2024, 1, 1) + timedelta(days=i)
        if i == 10:
            continue  # a missing day: moving averages count rows, not days
        for h in (4, 8, 24):
            rows.append((d, h, "A", 1, 10 * (i + 1), 1))
            rows.append((d, h, "B", 3, 1, 1))
    return spark.createDataFrame(rows, "date date, hour int, station string, boro int, entries int, exits int")


COHORTS = (CohortSpec("base", date(2024, 1, 1), date(2024, 1, 8)), CohortSpec("sel", date(2024, 1, 5), None))


def test_tagging_overlap_and_filters(spark):
    tagged = co.tag_cohorts(_hourly(spark), COHORTS)
    counts = {r.cohort: r["count"] for r in tagged.groupBy("cohort").count().collect()}
    assert counts == {"base": 7 * 6, "sel": 15 * 6}  # overlapping days are in both
    f = co.tag_cohorts(_hourly(spark), COHORTS, CohortFilter(dow=(1,), tod=(8,), boro=(1,)))
    assert {(r.dow, r.hour, r.boro) for r in f.collect()} == {(1, 8, 1)}


def test_daily_summary_profiles(spark):
    tagged = co.tag_cohorts(_hourly(spark), COHORTS)
    daily = co.cohort_daily(tagged)
    summary = co.cohort_summary(daily)
    assert daily.count() == 2 * (7 + 15)
    assert summary.count() == 7 + 15
    dow = co.dow_profile(summary)
    assert dow.filter("`when` = 'base'").agg(F.sum("n")).first()[0] == 7
    tod = co.tod_profile(tagged).filter("`when` = 'base' and hour = 4").first()
    assert tod.n == 7 and abs(tod.entries - (sum(10 * (i + 1) for i in range(7)) + 7) / 7) < 1e-9


def test_moving_average_rows_not_days(spark):
    s = spark.createDataFrame([("c", date(2024, 1, d), d) for d in (1, 2, 3, 5)], "cohort string, date date, entries int")
    got = [r.entries_ma for r in co.moving_average(s, 3, cols=("entries",)).orderBy("date").collect()]
    assert got == [None, None, 2.0, (2 + 3 + 5) / 3]
    one = [r.entries_ma for r in co.moving_average(s, 1, cols=("entries",)).orderBy("date").collect()]
    assert one == [1.0, 2.0, 3.0, 5.0]
    assert all(r.entries_ma is None for r in co.moving_average(s, 7, cols=("entries",)).collect())


def test_kpi_and_station_compare_fanout(spark):
    cohorts = (CohortSpec("s", date(2024, 1, 1), date(2024, 1, 8)), CohortSpec("p", date(2024, 1, 8), date(2024, 1, 15)), CohortSpec("b", date(2024, 1, 15), None))
    tagged = co.tag_cohorts(_hourly(spark), cohorts)
    daily = co.cohort_daily(tagged)
    k = co.kpi(co.cohort_summary(daily), "s", "p", "b").first()
    assert k.avg_selected < k.avg_pandemic < k.avg_base and k.pct_selected_vs_base < 0
    stations = spark.createDataFrame(
        [("a1", "A", 1.0, 2.0), ("a2", "A", 1.0, 2.0), ("b1", "B", 3.0, 4.0), ("c1", "C", 5.0, 6.0)],
        "station string, pretty_name string, latitude double, longitude double",
    )
    cmp = co.station_compare(daily, stations, "s", "p", "b")
    assert sorted(r.station for r in cmp.collect()) == ["a1", "a2", "b1"]  # shared name fans out; C has no data
    page = co.station_page(cmp, page=0, page_size=2).collect()
    assert [r.station for r in page] == ["A", "A"] and page[0].pct_v_2019.endswith("%")


def test_union_labelled_and_label_order(spark):
    a = spark.createDataFrame([(1, 2.0)], "dow long, entries double")
    u = co.union_labelled({"2019": a, "Selected": a, "Pandemic": a})
    order = co.label_order(F.col("when"), ["2019", "Selected", "Pandemic"])
    assert [r["when"] for r in u.orderBy(order).collect()] == ["2019", "Selected", "Pandemic"]


def test_bound_parameter_sql_matches_dataframe_filter(spark):
    from odoflow.plans.views import cohort_filter_sql

    _hourly(spark).createOrReplaceTempView("t_hourly_params")
    spec = CohortSpec("open", date(2024, 1, 10), None)
    filt = CohortFilter(boro=(1,), sta=("A", "it's"))
    via_sql = cohort_filter_sql(spark, "t_hourly_params", spec.start, None, boro=[1], sta=["A", "it's"])
    via_df = co.tag_cohorts(_hourly(spark), [spec], filt).drop("cohort")
    assert via_sql.count() == via_df.count() > 0
    assert via_sql.exceptAll(via_df).count() == 0


def test_all_values_ticked_is_no_filter(spark):
    from odoflow.operators.cohorts import filter_predicate
    from odoflow.params import CohortFilter

    df = spark.sql("select date'2024-01-02' as date, 4 as hour, boro, 's' as station from values (-1), (2) as t(boro)")
    every = CohortFilter(dow=tuple(range(7)), tod=(4, 8, 12, 16, 20, 24), boro=(1, 2, 3, 4, 5))
    assert df.filter(filter_predicate(every)).count() == 2
    assert df.filter(filter_predicate(CohortFilter(boro=(1, 2, 3, 4)))).count() == 1


def test_all_panels_come_from_one_aggregate_exchange(spark, tmp_path):
    """The figures of the panels' own queries, and a plan with one exchange over the facts."""
    from odoflow.plans.stages import Stages
    from odoflow.sources import proxy

    path = str(tmp_path / "facts")
    Stages(spark, "/root/testdata/sf0.001").hourly_clean.write.parquet(path)
    tagged = co.tag_cohorts(spark.read.parquet(path), proxy.PROXY_COHORTS)
    panels = co.all_panels(tagged)
    assert panels._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1

    def rows(name):
        return {(r.cohort, r.key): (r.n, round(r.entries, 6), round(r.exits, 6)) for r in panels.where(F.col("panel") == name).collect()}

    daily = co.cohort_daily(tagged)
    summary = co.cohort_summary(daily)
    own = {
        "by_dow": (co.dow_profile(summary), "dow"),
        "by_tod": (co.tod_profile(tagged), "hour"),
    }
    for name, (df, key) in own.items():
        assert rows(name) == {(r["when"], str(r[key])): (r.n, round(r.entries, 6), round(r.exits, 6)) for r in df.collect()}
    assert rows("by_date") == {(r.cohort, str(r.date)): (1, float(r.entries), float(r.exits)) for r in summary.collect()}
    by_station = daily.groupBy("cohort", "station").agg(F.count("*").alias("n"), F.avg("entries").alias("e"), F.avg("exits").alias("x"))
    assert rows("by_station") == {(r.cohort, r.station): (r.n, round(r.e, 6), round(r.x, 6)) for r in by_station.collect()}
