from odoflow.operators import cohorts as co
from odoflow.plans import dashboard
from odoflow.plans.build import build_models, model_tests
from odoflow.plans.stages import PROXY_RULES, Stages
from odoflow.plans.views import cohort_filter_sql, register_views
from odoflow.sources import proxy
from odoflow.sources.files import describe, save_table, drop_table, rename_table

SF = "/root/testdata/sf0.001"


def test_weekly_build_views_and_dashboard(spark):
    p = Stages(spark, SF)
    counts: dict[str, int] = {}
    models = build_models(
        spark, p.raw, p.station_map, p.borough_map, p.station_labels, p.division_labels, PROXY_RULES,
        row_counts=counts,
    )
    assert counts["mta_staging"] == p.staging.count() == models["mta_staging"].count()
    assert counts["mta_clean"] == models["mta_clean"].count() and set(counts) >= {"mta_diff", "station_list"}
    # materialized models equal the lazy chain
    assert models["mta_clean"].exceptAll(p.hourly_clean).count() == 0
    assert p.hourly_clean.exceptAll(models["mta_clean"]).count() == 0
    assert {r.test: r.failures for r in model_tests(models).collect()} == {
        "not_null:mta_clean.station": 0, "unique:station_list.station": 0
    }
    register_views(models, prefix="t_")
    sel = proxy.PROXY_COHORTS[2]
    via_sql = cohort_filter_sql(spark, "t_mta_clean", sel.start, sel.end, dow=[1, 2], tod=[8, 12])
    via_df = co.tag_cohorts(models["mta_clean"], [sel], co.CohortFilter(dow=(1, 2), tod=(8, 12))).drop("cohort")
    assert via_sql.exceptAll(via_df).count() == 0 and via_df.exceptAll(via_sql).count() == 0
    # the date range of a cohort prunes the day folders of the materialized facts
    plan = via_df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "date#" in plan
    with dashboard.refresh(models["mta_clean"], models["station_list"], proxy.PROXY_COHORTS) as panels:
        assert panels["kpi"].count() == 1
        assert panels["by_station"].count() > 0 and panels["by_date"].count() > 0


def test_catalog_ddl(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert [tuple(r) for r in describe(df).collect()] == [("k", "int"), ("v", "string")]
    save_table(df, "t_ddl", database="odoflow_test")
    rename_table(spark, "odoflow_test.t_ddl", "odoflow_test.t_ddl2")
    assert spark.table("odoflow_test.t_ddl2").count() == 1
    drop_table(spark, "odoflow_test.t_ddl2")
    assert not spark.catalog.tableExists("odoflow_test.t_ddl2")


def test_real_file_path_equals_lazy_chain(spark):
    """Weekly CSV files + dimension CSVs -> build, equal to the chain over the driver tables."""
    from datetime import date

    from odoflow.params import StagingRules
    from odoflow.sources import files, seeds
    from odoflow.sources.files import scratch_path

    p = Stages(spark, SF)
    root = scratch_path(spark, "t-real")
    files.write_reading_files(p.raw, f"{root}/landing")
    p.station_map.coalesce(1).write.option("header", True).csv(f"{root}/station_map")
    p.borough_map.coalesce(1).write.option("header", True).csv(f"{root}/borough_map")
    models = build_models(
        spark,
        files.read_reading_files(spark, f"{root}/landing", glob="*.csv"),
        seeds.load_station_map(spark, f"{root}/station_map"),
        seeds.load_borough_map(spark, f"{root}/borough_map"),
        station_labels=dict(proxy.PROXY_STATION_LABELS),
        division_labels=dict(proxy.PROXY_DIVISION_LABELS),
        rules=StagingRules(start_date=date(2024, 1, 1), exclude_stations=proxy.PROXY_EXCLUDED_STATIONS),
    )
    clean = models["mta_clean"]
    assert clean.exceptAll(p.hourly_clean).count() == 0 and p.hourly_clean.exceptAll(clean).count() == 0
