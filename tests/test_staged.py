import pytest

from hourgrid.plans import queries as Q
from tests.rows import values


def test_staged_run_gives_the_same_tables(spark, small_dir, tmp_path):
    live = Q.tables(spark, small_dir)
    staged = Q.tables(spark, small_dir).staged(str(tmp_path))
    assert staged.cube.columns == live.cube.columns and staged.trips.dtypes == live.trips.dtypes
    for name in ("hourly_demand", "route_borough_matrix", "split_info"):
        a, b = (sorted(map(str, Q.rounded(t.table(name)).collect())) for t in (live, staged))
        assert a == b
    # a month filter prunes folders
    plan = staged.cube.where("year_month = '1998-05'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    assert sum(values(staged.cube, "trip_count")) == live.cleaned.count()


def test_tables_name_the_columns_a_stage_lacks(spark, small_dir):
    for stage, table, column in [("cube", "hourly_demand", "total_revenue"), ("trips", "od_flow_hour", "tip_amount"), ("routes", "route_concentration", "route_key")]:
        tables = Q.tables(spark, small_dir)
        tables.__dict__[stage] = getattr(tables, stage).drop(column)
        with pytest.raises(ValueError, match=f"{stage} lacks required columns: {column}"):
            tables.table(table)
