import random

import pytest
from pyspark.sql import functions as F

from hourgrid.operators.ordering import dense_rank_all, exact_quantiles, number_all


@pytest.fixture(scope="module")
def ties(spark):
    """Heavy ties: a third of the rows share one key, many keys appear twice."""
    pick = random.Random(7)
    rows = [(i, "ab"[i % 2], 5 if i % 3 == 0 else pick.randrange(40), float(pick.randrange(3))) for i in range(900)]
    rows += [(1000, "a", None, None), (1001, "b", None, 1.0)]
    return spark.createDataFrame(rows, "id int, g string, n int, v double")


def _dense(rows):
    keys = sorted({(r.n, r.v) for r in rows}, key=lambda k: (k[0] is None, -(k[0] or 0), k[1] is None, -(k[1] or 0)))
    return {k: i + 1 for i, k in enumerate(keys)}


def test_dense_rank_matches_brute_force(ties):
    out = dense_rank_all(ties, ["n", "v"], "r", tie=("id",)).collect()
    want = _dense(out)
    assert len(out) == 902 and all(r.r == want[r.n, r.v] for r in out)


def test_dense_rank_within_groups(ties):
    out = dense_rank_all(ties, ["n", "v"], "r", within=("g",), tie=("id",)).collect()
    for g in "ab":
        part = [r for r in out if r.g == g]
        want = _dense(part)
        assert all(r.r == want[r.n, r.v] for r in part)


def test_positions_and_running_sum(ties):
    rows = ties.where(F.col("n").isNotNull())
    out = number_all(rows, ["-n", "id"], "pos", ("run", "n"), "all")
    total = 0
    got = sorted(out.collect(), key=lambda r: r.pos)
    assert [r.pos for r in got] == list(range(1, 901))
    assert [(r.n, r.id) for r in got] == sorted(((r.n, r.id) for r in got), key=lambda k: (-k[0], k[1]))
    for r in got:
        total += r.n
        assert r.run == total
    assert {r["all"] for r in got} == {total}


def test_quantiles_interpolate(spark, ties):
    values = sorted(r.v * 10 + r.n for r in ties.where("n is not null").collect())
    df = ties.select((F.col("v") * 10 + F.col("n")).alias("x"))
    row = exact_quantiles(df, "x", {"a": 0.01, "b": 0.5, "c": 0.99, "d": 1.0}).first()
    for name, p in zip("abcd", (0.01, 0.5, 0.99, 1.0)):
        spot = (len(values) - 1) * p
        low = values[int(spot)]
        high = values[min(int(spot) + 1, len(values) - 1)]
        assert row[name] == pytest.approx(low + (high - low) * (spot - int(spot)))


def test_quantile_of_one_and_of_no_row(spark):
    one = spark.createDataFrame([(3.0,), (None,)], "x double")
    assert exact_quantiles(one, "x", {"q": 0.3}).first().q == 3.0
    none = spark.createDataFrame([], "x double")
    assert exact_quantiles(none, "x", {"q": 0.3}).first().q is None


def test_one_exchange_of_the_rows_and_nothing_run_before(spark, ties):
    """The rows are computed behind one exchange; bucket windows and totals read one more; no file is scanned or left."""
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
    out = dense_rank_all(ties.groupBy("g", "n").agg(F.sum("v").alias("v"), F.count("*").alias("c")), ["n", "v"], "r", tie=("g",))
    assert spark.sparkContext._jsc.sc().dagScheduler().nextJobId() == jobs
    rows = out.collect()
    want = _dense(rows)
    assert all(r.r == want[r.n, r.v] for r in rows)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Scan ExistingRDD" not in plan.replace("Scan ExistingRDD[id", "")  # no checkpoint beside the given rows
    assert plan.count("Exchange RoundRobin") - plan.count("ReusedExchange") <= 1


def test_dynamic_pruning_below(spark, tmp_path):
    """A source with a join on its partition column is ranked too."""
    spark.range(60).selectExpr("id", "id % 3 AS part", "id % 7 AS v").write.partitionBy("part").parquet(str(tmp_path / "t"))
    keep = spark.range(3).where("id > 0").selectExpr("id AS part").groupBy("part").agg(F.count("*").alias("k")).where("k = 1")
    rows = spark.read.parquet(str(tmp_path / "t")).join(keep, "part", "left_semi")
    out = dense_rank_all(rows, ["v"], "r").collect()
    assert len(out) == 40 and all(r.r == 7 - r.v for r in out)
