"""Smoothers, streaks and ranks bit by bit, and how they hold up on larger tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import medians, recursive, rolling
from tidepanel.operators import windows as w


def test_smoothers_take_the_plain_steps():
    x = np.random.default_rng(3).uniform(0, 100, 400)
    x[[0, 7, 8, 50]] = np.nan
    mean, weight, want = np.nan, 1.0, []
    for v in x.tolist():
        if v == v:
            mean = v if mean != mean else (weight * (1 - 1 / 3) * mean + 1 / 3 * v) / (weight * (1 - 1 / 3) + 1 / 3)
            weight = 1.0
        else:
            weight *= 1 - 1 / 3
        want.append(mean)
    assert np.array_equal(recursive.ewm(x, 1 / 3), want, equal_nan=True)
    y, old = x[51:], sum(x[51:65].tolist()) / 14
    want = [old := (old * 13 + v) / 14 for v in y[14:].tolist()]
    assert recursive.wilder(y, 14)[14:].tolist() == want


def test_rolled_equals_sliding_frames(spark):
    rng = np.random.default_rng(4)
    rows = pd.DataFrame({"stock_id": np.repeat([1, 2, 3], [70, 5, 1]), "x": np.where(rng.random(76) < 0.1, np.nan, rng.integers(0, 20, 76) / 7)})
    rows["date"] = pd.Timestamp("2001-01-01") + pd.to_timedelta(rows.groupby("stock_id").cumcount(), "D")
    df = spark.createDataFrame(rows).withColumn("x", F.nanvl("x", F.lit(None)))
    x, frames = F.col("x"), {"mean": F.avg, "sum": F.sum, "sd": F.stddev_samp, "max": F.max, "min": F.min, "median": lambda c: F.percentile(c, F.lit(0.5))}
    want = df.select("stock_id", "date", *[w.roll(f, x, 20, least).alias(f"{how}{least}") for how, f in frames.items() for least in (20, 4)], w.rank_in_window(x, 20, 4).alias("rank4"))
    got = rolling.rolled(df, {f"{how}{least}": (how, "x", 20, least) for how in frames for least in (20, 4)} | {"rank4": ("rank", "x", 20, 4)})
    a, b = (d.toPandas().sort_values(["stock_id", "date"], ignore_index=True) for d in (got, want))
    pd.testing.assert_frame_equal(a[b.columns], b, check_exact=True)


def _sorts(spark, df) -> int:
    """Sorts of the plan that runs, each of which holds a task's rows."""
    df.toArrow()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Sort [")


def test_streaks_and_ranks_share_an_order(spark, sf_dir):
    from tidepanel.queries import queries

    assert _sorts(spark, queries()["ordered_means"](spark, sf_dir)) <= 2
    assert _sorts(spark, queries()["section_ranks"](spark, sf_dir)) <= 9


def test_exact_medians(spark):
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"k": rng.integers(0, 4, 3000), "v": np.where(rng.random(3000) < 0.5, 7.0, rng.normal(7, 1, 3000).round(3))})
    rows.loc[len(rows)] = (9, 1.5)
    df = spark.createDataFrame(rows.astype({"k": int}))
    got = {r["k"]: r["median"] for r in medians.exact_medians(df, "v", ("k",), 16).collect()}
    assert got == rows.groupby("k")["v"].median().to_dict()
    assert medians.exact_medians(df, "v", (), 16).first()["median"] == rows["v"].median()
    assert medians.exact_medians(df.where("v is null"), "v").first()["median"] is None


def test_stream_pieces_are_written_by_many_tasks(spark, sf_dir, monkeypatch):
    from tidepanel.queries import streams

    seen = []
    monkeypatch.setattr(streams.positions, "bar_stream", lambda spark, folder, *_: seen.append(len(spark.read.parquet(folder).inputFiles())))
    rows = spark.range(4000).repartition(4).selectExpr("id as stock_id", "timestamp_ntz'1994-01-01 00:00:00' as date", "1.0D as open", "1.0D as close", "0.5D as score")
    from tidepanel.sources.tables import shared_folder

    streams._runs(rows, f"{shared_folder(spark)}/pieces", lambda stream: None)
    assert seen[0] > 1


def test_lines_of_as_many_pivots_are_fitted_at_once():
    from tidepanel.plans import lines

    x = np.random.default_rng(6).uniform(900, 2100, 533).round(2)
    pivots = lines.extremes(x, 5, 1, False)
    found = list(lines.lines(pivots, x, 30, 120, 5, 3))
    assert len(found) == len({f.pivots.shape[1] for f in found}) and sum(len(f.start) for f in found) > 3 * len(found)
    for f in found:
        for held, slope, r2, rest in zip(f.pivots, f.slope, f.r2, f.rest):
            z, y = held - held.mean(), x[held] - x[held].mean()
            assert slope == (z * y).sum() / (z * z).sum() and r2 == 1 - (rest * rest).sum() / (y**2).sum()


def test_counts_of_drawn_splits_move_as_blocks(spark, monkeypatch):
    """However many tasks and splits there are, what the tasks give out is a row for each block of open nodes."""
    from tidepanel.operators import extra_trees as et

    rng = np.random.default_rng(10)
    rows = spark.createDataFrame([(float(v), float(w), int(v + w > rng.normal())) for v, w in rng.normal(size=(400, 2))], "a double, b double, y int")
    kind, moved = type(rows), []
    group = kind.groupBy
    monkeypatch.setattr(kind, "groupBy", lambda self, *keys: (moved.append((self.count(), self.rdd.getNumPartitions())) if keys in (("start",), ("slot", "cell")) else None) or group(self, *keys))
    et.fit_extra_trees(rows.repartition(40), ["a", "b"], "y", trees=5, depth=3, leaf=10)
    tasks = 2 * spark.sparkContext.defaultParallelism
    assert len(moved) == 3 and all(n <= parts <= tasks for n, parts in moved)


def test_training_medians_and_scores(spark, monkeypatch):
    """No task takes all values for a median, and evaluation scores each row once."""
    from tidepanel.operators import ml

    rows = spark.createDataFrame([(float(i % 7), float(i) if i % 3 else None, None) for i in range(60)], "x double, y double, z double")
    monkeypatch.setattr(ml.F, "percentile", None)
    found = ml.fit_statistics(rows, ["x", "y", "z"])
    assert (found["x"][0], found["y"][0], found["z"]) == (3.0, 30.0, (0.0, 0.0, 1.0))
    seen = spark.sparkContext.accumulator(0)

    def score(i):
        seen.add(1)
        return i / 60

    scored = spark.range(60).withColumn("score", F.udf(score, "double")("id")).withColumn("label", (F.col("id") % 2).cast("double")).withColumn("split", F.when(F.col("id") < 30, "train").otherwise("test"))
    assert [r.n for r in ml.evaluate(scored, "label", ["train", "test"]).collect()] == [30, 30] and seen.value == 60


def test_conditions_are_packed_where_they_lie(spark, sf_dir):
    """No row moves for the bit index, and the bars' returns come along with their candles instead of by a join."""
    from tidepanel.operators import conditions
    from tidepanel.queries import queries

    rows = spark.range(100).selectExpr("cast(id % 2 as int) as a", "cast(id as double) as r")
    index = conditions.bit_index(rows, ["a"], "r", block_rows=30)
    assert "Exchange" not in index._jdf.queryExecution().executedPlan().toString() and conditions.single_counts(index, ["a"]) == {"a": 50}
    assert "Join" not in queries()["candle_statistics"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in queries()["named_patterns"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_merged_families_take_one_group(spark, sf_dir):
    """What hangs on one entity comes from one group of its bars; only the index's row per date is joined, and it is broadcast."""
    from tidepanel.queries import queries

    plan = _plan(queries()["merged_families"](spark, sf_dir))
    assert plan.count("FlatMapGroupsInArrow") == 1 and plan.count("Join ") == 1 and "strategy=broadcast" in plan


def test_flows_come_with_their_bars(spark, sf_dir):
    from tidepanel.sources import panel

    want = panel.bars(spark, sf_dir).join(panel.flows(spark, sf_dir), ["stock_id", "date"], "left")
    got = panel.bars_with_flows(spark, sf_dir)
    assert "Join " not in _plan(got) and got.columns == want.columns
    a, b = (d.toPandas().sort_values(["stock_id", "date"], ignore_index=True) for d in (got, want))
    pd.testing.assert_frame_equal(a, b, check_exact=True)


def test_growth_is_told_by_whole_months():
    """Growth over the row of twelve months before, from its announcement on: the tenth of the month after."""
    from tidepanel.plans import families

    months = np.arange("1995-01", "1996-04", dtype="datetime64[M]")
    at = np.sort(np.concatenate((months.astype("datetime64[D]") + 9, months.astype("datetime64[D]") + 8))).astype("datetime64[us]")
    amount = np.repeat(np.where(months >= np.datetime64("1996-02"), 900.1, 600.3), 2)
    found = families.GROWTH.compute({"date": at, "amount": amount})["revenue_pos_months_1d"]
    assert found.mask[:3].all() and not found.mask[3:].any() and found[3:].tolist() == [False] * 26 + [True]
    found = families.GROWTH.compute({"date": at, "amount": np.where(at < np.datetime64("1995-02"), np.nan, amount)})["revenue_pos_months_1d"]
    assert found[-1] == 1


def test_no_expression_stands_on_a_group_of_many_columns(spark, sf_dir):
    from tidepanel.queries import queries

    for name in ("merged_families", "chip_family", "true_range_family"):
        assert _plan(queries()[name](spark, sf_dir)).startswith("FlatMapGroupsInArrow"), name


def test_candles_are_told_in_one_group(spark, sf_dir):
    from tidepanel.queries import queries

    plan = _plan(queries()["candle_family"](spark, sf_dir))
    assert plan.startswith("FlatMapGroupsInArrow") and "Window" not in plan


def test_candles_with_unknown_prices_equal_sql(spark, tmp_path):
    """Narrow prices, so that many patterns stand, some of them unknown."""
    import duckdb

    from tidepanel.queries import oracle_sql, queries

    rng = np.random.default_rng(12)
    n = 6000
    rows = pd.DataFrame({"l_suppkey": rng.integers(1, 4, n), "l_orderkey": np.arange(n), "l_partkey": 1, "l_linenumber": 1, "l_quantity": np.where(rng.random(n) < 0.01, np.nan, 1.0), "l_extendedprice": 20.0 + rng.integers(0, 9, n)})
    rows["l_shipdate"] = pd.Timestamp("2001-01-01") + pd.to_timedelta(rng.integers(0, 800, n), "D")
    df = spark.createDataFrame(rows).withColumns({"l_quantity": F.nanvl("l_quantity", F.lit(None)), "l_shipdate": F.col("l_shipdate").cast("timestamp_ntz")})
    df.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    got, want = queries()["candle_family"](spark, str(tmp_path)).toPandas(), duck.sql(oracle_sql()["candle_family"]).df()
    a, b = (d.sort_values(["stock_id", "date"], ignore_index=True)[sorted(d.columns)] for d in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
    assert (a["cdlhikkake"].abs() == 200).any()


def test_oscillators_are_told_in_one_group(spark, sf_dir):
    from tidepanel.queries import queries

    plan = _plan(queries()["oscillator_family"](spark, sf_dir))
    assert plan.startswith("FlatMapGroupsInArrow") and "Window" not in plan


def test_scored_returns_take_one_pass(spark, sf_dir):
    from tidepanel.queries.simulation import _scored

    plan = _plan(_scored(spark, sf_dir))
    assert "Join " not in plan and plan.count("lineitem") + plan.count("Relation [") == 1


def test_classes_are_searched(spark):
    bounds = [-1.0, 0.0, 0.5, 2.0]
    values = [-2.0, -1.0, -0.5, 0.0, 0.25, 0.5, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "x double").withColumn("c", medians.class_of("x", bounds))
    assert [r["c"] for r in df.collect()] == [sum(b < v for b in bounds) for v in values]
    assert "lambda" not in _plan(df)


def _odd_lines(spark, path, n=6000):
    """Order lines of few suppliers with unknown quantities, and of unknown suppliers; sums of prices are exact in any order."""
    rng = np.random.default_rng(13)
    rows = pd.DataFrame({"l_suppkey": rng.integers(1, 4, n).astype(float), "l_orderkey": np.arange(n), "l_partkey": 1, "l_linenumber": rng.integers(1, 5, n), "l_quantity": np.where(rng.random(n) < 0.01, np.nan, rng.choice([1, 2, 4], n)), "l_extendedprice": 20.0 + rng.integers(0, 9, n)})
    rows["l_suppkey"] = np.where(rng.random(n) < 0.05, np.nan, rows["l_suppkey"])
    rows["l_shipdate"] = pd.Timestamp("2001-01-01") + pd.to_timedelta(rng.integers(0, 800, n), "D")
    rows["l_returnflag"], rows["l_linestatus"] = rng.choice(list("ANR"), n), rng.choice(list("OF"), n)
    df = spark.createDataFrame(rows).withColumns({"l_quantity": F.nanvl("l_quantity", F.lit(None)), "l_suppkey": F.nanvl("l_suppkey", F.lit(None)).cast("long"), "l_shipdate": F.col("l_shipdate").cast("timestamp_ntz")})
    df.coalesce(1).write.parquet(f"{path}/lineitem.parquet")


@pytest.mark.parametrize("name", ["named_patterns", "joint_verdicts"])
def test_conditions_with_unknown_values_equal_sql(spark, tmp_path, name):
    import duckdb

    from tidepanel.queries import oracle_sql, queries

    _odd_lines(spark, tmp_path)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    got, want = queries()[name](spark, str(tmp_path)).toPandas(), duck.sql(oracle_sql()[name]).df()
    a, b = (d.sort_values(["stock_id", "date"], ignore_index=True)[sorted(d.columns)] for d in (got, want))
    pd.testing.assert_frame_equal(a, b, check_dtype=False)
    assert len(a) > 2


def test_verdicts_deal_the_lines_once_and_leave_no_bits(spark, sf_dir, monkeypatch):
    """One pass over the lines tells all conditions, and what is stored of every bar is gone when the verdicts are told."""
    import os

    from tidepanel.queries import analytics, queries
    from tidepanel.sources.tables import shared_folder

    seen, stored = [], analytics.stored
    monkeypatch.setattr(analytics, "stored", lambda df, label: seen.append(_plan(df)) or stored(df, label))
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    queries()["joint_verdicts"](spark, sf_dir)
    assert sum(p.count("Relation [l_orderkey") for p in seen) == 1 and not any("Join " in p or "Union" in p for p in seen)
    assert {x.split("-")[0] for x in set(os.listdir(folder)) - before} <= {"last", "greedy"}


def test_bits_of_words_are_flags(spark):
    from tidepanel.operators import conditions

    rows = spark.range(200).selectExpr("id % 8 as word", "if(id % 5 = 0, null, id % 3) as r", *[f"cast(id % 8 >> {k} & 1 as int) as f{k}" for k in range(3)])
    names = ["f2", "f0", "f1"]
    flags, words = (conditions.bit_index(rows, names, "r", 64, w).collect() for w in (None, {n: ("word", int(n[1])) for n in names}))
    assert flags == words
