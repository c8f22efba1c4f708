"""Operators against plain restatements and on their edge cases."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepanel.functions.columns import clip, flag, parse_number, chosen, flag_of, number_of
from tidepanel.operators import joins, labels, quality, simulation, windows
from tidepanel.operators.recursive import ewm, wilder
from tidepanel.plans import lines
from tidepanel.sources import tables
from tidepanel.sources.tables import keep_last, promote, read_or_empty


def day(i):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=i)


def panel(spark, closes, name="close"):
    rows = [(s, day(i), None if c is None else float(c)) for s, values in closes.items() for i, c in enumerate(values)]
    return spark.createDataFrame(rows, f"stock_id long, date timestamp_ntz, {name} double")


def column(df, name, stock=1):
    return [r[name] for r in df.where(f"stock_id = {stock}").orderBy("date").collect()]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.none(), st.floats(-100, 100)), max_size=40), st.sampled_from([0.1, 1 / 3, 2 / 13]), st.integers(1, 5))
def test_ewm_equals_pandas(values, alpha, least):
    x = np.array([np.nan if v is None else v for v in values], float)
    want = pd.Series(x).ewm(alpha=alpha, adjust=False, min_periods=least).mean().to_numpy() if len(x) else x
    np.testing.assert_allclose(ewm(x, alpha, least), want, rtol=1e-9, atol=1e-9)


def test_wilder_seed_and_short_series():
    assert np.isnan(wilder(np.array([1.0, 2.0]), 3)).all()
    np.testing.assert_allclose(wilder(np.array([1.0, 2.0, 3.0, 6.0]), 3)[2:], [2.0, (2 * 2 + 6) / 3])


def test_lags_stay_inside_entities(spark):
    df = panel(spark, {7: [3.5, 0.25, 8.0, 1.0], 1: [64.0], 4: [-2.0, 6.0]}).withColumn("l", windows.lag(F.col("close")))
    assert [column(df, "l", i) for i in (7, 1, 4)] == [[None, 3.5, 0.25, 8.0], [None], [None, -2.0]]


def test_rolling_counts_known_values(spark):
    df = panel(spark, {1: [1, None, 3, 4]}).withColumn("m", windows.mean(F.col("close"), 2, 1)).withColumn("full", windows.mean(F.col("close"), 2))
    assert column(df, "m") == [1, 1, 3, 3.5] and column(df, "full") == [None, None, None, 3.5]


def test_rank_in_window_has_mean_ties(spark):
    df = panel(spark, {1: [1, 2, 2, None, 0]}).withColumn("r", windows.rank_in_window(F.col("close"), 5, 1))
    assert column(df, "r") == [1.0, 1.0, pytest.approx(2.5 / 3), None, 0.25]


def test_streak_and_recency(spark):
    df = windows.with_streak(panel(spark, {1: [1, 2, 3, 2, 3]}), F.col("close") > windows.lag(F.col("close")), "s")
    assert column(df, "s") == [0, 1, 2, 0, 1]
    df = windows.bars_since(panel(spark, {1: [0, 5, 1, 1]}), F.col("close") > 4, "b")
    assert column(df, "b") == [None, 0, 1, 2]


def test_asof_takes_exact_matches_and_leaves_earlier_null(spark):
    left = panel(spark, {1: [1, 1, 1], 2: [1]})
    right = spark.createDataFrame([(1, day(1), 7.0)], "stock_id long, at timestamp_ntz, v double")
    assert column(joins.asof_backward(left, right, "at", ["v"]), "v") == [None, 7.0, 7.0]
    assert joins.asof_backward(left, right.limit(0), "at", ["v"]).count() == 4


def test_later_product_is_strict_and_skips_bad_ratios(spark):
    prices = panel(spark, {1: [1, 1, 1]})
    events = spark.createDataFrame([(1, day(1), 0.5), (1, day(2), 0.1), (1, day(2), 0.0), (1, day(2), None)], "stock_id long, date timestamp_ntz, ratio double")
    assert column(joins.later_product(prices, events), "factor") == pytest.approx([0.05, 0.1, 1.0])


def test_held_on_is_half_open(spark):
    positions = spark.createDataFrame([(1, day(0), day(2)), (2, day(1), None)], "stock_id long, buy_date timestamp_ntz, sell_date timestamp_ntz")
    days = spark.createDataFrame([(day(i),) for i in range(4)], "date timestamp_ntz")
    held = sorted((r.stock_id, r.date.day) for r in joins.held_on(positions, days).collect())
    assert held == [(1, 1), (1, 2), (2, 2), (2, 3), (2, 4)]


def test_range_joins_over_every_bar(spark, sf_dir):
    from tidepanel.queries import queries
    from tidepanel.sources.panel import actions, bars

    prices = bars(spark, sf_dir).select("stock_id", "date", "close")
    frame = prices.toPandas().sort_values(["stock_id", "date"])
    events = actions(prices).toPandas()
    events = events[(events.ratio > 0) & np.isfinite(events.ratio)]
    got = {(r.stock_id, r.date): r.factor for r in queries()["range_adjust_factor"](spark, sf_dir).collect()}
    want = {(b.stock_id, b.date.to_pydatetime()): events.ratio[(events.stock_id == b.stock_id) & (events.date > b.date)].prod() for b in frame.itertuples()}
    assert got.keys() == want.keys() and min(d for _, d in got).year < 1998
    assert all(got[k] == pytest.approx(v, rel=1e-5) for k, v in want.items())

    frame["sell"] = frame.groupby("stock_id").date.shift(-10)
    held = {r.date: (r.held, r.first_id, r.last_buy) for r in queries()["interval_holdings"](spark, sf_dir).collect()}
    assert len(held) == frame.date.nunique()
    for d in frame.date.unique():
        on = frame[(frame.date <= d) & (frame.sell.isna() | (d < frame.sell))]
        assert held[pd.Timestamp(d).to_pydatetime()] == (len(on), on.stock_id.min(), on.date.max().to_pydatetime())


def test_labels_stay_null_at_the_tail(spark):
    df = panel(spark, {1: range(1, 31)}).withColumn("up", (F.col("close") > windows.lag(F.col("close"))).cast("int"))
    got = column(df.withColumn("y", labels.up_days(F.col("close"), F.col("up"))), "y")
    assert got[:10] == [1] * 10 and got[10:] == [None] * 20


def test_barrier_outcomes(spark):
    df = panel(spark, {1: [100, 101, 120, 100], 2: [100, 90, 80, 70, 60], 3: [100, 100]}).withColumn("m", F.lit(95.0))
    y = df.withColumn("y", labels.barrier(F.col("close"), F.col("m"), 0.1, 3))
    assert column(y, "y")[0] == 1 and column(y, "y", 2)[0] == 0 and column(y, "y", 3) == [None, None]


def test_zigzag_on_a_v_and_flat():
    v = np.concatenate([np.linspace(100, 80, 20), np.linspace(80, 100, 20)])
    found = labels.zigzag(v)
    assert found[0] == -1 and found[20] == 1 and np.abs(found).sum() == 2  # the first bar is the first extreme, of equal lows the later
    assert not labels.zigzag(np.full(50, 100.0)).any() and len(labels.zigzag(np.zeros(0))) == 0


def test_swing_states_part_at_bad_values_and_absorb_short_runs():
    wave = np.concatenate([np.linspace(50, 100, 60), np.linspace(100, 50, 60)] * 4)
    whole = labels.swing_states(wave, 0.1, 0.0, shortest=100)
    assert set(whole["state"][15:400].tolist()) <= {1.0, -1.0} and np.isnan(whole["state"][-15:]).all() and np.isnan(whole["phase"][-70:]).all()
    cut = wave.copy()
    cut[90] = np.nan
    parted = labels.swing_states(cut, 0.1, 0.0, shortest=100)
    assert np.isnan(parted["state"][:91]).all() and not np.isnan(parted["state"][200:300]).any()
    assert labels.absorb(np.array([9, 1, 1, 1, -1, 1, 1, 9]), 2).tolist() == [9, 1, 1, 1, 1, 1, 1, 9] and labels.absorb(np.array([0, 1, 1, 9]), 2).tolist() == [1, 1, 1, 9]


def test_column_rules(spark):
    row = spark.sql("select '1,234.5' a, '--' b, 'x' c, cast(null as double) d").select(parse_number(F.col("a")), parse_number(F.col("b")), parse_number(F.col("c")), flag(F.col("d") > 1), clip(F.col("d"), 0.0, 1.0)).first()
    assert tuple(row) == (1234.5, None, None, 0, None)


def test_trend_scan_follows_the_line(spark):
    rng = np.random.default_rng(3)
    noisy = 50 + np.cumsum(rng.normal(size=40))
    df = panel(spark, {1: range(1, 31), 2: range(30, 0, -1), 3: noisy.tolist()}).withColumn("y", labels.trend_scan(F.col("close")))
    assert column(df, "y") == [1] * 20 + [None] * 10 and column(df, "y", 2) == [-1] * 20 + [None] * 10
    want = []
    for i in range(30):
        best = (-1.0, 0)
        for n in range(3, 11):
            slope, middle = np.polyfit(np.arange(n) - (n - 1) / 2, noisy[i : i + n], 1)
            x = np.arange(n) - (n - 1) / 2
            t = abs(slope) / np.sqrt(((noisy[i : i + n] - middle - slope * x) ** 2).sum() / max(n - 2, 1) / (x * x).sum())
            best = max(best, (t, int(np.sign(slope))), key=lambda b: b[0])
        want.append(best[1])
    assert column(df, "y", 3) == want + [None] * 10


def test_embargo_and_training_statistics(spark):
    from tidepanel.operators import ml

    rows = spark.createDataFrame([(day(i), float(i) if i % 2 else None) for i in range(10)], "date timestamp_ntz, x double")
    df = rows.withColumn("split", ml.split(F.col("date"), "2024-01-05", "2024-01-08", 1))
    assert [r.split for r in df.orderBy("date").collect()] == ["train"] * 4 + [None, "valid", "valid", None, "test", "test"]
    stats = ml.fit_statistics(df.where("split = 'train'"), ["x"])
    assert stats["x"][:2] == (2.0, 2.0)
    assert ml.apply_statistics(df, stats).where("x is null").count() == 0


def test_stale_tables():
    from tidepanel.operators.lineage import stale

    graph = {"price": [], "features": ["price"], "labels": ["price"], "scores": ["features"]}
    now = {"price": "a", "features": "f"}
    assert stale(graph, {}, now) == ["features", "labels", "scores"]
    assert stale(graph, {"features": {"price": "old"}, "labels": {"price": "a"}, "scores": {"features": "f"}}, now) == ["features", "scores"]


def test_trend_lines_by_brute_force():
    """Lines fitted anew at every bar against those fitted once for their stretch."""
    rng = np.random.default_rng(5)
    for n in (0, 3, 12, 330):
        close = np.round(30 + np.cumsum(rng.normal(size=n)) * 0.4, 1)
        high, low, volume = close + rng.integers(0, 4, n) / 10, close - rng.integers(0, 4, n) / 10, rng.integers(1, 90, n).astype(float)
        usual = np.array([volume[max(0, i - 19) : i + 1].mean() if i >= 4 else np.nan for i in range(n)])
        got = lines.boundaries({"close": close, "high": high, "low": low, "volume": volume, "usual": usual})
        above, broken = None, []
        for t in range(30, n):
            ends = {}
            for side, x, sign in (("resist", high, 1), ("support", low, -1)):
                held = [i for i in range(5, n - 5) if sign * x[i] == max(sign * x[i - 5 : i + 6]) and t - 120 <= i <= t - 5]
                if len(held) < 3:
                    assert np.isnan(got[f"{side}_slope"][t])
                    continue
                slope, intercept = np.polyfit(held, x[held], 1)
                intercept += sign * max(sign * (x[i] - slope * i - intercept) for i in held)
                ends[side] = (slope, intercept, slope * t + intercept)
                touches = sum(abs(close[j] - slope * j - intercept) / abs(slope * j + intercept) < 0.01 for j in range(max(0, t - 120), t + 1) if j not in held)
                assert got[f"{side}_slope"][t] == pytest.approx(slope / close[t], abs=1e-9) and got[f"{side}_pivots"][t] == len(held) and abs(got[f"{side}_touches"][t] - touches) <= 1
                assert got[f"{side}_r2"][t] == pytest.approx(np.corrcoef(held, x[held])[0, 1] ** 2 if np.ptp(x[held]) else 0.0, abs=1e-6)
                assert got[f"{side}_dist"][t] == pytest.approx(close[t] / ends[side][2] - 1, abs=1e-9)
            if len(ends) == 2:
                width = ends["resist"][2] - ends["support"][2]
                assert got["channel_width"][t] == pytest.approx(width / close[t], abs=1e-9) if width > 0.001 * close[t] else np.isnan(got["channel_width"][t])
                turn = ends["support"][0] - ends["resist"][0]
                apex = (ends["resist"][1] - ends["support"][1]) / turn - t
                assert np.isnan(got["apex_bars"][t]) if abs(apex) > 500 else got["apex_bars"][t] == pytest.approx(apex, rel=1e-5)
                assert got["is_triangle"][t] == (ends["support"][0] > 0 > ends["resist"][0] and 5 <= apex <= 60)
            if "resist" in ends:
                now = close[t] > ends["resist"][2]
                assert got["resist_break"][t] == (above is False and now)
                if above is False and now:
                    broken.append((t, ends["resist"][2]))
                above = bool(now)
            assert got["days_since_break"][t] == pytest.approx(np.log1p(t - broken[-1][0])) if broken else np.isnan(got["days_since_break"][t])
            assert got["false_breaks_20d"][t] == sum(t - b <= 20 and b < t and close[t] < x for b, x in broken)


def test_swing_lines_by_brute_force():
    rng = np.random.default_rng(6)
    n = 420
    close, volume = np.round(40 + np.cumsum(rng.normal(size=n)) * 0.5, 1), rng.integers(1, 90, n).astype(float)
    high, low, usual = close + 0.2, close - 0.3, np.full(n, 30.0)
    got = lines.swing_lines({"close": close, "high": high, "low": low, "volume": volume, "usual": usual})
    peak = lambda i, s, sign: s <= i < n - s and sign * close[i] == max(sign * close[i - s : i + s + 1]) and sign * close[i] > sign * close[i - 1]
    assert np.isnan(got["support_touches"][:260]).all()
    for t in range(260, n):
        held = [i for i in range(t - 120, t - 4) if peak(i, 5, -1)]
        if len(held) >= 2:
            slope, intercept = np.polyfit(held, close[held], 1)
            line = slope * t + intercept
            assert got["support_dist"][t] == pytest.approx(close[t] / line - 1) and got["support_slope"][t] == pytest.approx(slope / line, abs=1e-9)
            assert got["support_touches"][t] == sum(abs(close[i] - slope * i - intercept) / close[i] < 0.01 for i in held) and got["support_days"][t] == pytest.approx(np.log1p(t - held[0]))
        else:
            assert got["support_touches"][t] == got["support_days"][t] == 0 and np.isnan(got["support_dist"][t])
        big = [i for i in range(t - 1) if peak(i, 2, 1) and volume[i] / 30 >= 2]
        for k in (1, 2, 3):
            assert got[f"vh{k}_dist"][t] == pytest.approx(close[t] / high[big[-k]] - 1) if len(big) >= k else np.isnan(got[f"vh{k}_dist"][t])
        assert got["is_above_vh1"][t] == (len(big) > 0 and close[t] > close[big[-1]])


def test_tables_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(1, "a", 9), (2, "b", 9)], "k int, v string, orphan int")
    tables.upsert(spark, path, old, ["k"])
    declared = spark.createDataFrame([], "k int, v string, more double").schema
    tables.upsert(spark, path, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"], declared)
    got = spark.read.parquet(path)
    assert got.columns == ["k", "v", "more"] and sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t"]
    (tmp_path / "t").rename(tmp_path / "t.new-1")  # a run that ended between the moves
    assert tables.recover_table(spark, path) and spark.read.parquet(path).count() == 3 and not tables.recover_table(spark, path)
    assert tables.oversized(spark, path, 1 << 30, 1) == [path] and tables.oversized(spark, path, 1 << 30, 1 << 30) == []


def test_late_rows_of_a_stream_replace_earlier_ones(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in ([(1, 10), (2, 20)], [(2, 21), (3, 30)]):
        spark.createDataFrame(rows, "k int, v int").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k int, v int").parquet(source)
        tables.upsert_stream(stream, path, ["k"], str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 10), (2, 21), (3, 30)]


def test_csv_with_dates(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,close\n2024-01-02,1.5\nbad,x\n")
    rows = tables.read_csv(spark, str(tmp_path / "a.csv"), "date timestamp_ntz, close double").collect()
    assert [(r.date, r.close) for r in rows] == [(dt.datetime(2024, 1, 2), 1.5), (None, None)]


def test_columns_that_may_be_missing(spark):
    df = spark.createDataFrame([("0.7", 1.0), ("x", None)], "a string, label_b double")
    got = df.select(flag_of(df, "a").alias("a"), flag_of(df, "none").alias("b"), number_of(df, "a").alias("c")).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0.7), (0, 0, None)]
    assert chosen(df, ("a",), least=1) == ["a"] and chosen(df, ("z",)) == ["a"]


def test_running_sums_by_buckets(spark):
    rng = np.random.default_rng(4)
    scores = np.unique(np.round(rng.normal(size=500), 3))
    rows = [(float(s), int(k)) for s, k in zip(scores, rng.integers(1, 9, len(scores)))]
    df = spark.createDataFrame(rows, "score double, k long")
    for falling in (True, False):
        order = sorted(rows, reverse=falling)
        want = {s: sum(k for _, k in order[:i]) for i, (s, _) in enumerate(order)}
        got = simulation.running_sums(df, "score", ["k"], falling, buckets=7).collect()
        assert {r.score: r._before_k for r in got} == want
    one = simulation.running_sums(spark.createDataFrame([(0.5, 3)], "score double, k long"), "score", ["k"], True).first()
    assert one._before_k == 0 and simulation.running_sums(df.limit(0), "score", ["k"], True).count() == 0


def test_equity_statistics(spark):
    worth = [1.0, 1.1, 0.99, 1.2, 0.9]
    curve = spark.createDataFrame([(day(i), x - 1) for i, x in enumerate(worth)], "date timestamp_ntz, equity double")
    row = simulation.equity_statistics(curve).first()
    moved = np.diff(worth) / np.array(worth[:-1])
    assert row.total_return == pytest.approx(-0.1) and row.max_drawdown == pytest.approx(0.9 / 1.2 - 1) and row.sharpe == pytest.approx(moved.mean() / moved.std(ddof=1) * np.sqrt(250))


def test_areas_under_curves_with_ties(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.8, 1), (0.3, 0), (0.1, 0), (0.05, 1)]
    row = simulation.auc(spark.createDataFrame(rows, "score double, label int"), "score", "label").first()
    pairs = [(a > b) + 0.5 * (a == b) for a, x in rows if x for b, y in rows if not y]
    precise = sum(sum(x for s, x in rows if s >= t) / sum(s >= t for s, _ in rows) for t, y in rows if y)
    assert row.auc == pytest.approx(np.mean(pairs)) and row.pr_auc == pytest.approx(precise / 4) and row.pr_lift == pytest.approx(precise / 4 / (4 / 7))


def test_score_grid_is_score_exit_for_each_pair(spark):
    rng = np.random.default_rng(9)
    rows = [(s, day(i), float(rng.uniform(10, 20)), float(rng.random())) for s in (1, 2) for i in range(60)]
    df = spark.createDataFrame(rows, "stock_id long, date timestamp_ntz, open double, score double")
    got = simulation.score_grid(df, [0.7, 0.9], [0.2, 0.8], 10).collect()
    for buy, sell in ((0.7, 0.2), (0.9, 0.2), (0.9, 0.8)):
        want = sorted(r.ret for r in simulation.score_exit(df, buy, sell, 10).collect())
        assert sorted(r.ret for r in got if (r.buy, r.sell) == (buy, sell)) == pytest.approx(want)
    assert not any(r.buy <= r.sell for r in got)
    with pytest.raises(ValueError):
        simulation.score_exit(df, 0.2, 0.8)
