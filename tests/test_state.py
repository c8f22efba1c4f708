"""Streamed positions, tables that grow by their tails, running medians and joint conditions against plain restatements."""

import os
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampNTZType

from tidepanel.operators import conditions
from tidepanel.operators import labels as lb
from tidepanel.operators import simulation as sim
from tidepanel.operators import windows as w
from tidepanel.operators.medians import threshold_medians
from tidepanel.sources import incremental
from tidepanel.streaming import positions

START = datetime(2001, 1, 1)
STREAM = "stock_id long, date timestamp, open double, close double, score double, buy_price double"


def random_panel(rng, entities=4, most=120):
    """Bars with gaps, unknown and worthless opens, unknown scores and many signals."""
    rows = []
    for s in range(entities):
        at = START
        for _ in range(rng.randint(1, most)):
            at += timedelta(days=rng.choice([1, 1, 1, 2, 9]))
            rows.append((s, at, rng.choice([None, 0.0, *[round(rng.uniform(5, 9), 3)] * 12]), rng.choice([None, *[round(rng.uniform(5, 9), 3)] * 9]), rng.choice([None, 0.1, 0.3, 0.5, 0.7, 0.95, 0.99])))
    return rows


def arrivals(rng, rows, files, late):
    """The rows in files by time, some in the file after if the stream's delay allows for it."""
    days = sorted({r[1] for r in rows})
    cuts = [days[len(days) * k // files] for k in range(1, files)]
    out = [[] for _ in range(files)]
    for r in rows:
        k = sum(r[1] >= c for c in cuts)
        if k + 1 < files and cuts[k] - r[1] < timedelta(days=late) and rng.random() < 0.4:
            k += 1
        out[k].append(r)
    for f in out:
        rng.shuffle(f)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_streamed_exits_equal_the_batch(spark, tmp_path, seed):
    """Late and repeated bars, in files that a stream takes in one run each, starting again from its state."""
    rng = random.Random(seed)
    rows = random_panel(rng)
    folder, end = str(tmp_path), (-1, max(r[1] for r in rows) + timedelta(days=99), None, None, None)
    for files in (arrivals(rng, rows, 3, 20),):
        for k, some in enumerate(files):
            given = [*some, *some[:3], *([end] if k == 2 else [])]
            spark.createDataFrame([(*r, None) for r in given], STREAM).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            positions.run_score_exits(positions.bar_stream(spark, f"{folder}/in", STREAM, "30 days"), 0.95, 0.3, 7, folder)
    panel = spark.createDataFrame([r[:3] + r[4:] for r in rows], "stock_id long, date timestamp_ntz, open double, score double")
    want = sim.score_exit(panel, 0.95, 0.3, 7)
    got = positions.score_trades(spark, folder).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 10


def test_streamed_exits_share_their_state(spark, tmp_path):
    """Many entities, one of them unknown, are a few entries of state, in as many buckets as the first run settled."""
    rng = random.Random(4)
    rows = random_panel(rng, 40, 60)
    folder, end = str(tmp_path), (-1, max(r[1] for r in rows) + timedelta(days=99), None, None, None)
    for k, some in enumerate(arrivals(rng, rows, 2, 20)):
        given = [(None if r[0] == 7 else r[0], *r[1:], None) for r in [*some, *([end] if k else [])]]
        spark.createDataFrame(given, STREAM).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        positions.run_score_exits(positions.bar_stream(spark, f"{folder}/in", STREAM, "30 days"), 0.95, 0.3, 7, folder, 3 + k)
    want = sim.score_exit(spark.createDataFrame([r[:3] + r[4:] for r in rows], "stock_id long, date timestamp_ntz, open double, score double"), 0.95, 0.3, 7)
    got = positions.score_trades(spark, folder).select(*want.columns)
    assert got.where("stock_id is null").count()
    assert sorted(map(str, got.fillna(7, ["stock_id"]).collect())) == sorted(map(str, want.collect()))
    assert positions.state_rows(spark, folder, "line").count() == 3 + 1


def test_bars_reach_the_state_in_blocks(spark):
    """Not a row for each bar: a block for each task and bucket, in the order of arrival."""
    df = spark.range(5000).repartition(2).selectExpr("if(id = 9, null, id % 50) as stock_id", "timestamp_millis(id) as date", "if(id % 3 = 0, null, 1.0D) as open", "cast(id as double) as score")
    got = positions._packed(df, 4).collect()
    bars = [(r.bucket, *b) for r in got for b in np.frombuffer(r.bars, positions.BAR).tolist()]
    assert len(got) <= 2 * 5 and sorted(b[2] for b in bars) == list(range(5000)) and [b[2] for b in bars if b[0] == positions.KEYLESS] == [9]
    assert all((o != o) == (ms % 3 == 0) and score == ms and (ms == 9 or entity == ms % 50) for _, entity, ms, o, score in bars)
    assert len({b[:2] for b in bars if b[2] != 9}) == 50


def test_tracked_positions_equal_the_batch(spark, tmp_path):
    """Purchases that come after their bars and bars that come late."""
    rng = random.Random(5)
    rows = random_panel(rng)
    folder = str(tmp_path)
    bought = [(s, max(r[1] for r in rows if r[0] == s) - timedelta(days=40 + s), None, None, None, 7.0 + s) for s in range(4)] + [(0, START, None, None, None, 1.5)]
    for some in arrivals(rng, [(*r, None) for r in rows] + bought, 3, 20):
        spark.createDataFrame([*some, *some[:4]], STREAM).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        positions.run_tracker(positions.bar_stream(spark, f"{folder}/in", STREAM, "60 days"), folder)
    panel = spark.createDataFrame([(r[0], r[1], r[3]) for r in rows], "stock_id long, date timestamp_ntz, close double")
    held = spark.createDataFrame([(b[0], b[1], b[5]) for b in bought], "stock_id long, buy_date timestamp_ntz, buy_price double")
    want = sim.track_position(panel, held, 0.2, 0.15, 0.1)
    got = positions.tracked_positions(spark, folder, 0.2, 0.15, 0.1).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


SCHEMA = StructType([StructField("stock_id", LongType()), StructField("date", TimestampNTZType()), StructField("close", DoubleType())])


def two(df):
    up = (F.col("close") > w.lag(F.col("close"))).cast("int")
    return df.select("stock_id", "date", "close", up.alias("up")).select("stock_id", "date", lb.up_days(F.col("close"), F.col("up"), 6, 3).alias("label"))


def files_of(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_tail_recompute_equals_the_whole_and_leaves_older_files(spark, tmp_path):
    """Increments, an entity that starts late, one whose bars are rare, a corrected old bar and an empty increment."""
    rng = random.Random(3)
    rows = {}
    for s, (first, step) in enumerate([(0, 1), (0, 17), (300, 1)]):
        for k in range(first, 500, step):
            rows[s, START + timedelta(days=k)] = float(rng.randint(1, 30))
    source, target = f"{tmp_path}/bars", f"{tmp_path}/labels"

    def put(new):
        frame = spark.createDataFrame([(*k, v) for k, v in new.items()], SCHEMA)
        incremental.upsert_months(spark, source, frame, ["stock_id", "date"])
        return incremental.recompute_tail(spark, source, SCHEMA, target, frame.select("stock_id", "date"), two, 6, 1)

    def told():
        return {(r.stock_id, r.date): r.label for r in spark.read.parquet(target).collect()}

    def whole(upto):
        frame = spark.createDataFrame([(*k, v) for k, v in rows.items() if k[1] < upto], SCHEMA)
        return {(r.stock_id, r.date): r.label for r in two(frame).collect()}

    edges = [START, START + timedelta(days=200), START + timedelta(days=330), START + timedelta(days=500)]
    for a, b in zip(edges, edges[1:]):
        before = files_of(target)
        month = put({k: v for k, v in rows.items() if a <= k[1] < b})
        assert told() == whole(b)
        old = {f: t for f, t in before.items() if int(f.split("month=")[1][:6]) < month.year * 100 + month.month}
        assert old.items() <= files_of(target).items() and (a == START or old)
    day = START + timedelta(days=400)
    rows[0, day] = 99.0
    assert put({(0, day): 99.0}) <= day and told() == whole(edges[-1])
    assert put({}) is None and told() == whole(edges[-1])


@pytest.mark.parametrize(("n", "kinds", "bucket_rows", "classes"), [(600, 60, 20, 16), (1500, 10**6, 100, 32), (400, 4, 30, 8), (0, 1, 10, 4)])
def test_running_medians(spark, n, kinds, bucket_rows, classes):
    """Crowded scores, equal returns, buckets of a few rows, scores with more rows than a bucket, unknown values."""
    rng = random.Random(n)
    rows = [(rng.randint(0, kinds) / kinds if rng.random() < 0.7 else 0.5, float(round(rng.gauss(0, 3), rng.choice([0, 1, 5])))) for _ in range(n)]
    given = spark.createDataFrame([*rows, (None, 1.0), (0.3, None), (float("nan"), 1.0), (0.2, float("nan"))], "s double, r double")
    got = sorted(map(tuple, threshold_medians(given, "s", "r", 5, bucket_rows, classes).collect()))
    frame = pd.DataFrame(rows, columns=["s", "r"])
    want = [(s, int((frame.s >= s).sum()), float(np.median(frame.r[frame.s >= s]))) for s in sorted(frame.s.unique())]
    assert got == [x for x in want if x[1] >= 5]


def test_greedy_conjunctions(spark):
    rng = np.random.default_rng(4)
    hits = (rng.random((900, 12)) < np.linspace(0.9, 0.1, 12)).astype(int)
    outcome = [None if i % 9 == 0 else float(rng.normal()) for i in range(900)]
    flags = [f"f{i}" for i in range(12)]
    rows = spark.createDataFrame([(*map(int, h), o) for h, o in zip(hits, outcome)], ", ".join(f"{f} int" for f in flags) + ", ret double").repartition(3)
    index = conditions.bit_index(rows, flags, "ret", block_rows=100)
    assert index.count() > 3
    known = np.array([o is not None for o in outcome])
    won = np.array([o is not None and o > 0 for o in outcome])
    assert conditions.single_counts(index, flags) == {f: int(hits[known, i].sum()) for i, f in enumerate(flags)}
    asked = [rng.permutation(12)[: rng.integers(0, 13)].tolist() for _ in range(25)] + [[], list(range(12))]
    found = conditions.greedy_conjunctions(index, spark.createDataFrame([(a,) for a in asked], "members array<int>"), 60)
    got = {tuple(r.members): (r.chosen, r.n, r.wins) for r in found.collect()}
    for a in asked:
        chosen, met, told = [], known, (None, None)
        for c in a:
            more = met & (hits[:, c] == 1)
            if more.sum() >= 60:
                chosen, met, told = [*chosen, c], more, (int(more.sum()), int((more & won).sum()))
        assert got[tuple(a)] == (chosen, *told)


def test_holding_status_lists_ids_without_a_score(spark):
    scores = spark.createDataFrame([(1, START, 0.9), (1, START + timedelta(1), 0.2), (1, START + timedelta(2), None), (2, START, 0.7), (9, START, 0.1)], "stock_id long, date timestamp_ntz, score double")
    got = {r.stock_id: (r.score, r.status) for r in sim.holding_status(spark.createDataFrame([(1,), (2,), (3,)], "stock_id long"), scores, 0.2).collect()}
    assert got == {1: (0.2, "sell"), 2: (0.7, "hold"), 3: (None, "no score")}


def test_peers_share_the_date_and_not_the_entity(spark):
    trades = spark.createDataFrame([(1, START, 0.5), (2, START, -0.1), (3, START + timedelta(1), 0.2), (4, START, None)], "stock_id long, signal_date timestamp_ntz, ret double")
    peers = spark.createDataFrame([(1, START, 0.3), (5, START, 0.1), (6, START, 0.2), (7, START, None), (3, START + timedelta(1), 0.9)], "stock_id long, signal_date timestamp_ntz, ret double")
    paired = sim.against_peers(trades, peers)
    got = {r.stock_id: (r.n_peers, r.peer_return, r.paired) for r in paired.collect()}
    assert got[1] == (2, pytest.approx(0.15), pytest.approx(0.35)) and got[2] == (3, pytest.approx(0.2), pytest.approx(-0.3))
    assert got[3] == (0, None, None) and got[4] == (3, pytest.approx(0.2), None)
    row = sim.alpha_against_peers(paired).first()
    assert (row.n_paired, row.win_vs_peer, row.median_peer_n) == (2, 0.5, 2.5) and row.alpha_median == pytest.approx(0.025) and row.peer_mean == pytest.approx(0.175)
    assert sim.alpha_against_peers(paired.limit(0)).first().n_paired == 0


def test_lines_go_on_by_their_slope(spark):
    from tidepanel.plans import lines

    found = spark.createDataFrame([(1, START, -0.5, 0.1, 0.25, None), (1, START + timedelta(1), 0.25, 0.5, -0.5, 0.0), (2, START, None, None, 0.0, 0.0)], "stock_id long, date timestamp_ntz, tl_resist_dist float, tl_resist_slope float, tl_support_dist float, tl_support_slope float")
    prices = spark.createDataFrame([(1, START, 4.0), (1, START + timedelta(1), 10.0), (2, START, 3.0)], "stock_id long, date timestamp_ntz, close double")
    days = spark.createDataFrame([(s, START + timedelta(1 + k), k) for s in (1, 2, 3) for k in (0, 1, 2)], "stock_id long, date timestamp_ntz, step int")
    got = {(r.stock_id, r.side, r.step): r.price for r in lines.lines_ahead(found, prices, days).collect()}
    assert got == {(1, "resist", 1): 13.0, (1, "resist", 2): 18.0, (1, "support", 1): 20.0, (1, "support", 2): 20.0, (2, "support", 0): 3.0, (2, "support", 1): 3.0, (2, "support", 2): 3.0}


def test_compiled_means_follow_their_definitions():
    from tidepanel.operators.recursive import ewm, wilder
    from tidepanel.plans.families import seeded_ewm

    rng = np.random.default_rng(6)
    for gaps in (0.0, 0.3):
        x = np.where(rng.random(60) < gaps, np.nan, rng.normal(size=60))
        old, weight, want = np.nan, 0.0, []
        for v in x:
            weight *= 0.75
            if v == v:
                old = v if old != old else (weight * old + 0.25 * v) / (weight + 0.25)
                weight = 1.0
            want.append(old)
        np.testing.assert_allclose(ewm(x, 0.25), want)
    x = rng.normal(size=30)
    for found, n, alpha in ((wilder(x, 5), 5, 0.2), (seeded_ewm(np.concatenate(([np.nan] * 3, x)), 5)[3:], 5, 2 / 6)):
        old = x[:5].mean()
        for i in range(5, 30):
            old += alpha * (x[i] - old)
            assert found[i] == pytest.approx(old)
        assert np.isnan(found[:4]).all() and found[4] == pytest.approx(x[:5].mean())
    assert np.isnan(wilder(np.array([1.0, np.nan, 3.0, 4.0]), 2)).all() and np.isnan(wilder(np.array([1.0, 2.0, 3.0, np.nan, 5.0]), 2)).tolist() == [True, False, False, True, True]


def test_extra_trees(spark):
    """Like a forest of the same size, the same for any dealing of rows, and every leaf's share by a recount."""
    from tidepanel.operators import extra_trees as et
    from tidepanel.operators import ml

    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 5))
    y = (x[:, 1] + 0.6 * x[:, 3] * (x[:, 0] > 0) + rng.normal(size=3000) > 0).astype(int)
    names = [f"f{k}" for k in range(5)]
    rows = spark.createDataFrame([(*map(float, r), int(v), "test" if i % 3 == 0 else "train") for i, (r, v) in enumerate(zip(x, y))], ", ".join(f"{n} double" for n in names) + ", label int, split string")
    train = rows.where("split = 'train'")
    model = et.fit_extra_trees(train, names, "label", trees=60, depth=7, leaf=20, tries=3)
    again = et.fit_extra_trees(train.repartition(7), names, "label", trees=60, depth=7, leaf=20, tries=3)
    assert [(t.feature, t.threshold, t.share) for t in model.trees] == [(t.feature, t.threshold, t.share) for t in again.trees]
    assert model.importances.sum() == pytest.approx(1) and model.importances.argmax() == 1 and model.importances[[2, 4]].max() < model.importances[3]
    forest = ml.fit_forest(train.withColumn("label", F.col("label").cast("double")), names, "label", trees=60, depth=7, leaf=20)
    scored = et.score_extra_trees(model, rows)
    found = {n: ml.auc(d.where("split = 'test'"), "score", "label").first().auc for n, d in (("extra", scored), ("forest", ml.score_forest(forest, rows, names)))}
    assert found["extra"] > 0.75 and found["extra"] > found["forest"] - 0.01
    used = np.arange(3000) % 3 != 0
    for t, at in zip(model.trees, et._places(et._arrays(model.trees), x[used])):
        assert max(t.child) <= 2**8
        for node in np.unique(at):
            assert t.feature[node] == -1 and t.share[node] == pytest.approx(y[used][at == node].mean()) and (at == node).sum() >= 20
    alone = et.fit_extra_trees(train.where("label = 1"), names, "label", trees=2)
    assert [t.share for t in alone.trees] == [[1.0], [1.0]] and et.fit_extra_trees(train.limit(0), names, "label", trees=2).trees[0].share == [0.0]


def test_shared_columns(spark, tmp_path):
    from tidepanel.sources.tables import shared_columns

    for name, schema in (("a", "x int, y double, z string"), ("b", "z string, y float, x int, w int"), ("c", "z string, x int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}")
    assert shared_columns(spark, [f"{tmp_path}/{n}" for n in "abc"]) == ["x", "z"] and shared_columns(spark, [f"{tmp_path}/a"]) == ["x", "y", "z"] and shared_columns(spark, []) == []
