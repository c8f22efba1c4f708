"""Trade simulation: entries at the next open, exits by scores or by rules, equity and performance."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import line

TRADE = "stock_id long, signal_date timestamp_ntz, buy_date timestamp_ntz, sell_date timestamp_ntz, buy_price double, sell_price double, ret double, hold int, exit_reason string"


def score_exit(panel: DataFrame, buy: float, sell: float, most: int = 250, signal: Column | None = None) -> DataFrame:
    """Every signal's own trade (a score of at least `buy`, or what `signal` tells over the panel's columns): bought at the next open, sold at the open after the first score at or below `sell`.

    panel: stock_id, date, open, score. Scores that are null decide nothing; the sale comes after `most`
    bars at the latest, and at the last bar where the data end first. No holding blocks another signal.
    """
    if buy <= sell and buy != 0:
        raise ValueError("buy must lie above sell")
    w = line()
    whole = Window.partitionBy("stock_id")
    df = panel.withColumn("i", F.row_number().over(w)).withColumn("n", F.count("*").over(whole))
    df = df.withColumn("down", F.when(F.col("score") <= sell, F.col("i")))
    df = df.withColumn("first_down", F.min("down").over(w.rowsBetween(1, most)))
    df = df.withColumn("next_date", F.lead("date").over(w)).withColumn("next_open", F.lead("open").over(w))
    limit = F.least(F.col("i") + most, F.col("n") - 1)
    out_at = F.coalesce(F.least("first_down", limit), limit)
    reason = F.when(F.col("first_down").isNotNull() & (F.col("first_down") <= limit), "score").when(F.col("i") + most <= F.col("n") - 1, "max_hold").otherwise("data_end")
    entry = F.col("score") >= buy if signal is None else signal
    signals = df.where(entry & (F.col("i") <= F.col("n") - 2) & (F.col("next_open") > 0))
    signals = signals.select("stock_id", F.col("date").alias("signal_date"), F.col("next_date").alias("buy_date"), F.col("next_open").alias("buy_price"), (out_at + 1).alias("sell_at"), reason.alias("exit_reason"), F.col("i"))
    sales = df.select("stock_id", F.col("i").alias("sell_at"), F.col("date").alias("sell_date"), F.col("open").alias("sell_price"))
    trades = signals.join(sales, ["stock_id", "sell_at"])
    return trades.select(
        "stock_id", "signal_date", "buy_date", "sell_date", "buy_price", "sell_price", (F.col("sell_price") / F.col("buy_price") - 1).alias("ret"),
        (F.col("sell_at") - F.col("i") - 1).cast("int").alias("hold"), "exit_reason",
    )


def score_grid(panel: DataFrame, buys: list[float], sells: list[float], most: int = 250) -> DataFrame:
    """score_exit for every pair of thresholds with buy above sell, in one job: (buy, sell, stock_id, ret).

    The bars are read and ordered once: the first score at or below each selling threshold is a window
    each over the same order, and the pairs are made of the signals only.
    """
    w = line()
    df = panel.withColumn("i", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("stock_id")))
    df = df.withColumns({"next_open": F.lead("open").over(w), **{f"down{k}": F.when(F.col("score") <= s, F.col("i")) for k, s in enumerate(sells)}})
    df = df.withColumns({f"first{k}": F.min(f"down{k}").over(w.rowsBetween(1, most)) for k in range(len(sells))})
    signals = df.where((F.col("score") >= min(buys)) & (F.col("i") <= F.col("n") - 2) & (F.col("next_open") > 0))
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("sell"), F.col(f"first{k}").alias("first_down")) for k, s in enumerate(sells)])).alias("exit")
    signals = signals.select("stock_id", "i", "n", "next_open", "score", each).select("*", "exit.*")
    limit = F.least(F.col("i") + most, F.col("n") - 1)
    signals = signals.withColumn("sell_at", F.coalesce(F.least("first_down", limit), limit) + 1)
    trades = signals.join(df.select("stock_id", F.col("i").alias("sell_at"), F.col("open").alias("sell_price")), ["stock_id", "sell_at"])
    trades = trades.select("sell", "stock_id", "score", (F.col("sell_price") / F.col("next_open") - 1).alias("ret"))
    pairs = F.filter(F.array(*[F.lit(b) for b in buys]), lambda b: (b <= F.col("score")) & (b > F.col("sell")))
    return trades.select(F.explode(pairs).alias("buy"), "sell", "stock_id", "ret")


def cap_grid(panel: DataFrame, buy: float, sell: float, caps: list[int]) -> DataFrame:
    """score_exit for several caps of held bars in one job: (max_hold, stock_id, ret).

    The first score at or below `sell` within the longest cap serves all; a shorter cap ends the trade if it comes before.
    """
    w = line()
    df = panel.withColumn("i", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("stock_id")))
    df = df.withColumn("down", F.when(F.col("score") <= sell, F.col("i"))).withColumn("next_open", F.lead("open").over(w))
    df = df.withColumn("first_down", F.min("down").over(w.rowsBetween(1, max(caps))))
    signals = df.where((F.col("score") >= buy) & (F.col("i") <= F.col("n") - 2) & (F.col("next_open") > 0))
    signals = signals.select("stock_id", "i", "n", "next_open", "first_down", F.explode(F.array(*map(F.lit, caps))).alias("max_hold"))
    limit = F.least(F.col("i") + F.col("max_hold"), F.col("n") - 1)
    signals = signals.withColumn("sell_at", F.least(F.coalesce("first_down", limit), limit) + 1)
    sales = df.select("stock_id", F.col("i").alias("sell_at"), F.col("open").alias("sell_price"))
    return signals.join(sales, ["stock_id", "sell_at"]).select("max_hold", "stock_id", (F.col("sell_price") / F.col("next_open") - 1).alias("ret"))


def rule_exit(open_: np.ndarray, close: np.ndarray, average: np.ndarray, entry: int, take_profit: float | None, stop_loss: float | None, trail: tuple[float, float] | None, most: int | None) -> tuple[int, str] | None:
    """Bar and reason at which a position bought at open_[entry] ends, by closes from the entry bar on.

    Order on each bar: trailing stop once armed; else take profit; stop loss where set, or two closes in a
    row below the average; the cap of bars. Unknown closes are passed over.
    """
    price, peak, armed, below = open_[entry], -np.inf, False, 0
    for t in range(entry, len(close)):
        c = close[t]
        if c != c:
            continue
        ret = c / price - 1
        peak = max(peak, c)
        if trail is not None:
            armed = armed or ret >= trail[0]
            if armed and c < peak * (1 - trail[1]):
                return t, "trail"
        elif take_profit is not None and ret >= take_profit:
            return t, "take_profit"
        if not armed:
            if stop_loss is not None:
                if ret <= -stop_loss:
                    return t, "stop_loss"
            else:
                below = below + 1 if c < average[t] else 0
                if below >= 2:
                    return t, "ma_stop"
        if most is not None and t - entry >= most:
            return t, "max_hold"
    last = len(close) - 1
    return (last, "data_end") if close[last] == close[last] else None


def rule_trades(panel: DataFrame, take_profit: float | None = 0.25, stop_loss: float | None = None, trail: tuple[float, float] | None = None, most: int | None = None, dedup: bool = True) -> DataFrame:
    """Trades of the rows with signal = 1: stock_id, date, open, close, average, signal -> TRADE columns.

    With dedup a signal is passed over while the entity's position is held. One entity's bars are a group,
    as holding is a state in time order.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("date", ignore_index=True)
        o, c, m = (pdf[x].to_numpy(dtype=float, na_value=np.nan) for x in ("open", "close", "average"))
        day, busy, out = pdf["date"], -1, []
        for i in np.flatnonzero(pdf["signal"].to_numpy() == 1).tolist():
            e = i + 1
            if e >= len(o) or not o[e] > 0 or dedup and e <= busy:
                continue
            found = rule_exit(o, c, m, e, take_profit, stop_loss, trail, most)
            if found is None:
                continue
            t, why = found
            busy = t
            out.append((pdf["stock_id"].iat[0], day[i], day[e], day[t], o[e], c[t], c[t] / o[e] - 1, t - e, why))
        return pd.DataFrame(out, columns=[x.split()[0] for x in TRADE.split(", ")])

    return panel.groupBy("stock_id").applyInPandas(run, TRADE)


def equity(trades: DataFrame, prices: DataFrame, total: Callable[[Column], Column] = F.sum) -> DataFrame:
    """Per calendar date the mean over all trades of their return so far: marked at closes while held, frozen after.

    Held days come from one interval join; the frozen part is a running sum of finished trades over a row per
    date. The number of trades joins as one row. `total` adds up returns, for callers that need sums in a fixed order.
    """
    from .joins import held_on

    calendar = prices.select("date").distinct()
    number = F.broadcast(trades.agg(F.greatest(F.count("*"), F.lit(1)).alias("n")))
    held = held_on(trades.select("stock_id", "buy_date", "sell_date", "buy_price"), calendar)
    marked = held.join(prices.select("stock_id", "date", "close"), ["stock_id", "date"]).groupBy("date").agg(total(F.col("close") / F.col("buy_price") - 1).alias("open_ret"))
    done = trades.groupBy(F.col("sell_date").alias("date")).agg(total(F.col("ret")).alias("done_ret"))
    daily = calendar.join(marked, "date", "left").join(done, "date", "left").na.fill(0, ["open_ret", "done_ret"])
    frozen = F.sum("done_ret").over(Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0))
    return daily.withColumn("sum", F.col("open_ret") + frozen).crossJoin(number).select("date", (F.col("sum") / F.col("n")).alias("equity"))


def equity_statistics(curve: DataFrame) -> DataFrame:
    """Total return, Sharpe ratio of the daily changes over 250 days, and the deepest fall from a peak, from a row (date, equity) per date."""
    line = Window.orderBy("date")
    worth = 1 + F.col("equity")
    days = curve.select("date", worth.alias("worth"), (F.try_divide(worth, F.lag(worth).over(line)) - 1).alias("moved"), F.max(worth).over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("peak"))
    sd = F.stddev_samp("moved")
    return days.agg(
        (F.max_by("worth", "date") - 1).alias("total_return"), F.when(sd > 0, F.avg("moved") / sd * F.sqrt(F.lit(250.0))).otherwise(0.0).alias("sharpe"), F.min((F.col("worth") - F.col("peak")) / F.col("peak")).alias("max_drawdown")
    )


def performance(trades: DataFrame, total: Callable[[Column], Column] = F.sum) -> DataFrame:
    """Number, win rate, mean and exit shares of all trades."""
    share = lambda why: F.avg((F.col("exit_reason") == why).cast("int"))
    return trades.agg(F.count("*").alias("n_trades"), F.avg((F.col("ret") > 0).cast("int")).alias("win_rate"), (total(F.col("ret")) / F.count("*")).alias("avg_return"), share("score").alias("score_share"), share("max_hold").alias("max_hold_share"))


def running_sums(points: DataFrame, by: str, columns: list[str], falling: bool, buckets: int = 256) -> DataFrame:
    """Add `_before_c` for each column: its sum over all rows before a row by `by`, whose values are distinct.

    Rows are dealt to buckets by approximate quantiles of the values, so that crowded values part too; sums run
    inside a bucket, and a bucket's start is the running sum over one row per bucket. No window holds all rows.
    """
    cuts = F.broadcast(points.agg(F.percentile_approx(by, [k / buckets for k in range(1, buckets)], 100 * buckets).alias("_cuts")))
    rows = points.crossJoin(cuts).withColumn("_bucket", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(by))), F.lit(0))).drop("_cuts")
    order = (lambda c: F.col(c).desc()) if falling else F.col
    whole = rows.groupBy("_bucket").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    earlier = Window.orderBy(order("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select("_bucket", *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_start_{c}") for c in columns])
    inside = Window.partitionBy("_bucket").orderBy(order(by)).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(F.broadcast(starts), "_bucket")
    return rows.withColumns({f"_before_{c}": F.col(f"_start_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in columns}).drop("_bucket", *[f"_start_{c}" for c in columns])


def threshold_curve(rows: DataFrame, score: str, ret: str, least: int = 40, total: Callable[[Column], Column] = F.sum) -> DataFrame:
    """By falling score: the count, win rate and mean return of all rows of at least that score, from `least` rows on.

    Rows of a score are added up first, so ties form one point; the running sums are by buckets of scores.
    """
    points = rows.groupBy(score).agg(F.count("*").alias("k"), F.sum((F.col(ret) > 0).cast("long")).alias("wins"), total(F.col(ret)).alias("gain"))
    points = running_sums(points, score, ["k", "wins", "gain"], falling=True)
    n, wins, gain = (F.col(c) + F.col(f"_before_{c}") for c in ("k", "wins", "gain"))
    return points.select(F.col(score).alias("threshold"), n.alias("n"), (wins / n).alias("win_rate"), (gain / n).alias("avg_return")).where(F.col("n") >= least)


def auc(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Areas under the ROC curve, by rank sums with mean ranks of ties, and under the precision-recall curve, with its lift over the base rate."""
    points = rows.groupBy(score).agg(F.count("*").alias("k"), F.sum(label).cast("long").alias("pos"))
    points = running_sums(points, score, ["k", "pos"], falling=False).withColumn("rank", F.col("_before_k") + (F.col("k") + 1) / 2)
    whole = F.broadcast(points.agg(F.sum("pos").alias("p"), F.sum("k").alias("n")))
    above, hits = F.col("n") - F.col("_before_k"), F.col("p") - F.col("_before_pos")  # rows and positives of at least the score
    sums = points.crossJoin(whole).agg(F.sum(F.col("rank") * F.col("pos")).alias("r"), F.sum(F.floor(F.col("pos") * hits / above * 1e9 + 0.5)).alias("precise"), F.max("p").alias("p"), F.max("n").alias("n"))
    p, n = F.col("p"), F.col("n") - F.col("p")
    pr = F.try_divide(F.col("precise") / 1e9, p)
    return sums.select(F.col("n"), p.alias("n_positive"), F.try_divide(F.col("r") - p * (p + 1) / 2, (p * n).cast("double")).alias("auc"), pr.alias("pr_auc"), F.try_divide(pr, p / F.col("n")).alias("pr_lift"))


def crossing(close: Column, level: Column, before: Column) -> Column:
    return (close > level) & (before <= level)


def track_position(panel: DataFrame, positions: DataFrame, stop_loss: float, arm: float, give_back: float) -> DataFrame:
    """State of each open position at the entity's last bar: return, peak, whether the trailing stop is armed, and its price.

    panel: stock_id, date, close; positions: stock_id, buy_date, buy_price. Aggregates over the held bars.
    """
    held = positions.join(panel.select("stock_id", "date", "close"), "stock_id").where("date >= buy_date and close is not null")
    state = held.groupBy("stock_id", "buy_date", "buy_price").agg(F.max("close").alias("peak"), F.max_by("close", "date").alias("last"), F.count("*").cast("int").alias("bars"))
    return position_status(state, stop_loss, arm, give_back)


def position_status(state: DataFrame, stop_loss: float, arm: float, give_back: float) -> DataFrame:
    """Return, trailing stop and whether it is reached, from each position's price, peak, last close and number of bars."""
    armed = F.col("peak") / F.col("buy_price") - 1 >= arm
    stop = F.when(armed, F.col("peak") * (1 - give_back)).otherwise(F.col("buy_price") * (1 - stop_loss))
    return state.select("stock_id", "buy_date", "bars", (F.col("last") / F.col("buy_price") - 1).alias("ret"), "peak", armed.cast("int").alias("armed"), stop.alias("stop_price"), (F.col("last") <= stop).cast("int").alias("out"))


def holding_status(watched: DataFrame, scores: DataFrame, sell: float) -> DataFrame:
    """Watched ids with their last known score: 'sell' at or below the threshold, else 'hold', 'no score' without one; gap is the way to the threshold."""
    last = scores.where("score is not null").groupBy("stock_id").agg(F.max("date").alias("date"), F.max_by("score", "date").alias("score"))
    status = F.when(F.col("score").isNull(), "no score").when(F.col("score") <= sell, "sell").otherwise("hold")
    return watched.select("stock_id").join(last, "stock_id", "left").select("stock_id", "date", "score", status.alias("status"), (F.col("score") - sell).alias("gap"))


def against_peers(trades: DataFrame, peers: DataFrame) -> DataFrame:
    """trades with n_peers, peer_return (mean) and paired (their difference): the other entities' trades of the same signal date.

    Both have stock_id, signal_date and ret. The mean is the date's sum, in billionths, less the own part, so
    no pairs are made. Trades without peers, and those whose return is unknown, have null means.
    """
    nano = lambda c: F.floor(F.col(c) * 1e9 + 0.5)
    known = peers.where("ret is not null").select("stock_id", "signal_date", nano("ret").alias("_own"))
    days = known.groupBy("signal_date").agg(F.count("*").alias("_n"), F.sum("_own").alias("_all"))
    own = known.groupBy("stock_id", "signal_date").agg(F.sum("_own").alias("_own"), F.count("*").alias("_k"))
    joined = trades.join(days, "signal_date", "left").join(own, ["stock_id", "signal_date"], "left").na.fill(0, ["_n", "_all", "_own", "_k"])
    n = F.col("_n") - F.col("_k")
    told = joined.withColumn("n_peers", n).withColumn("peer_return", F.try_divide((F.col("_all") - F.col("_own")) / 1e9, F.col("n_peers")))
    return told.withColumn("paired", F.col("ret") - F.col("peer_return")).drop("_n", "_all", "_own", "_k")


def alpha_against_peers(paired: DataFrame) -> DataFrame:
    """One row: number of paired trades, mean returns of them and of their peers, mean and median difference, share that beat their peers, median number of peers.

    Differences count in billionths, rounded down, so that sums and medians don't hang on the order of rows.
    """
    nano = lambda c: F.floor(F.col(c) * 1e9)
    mean = lambda c: F.sum(nano(c)) / F.count("*") / 1e9
    return paired.where("paired is not null").agg(
        F.count("*").alias("n_paired"), mean("ret").alias("strategy_mean"), mean("peer_return").alias("peer_mean"), mean("paired").alias("alpha_mean"),
        (F.percentile(nano("paired"), F.lit(0.5)) / 1e9).alias("alpha_median"), F.avg((F.col("paired") > 0).cast("int")).alias("win_vs_peer"), F.percentile("n_peers", F.lit(0.5)).alias("median_peer_n"),
    )


def half_year(date: Column) -> Column:
    return F.concat(F.year(date).cast("string"), F.when(F.month(date) <= 6, "H1").otherwise("H2"))


def period_summary(trades: DataFrame, target: float = 0.8, total: Callable[[Column], Column] = F.sum) -> DataFrame:
    """Per half-year of the signal: closed and open trades; win rate, mean and median return and mean holding of the closed ones; whether the win rate reaches the target.

    Trades that end with the data are open. Recent halves with many of them look better than they are, as winners close first.
    """
    closed = F.col("exit_reason") != "data_end"
    known = lambda c: F.when(closed, c)
    win = F.avg(known((F.col("ret") > 0).cast("int")))
    n = F.count(known(F.lit(1)))
    return trades.groupBy(half_year(F.col("signal_date")).alias("half")).agg(
        n.alias("trades"), F.count(F.when(~closed, 1)).alias("open_trades"), win.alias("win_rate"), F.try_divide(total(known(F.col("ret"))), n).alias("avg_return"),
        F.percentile(known(F.floor(F.col("ret") * 1e9)), F.lit(0.5)).alias("median_nano"), F.avg(known(F.col("hold"))).alias("avg_hold"), F.coalesce(win >= target, F.lit(False)).cast("int").alias("passed"),
    )
