"""Alerts on a stream of trades: each window joined to the windows of its token before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.operators.events import alert_windows, judged_alerts


def activity_alerts(trades: DataFrame, width: str, late: str, lookback: str, limits: dict = S.ALERTS) -> DataFrame:
    """``events.activity_alerts`` of a stream: spikes against the token's last window within ``lookback``.

    Three stateful steps under one watermark, ``late`` behind the newest trade: windows per token, a
    stream-stream join of each window with those of its token that start up to ``lookback`` before, and the latest of
    these.  A window without one before it is kept (outer join).  States hold the open windows and those of the last ``lookback``.

    A trade later than the watermark is dropped, so its window keeps the figures it was closed with.  A window is
    judged once, when the watermark has passed its end by ``lookback``: Spark holds the join's output
    watermark back by the width of its range, so ``lookback`` is also the delay of the alerts.  Trades
    without a time have no window; those without a token are one token's.
    """
    windows = alert_windows(trades.withWatermark("trade_time", late), width)
    now = windows.withColumn("__at", F.window_time("w")).drop("w")
    earlier = windows.select(
        F.window_time("w").alias("__at_before"),
        F.col("token_address").alias("__token"),
        F.struct(F.col("volume").alias("volume_before"), F.col("price").alias("price_before")).alias("__figures"),
    )
    near = F.col("__at_before") >= F.col("__at") - F.expr(f"INTERVAL {lookback}")
    pairs = now.join(earlier, F.col("token_address").eqNullSafe(F.col("__token")) & (F.col("__at_before") < F.col("__at")) & near, "left_outer")
    figures = [c for c in now.columns if c != "__at"]
    last = pairs.groupBy("__at", *figures).agg(F.max_by("__figures", "__at_before").alias("__last"))
    return judged_alerts(last.select(*figures, "__last.volume_before", "__last.price_before"), limits)
