"""Queries on trades, results and traders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import market as M
from tidemark.operators import pnl, traders
from tidemark.operators.ordered import top_n
from tidemark.plans import adapters as A
from tidemark.plans.oracle_tables import using
from tidemark.plans.registry import query, rounded


def trades(spark, sf_dir):
    return pnl.trades_from_swaps(A.swaps(spark, sf_dir))


def tokens(spark, sf_dir):
    return pnl.running_cost_by_token(trades(spark, sf_dir))


def portfolios(spark, sf_dir):
    return pnl.running_cost_portfolio(tokens(spark, sf_dir))


def positions(spark, sf_dir):
    return pnl.position_pnl(A.order_trades(spark, sf_dir))


# --- valuation -----------------------------------------------------------------------


@query(using("trades") + "SELECT * FROM trades")
def usd_valuation(spark, sf_dir):
    return trades(spark, sf_dir)


# Every fourth swap is fetched again a day later with a doubled amount, every sixth also with another base.
@query(using("swaps") + """, again AS (
    SELECT * FROM swaps UNION ALL
    SELECT * REPLACE (base_ui_change_amount * 2 AS base_ui_change_amount, fetched_at || 'b' AS fetched_at) FROM swaps WHERE event_id % 4 = 0 UNION ALL
    SELECT * REPLACE ('X' AS base_address) FROM swaps WHERE event_id % 6 = 0),
  single AS (SELECT * FROM again QUALIFY row_number() OVER (PARTITION BY transaction_hash, base_address ORDER BY fetched_at DESC) = 1)
  SELECT * FROM (SELECT transaction_hash AS trade_id, base_address AS token_address, abs(base_ui_change_amount) AS quantity,
      CASE WHEN base_nearest_price > 0 THEN abs(base_ui_change_amount) * base_nearest_price
           WHEN quote_nearest_price > 0 THEN abs(quote_ui_change_amount) * quote_nearest_price END AS usd
    FROM single WHERE lower(tx_type) = 'swap') WHERE usd > 0""")
def repeated_swaps(spark, sf_dir):
    once = A.swaps(spark, sf_dir)
    later = once.filter("event_id % 4 = 0").withColumns(
        {"base_ui_change_amount": F.col("base_ui_change_amount") * 2, "fetched_at": F.concat("fetched_at", F.lit("b"))}
    )
    other = once.filter("event_id % 6 = 0").withColumn("base_address", F.lit("X"))
    rows = pnl.trades_from_swaps(once.unionByName(later).unionByName(other))
    return rows.select("trade_id", "token_address", "quantity", "usd")


@query(using("swaps") + """
    SELECT transaction_hash, abs(base_ui_change_amount) * coalesce(base_nearest_price, 0) AS base_usd,
           abs(quote_ui_change_amount) * coalesce(quote_nearest_price, 0) AS quote_usd,
           CASE WHEN base_address = 'T0' THEN 'BUY' WHEN quote_address = 'T0' THEN 'SELL' ELSE 'SWAP' END AS side,
           CASE WHEN base_ui_change_amount > 0 THEN 'BUY_BASE' WHEN base_ui_change_amount < 0 THEN 'SELL_BASE' ELSE 'NEUTRAL' END AS direction
    FROM swaps""")
def leg_values_and_sides(spark, sf_dir):
    return A.swaps(spark, sf_dir).select(
        "transaction_hash",
        M.leg_value(F.col("base_ui_change_amount"), F.col("base_nearest_price")).alias("base_usd"),
        M.leg_value(F.col("quote_ui_change_amount"), F.col("quote_nearest_price")).alias("quote_usd"),
        M.side_by_reference(F.col("base_address"), F.col("quote_address"), "T0").alias("side"),
        M.side_by_sign(F.col("base_ui_change_amount")).alias("direction"),
    )


# --- running average cost -----------------------------------------------------------------


@query(using("sell_costs") + """
    SELECT wallet_address, token_address, trade_id, trade_time, quantity, usd, avg_cost, avg_cost IS NOT NULL AS has_cost_basis,
           coalesce(quantity * avg_cost, 0) AS cost_of_sold, coalesce(usd - quantity * avg_cost, 0) AS realized_pnl FROM sell_costs""")
def asof_sell_cost(spark, sf_dir):
    return pnl.sells_with_cost(trades(spark, sf_dir)).drop("token_symbol", "side")


_TOKEN_ROWS = """SELECT wallet_address, token_address, token_symbol, round(realized_pnl, 4) AS realized_pnl, round(cost_of_sold, 4) AS cost_of_sold,
       profitable_sells, bought_usd, bought_tokens, buy_count, sold_usd, sold_tokens, sell_count, first_buy, last_buy, first_sell, last_sell,
       last_price, bought_tokens - sold_tokens AS net_position_tokens, bought_usd / bought_tokens AS avg_cost,
       CASE WHEN sell_count > 0 THEN profitable_sells / sell_count * 100 ELSE 0 END AS token_win_rate,
       CASE WHEN cost_of_sold > 0 THEN round(realized_pnl / cost_of_sold * 100, 4) ELSE 0 END AS token_roi FROM cost_tokens"""


@query(using("cost_tokens") + _TOKEN_ROWS)
def running_cost_by_token(spark, sf_dir):
    return rounded(tokens(spark, sf_dir), 4, "realized_pnl", "cost_of_sold", "token_roi")


@query(using("portfolios") + "SELECT * FROM portfolios")
def running_cost_portfolio(spark, sf_dir):
    return portfolios(spark, sf_dir)


@query(using("order_trades") + """, costed AS (
    SELECT *, sum(CASE side WHEN 'BUY' THEN usd END) OVER w / sum(CASE side WHEN 'BUY' THEN quantity END) OVER w AS cost FROM order_trades
    WINDOW w AS (PARTITION BY wallet_address, token_address ORDER BY trade_time)),
  per_token AS (
    SELECT wallet_address, token_address, sum(CASE side WHEN 'SELL' THEN coalesce(usd - quantity * cost, 0) ELSE 0 END) AS pnl,
           sum(CASE side WHEN 'SELL' THEN coalesce(quantity * cost, 0) ELSE 0 END) AS sold_cost,
           count(*) FILTER (WHERE side = 'SELL' AND usd - quantity * cost > 0) AS wins, count(*) FILTER (WHERE side = 'SELL') AS sells,
           count(*) FILTER (WHERE side = 'BUY') AS buys, sum(CASE side WHEN 'BUY' THEN usd ELSE 0 END) AS bought
    FROM costed GROUP BY ALL HAVING count(*) FILTER (WHERE side = 'BUY') > 0)
  SELECT wallet_address, round(sum(pnl), 2) AS realized_pnl, round(sum(bought), 2) AS total_bought, CAST(sum(buys + sells) AS BIGINT) AS trade_count,
         CASE WHEN sum(sells) > 0 THEN round(sum(wins) / sum(sells) * 100, 2) ELSE 0 END AS win_rate,
         CASE WHEN sum(sold_cost) > 0 THEN round(sum(pnl) / sum(sold_cost) * 100, 2) ELSE 0 END AS roi
  FROM per_token GROUP BY wallet_address""")
def running_cost_of_orders(spark, sf_dir):
    wallets = pnl.running_cost_portfolio(pnl.running_cost_by_token(A.order_trades(spark, sf_dir)))
    return wallets.select("wallet_address", "realized_pnl", "total_bought", "trade_count", "win_rate", "roi")


# --- whole-period cost -----------------------------------------------------------------------

_FLOWS = """, flows AS (
    SELECT wallet_address, token_address, max(token_symbol) AS token_symbol, sum(CASE side WHEN 'BUY' THEN usd ELSE 0 END) AS bought_usd,
           sum(CASE side WHEN 'SELL' THEN usd ELSE 0 END) AS sold_usd, sum(CASE side WHEN 'BUY' THEN quantity ELSE 0 END) AS bought_tokens,
           sum(CASE side WHEN 'SELL' THEN quantity ELSE 0 END) AS sold_tokens, count(*) FILTER (WHERE side = 'BUY') AS buy_count,
           count(*) FILTER (WHERE side = 'SELL') AS sell_count, count(*) AS trade_count,
           avg(CASE side WHEN 'BUY' THEN usd / quantity END) AS avg_buy_price, avg(CASE side WHEN 'SELL' THEN usd / quantity END) AS avg_sell_price,
           min(trade_time) AS first_trade, max(trade_time) AS last_trade FROM trades GROUP BY ALL),
  results AS (SELECT *, sold_usd - sold_tokens * unit_cost AS realized_pnl, position_tokens * unit_cost AS position_cost,
           position_tokens * coalesce(avg_sell_price, unit_cost) AS position_value
    FROM (SELECT *, {cost} AS unit_cost, bought_tokens - sold_tokens AS position_tokens FROM flows)),
  token_results AS (SELECT *, realized_pnl + unrealized_pnl AS total_pnl, coalesce(realized_pnl + unrealized_pnl > 0, false) AS is_profitable,
           CASE WHEN bought_usd > 0 THEN (realized_pnl + unrealized_pnl) / bought_usd * 100 ELSE 0 END AS roi
    FROM (SELECT *, position_value - position_cost AS unrealized_pnl FROM results))
"""
_WEIGHTED = _FLOWS.replace("{cost}", "CASE WHEN bought_tokens > 0 THEN bought_usd / bought_tokens ELSE 0 END")
_MEAN_PRICE = _FLOWS.replace("{cost}", "avg_buy_price")
_TOKEN_RESULTS = """SELECT * REPLACE (round(realized_pnl, 4) AS realized_pnl, round(unrealized_pnl, 4) AS unrealized_pnl, round(total_pnl, 4) AS total_pnl,
    round(position_cost, 4) AS position_cost, round(position_value, 4) AS position_value, round(roi, 4) AS roi, round(unit_cost, 4) AS unit_cost,
    round(avg_buy_price, 4) AS avg_buy_price, round(avg_sell_price, 4) AS avg_sell_price) FROM token_results"""
_WALLET_RESULTS = """SELECT wallet_address, 'ALL_TOKENS' AS token_address, round(sum(realized_pnl), 2) AS realized_pnl,
    round(sum(unrealized_pnl), 2) AS unrealized_pnl, round(sum(total_pnl), 2) AS total_pnl, round(sum(bought_usd), 2) AS total_bought,
    round(sum(sold_usd), 2) AS total_sold, CAST(sum(trade_count) AS BIGINT) AS trade_count,
    round(count(*) FILTER (WHERE is_profitable) * 100 / count(*), 2) AS win_rate, round({roi}, 2) AS roi,
    round(sum(position_cost), 2) AS current_position_cost_basis, round(sum(position_value), 2) AS current_position_value,
    round((sum(bought_usd) + sum(sold_usd)) / sum(trade_count), 2) AS avg_transaction_amount_usd,
    date_diff('day', min(first_trade), max(last_trade)) * 24.0::DOUBLE AS avg_holding_time_hours,
    sum(trade_count) / (date_diff('day', min(first_trade), max(last_trade)) + 1) AS trade_frequency_daily,
    min(first_trade) AS first_transaction, max(last_trade) AS last_transaction, 0.0::DOUBLE AS current_position_tokens
    FROM token_results GROUP BY wallet_address"""
_MONEY = ("realized_pnl", "unrealized_pnl", "total_pnl", "position_cost", "position_value", "roi", "unit_cost", "avg_buy_price", "avg_sell_price")


@query(using("trades") + _WEIGHTED + _TOKEN_RESULTS)
def whole_period_by_token(spark, sf_dir):
    return rounded(pnl.whole_period_by_token(trades(spark, sf_dir)), 4, *_MONEY)


@query(using("trades") + _MEAN_PRICE + _TOKEN_RESULTS)
def mean_price_by_token(spark, sf_dir):
    return rounded(pnl.whole_period_by_token(trades(spark, sf_dir), "mean_price"), 4, *_MONEY)


@query(using("trades") + _WEIGHTED + _WALLET_RESULTS.replace("{roi}", "sum(total_pnl) / nullif(sum(bought_usd), 0) * 100"))
def whole_period_portfolio(spark, sf_dir):
    return pnl.whole_period_portfolio(pnl.whole_period_by_token(trades(spark, sf_dir)))


@query(using("trades") + _MEAN_PRICE + _WALLET_RESULTS.replace("{roi}", "avg(roi)"))
def mean_price_portfolio(spark, sf_dir):
    by_token = pnl.whole_period_by_token(trades(spark, sf_dir), "mean_price")
    return pnl.whole_period_portfolio(by_token, "mean_of_tokens")


# --- net flow ----------------------------------------------------------------------------------

_NET = """, priced AS (
    SELECT wallet_address, base_address AS token_address, base_symbol, CAST("timestamp" AS DATE) AS day, base_ui_change_amount AS amount,
           abs(base_ui_change_amount) * base_nearest_price AS base_usd, abs(quote_ui_change_amount) * quote_nearest_price AS quote_usd
    FROM swaps WHERE lower(tx_type) = 'swap' AND base_nearest_price > 0 AND quote_nearest_price > 0),
  flows AS (SELECT wallet_address, token_address, count(*) AS trade_count, sum(base_usd) AS base_volume, sum(quote_usd) AS quote_volume,
           sum({flow}) AS net_flow, count(*) FILTER (WHERE amount > 0) AS buys, count(*) FILTER (WHERE amount < 0) AS sells,
           avg(base_usd) AS avg_trade_size, min(day) AS first_day, max(day) AS last_day FROM priced GROUP BY ALL)
  SELECT wallet_address, 'ALL_TOKENS' AS token_address, CAST(sum(trade_count) AS BIGINT) AS trade_count, sum({volume}) AS total_volume,
         sum(net_flow) AS total_pnl, CASE WHEN sum({volume}) > 0 THEN round(sum(net_flow) / sum({volume}) * 100, 4) ELSE 0 END AS roi,
         round(count(*) FILTER (WHERE net_flow > 0) * 100 / count(*), 4) AS win_rate, CAST(sum(buys) AS BIGINT) AS total_buys,
         CAST(sum(sells) AS BIGINT) AS total_sells, min(first_day) AS first_trade_date, max(last_day) AS last_trade_date,
         round(avg(avg_trade_size), 4) AS avg_trade_size FROM flows GROUP BY wallet_address"""


@query(using("swaps") + _NET.replace("{flow}", "CASE WHEN amount > 0 THEN -quote_usd ELSE quote_usd END").replace("{volume}", "base_volume + quote_volume"))
def net_flow_portfolio(spark, sf_dir):
    wallets = pnl.net_flow_portfolio(pnl.net_flow_by_token(A.swaps(spark, sf_dir)))
    return rounded(wallets, 4, "roi", "win_rate", "avg_trade_size")


@query(using("swaps") + _NET.replace("{flow}", "CASE WHEN amount > 0 THEN base_usd ELSE -base_usd END").replace("{volume}", "base_volume"))
def net_base_flow_portfolio(spark, sf_dir):
    wallets = pnl.net_flow_portfolio(pnl.net_flow_by_token(A.swaps(spark, sf_dir), "base"), "base")
    return rounded(wallets, 4, "roi", "win_rate", "avg_trade_size")


# --- positions and lots ----------------------------------------------------------------------------


@query(using("positions_walked") + "SELECT wallet_address, token_address, trade_id, side, running_position, running_cost, trade_order FROM positions_walked")
def running_positions(spark, sf_dir):
    return pnl.running_positions(A.order_trades(spark, sf_dir)).select(
        "wallet_address", "token_address", "trade_id", "side", "running_position", "running_cost", "trade_order"
    )


_POSITION_ROUND = ("realized_pnl", "unrealized_pnl", "total_pnl", "roi", "win_rate", "trade_frequency", "price", "current_position_value_usd",
                   "avg_trade_efficiency", "avg_timing_score")
_ROUND_POSITIONS = ", ".join(f"round({c}, 4) AS {c}" for c in _POSITION_ROUND)


@query(using("positions") + f"SELECT * REPLACE ({_ROUND_POSITIONS}) FROM positions")
def position_pnl(spark, sf_dir):
    return rounded(positions(spark, sf_dir), 4, *_POSITION_ROUND)


@query(using("fifo") + """SELECT wallet_address, token_address, buy_id, sell_id, buy_time, sell_time, quantity,
    round(cost, 4) AS cost, round(proceeds, 4) AS proceeds FROM fifo""")
def fifo_matches(spark, sf_dir):
    return rounded(pnl.fifo_matches(trades(spark, sf_dir)), 4, "cost", "proceeds")


# Sells are walked one after the other, each taking what is bought by its moment and not yet sold.
_QUEUE = """, sells AS (
    SELECT s.*, row_number() OVER (PARTITION BY wallet_address, token_address ORDER BY trade_time, trade_id) AS n,
           coalesce((SELECT sum(b.quantity) FROM trades b WHERE b.wallet_address = s.wallet_address AND b.token_address = s.token_address
                     AND b.side = 'BUY' AND b.trade_time <= s.trade_time), 0) AS bought FROM trades s WHERE side = 'SELL'),
  walk AS (
    SELECT wallet_address, token_address, n, CAST(0 AS DOUBLE) AS used, least(bought, quantity) AS used_then FROM sells WHERE n = 1
    UNION ALL
    SELECT s.wallet_address, s.token_address, s.n, w.used_then, least(s.bought, w.used_then + s.quantity)
    FROM walk w JOIN sells s ON s.wallet_address = w.wallet_address AND s.token_address = w.token_address AND s.n = w.n + 1),
  met AS (
    SELECT s.wallet_address, s.token_address, s.trade_id AS sell_id, least(b.hi, w.used_then) - greatest(b.lo, w.used) AS matched,
           s.usd / s.quantity AS sell_price, b.price AS buy_price
    FROM walk w JOIN sells s USING (wallet_address, token_address, n)
    JOIN fifo_legs b ON b.wallet_address = w.wallet_address AND b.token_address = w.token_address AND b.side = 'BUY'
     AND b.lo < w.used_then AND w.used < b.hi)
  SELECT wallet_address, token_address, sell_id, sum(matched) AS matched_quantity, round(sum(matched * buy_price), 4) AS cost,
         round(sum(matched * sell_price - matched * buy_price), 4) AS realized_pnl, count(*) AS lots FROM met GROUP BY ALL"""


@query(using("fifo_legs").replace("WITH", "WITH RECURSIVE", 1) + _QUEUE)
def fifo_without_short_sales(spark, sf_dir):
    return rounded(pnl.fifo_by_sell(pnl.fifo_matches(trades(spark, sf_dir), strict=True)), 4, "cost", "realized_pnl")


# All trades are one pair, and one trade in a thousand is a million times larger: the others lie in slivers of the axis.
_SLIVER = """, one AS (
    SELECT trade_id, trade_time, side, usd / (quantity * CASE WHEN trade_id % 1000 = 0 THEN 1e6 ELSE 1 END) AS price,
           quantity * CASE WHEN trade_id % 1000 = 0 THEN 1e6 ELSE 1 END AS quantity FROM order_trades WHERE side <> 'SWAP'),
  legs AS (
    SELECT *, sum(quantity) OVER w - quantity AS lo, sum(quantity) OVER w AS hi FROM one
    WINDOW w AS (PARTITION BY side ORDER BY trade_time, trade_id ROWS UNBOUNDED PRECEDING)),
  met AS (
    SELECT b.trade_id AS buy_id, s.trade_id AS sell_id, b.price AS buy_price, s.price AS sell_price, least(b.hi, s.hi) - greatest(b.lo, s.lo) AS quantity
    FROM (SELECT * FROM legs WHERE side = 'BUY') b JOIN (SELECT * FROM legs WHERE side = 'SELL') s ON b.lo < s.hi AND s.lo < b.hi)
  SELECT buy_id, sell_id, quantity, round(quantity * buy_price, 2) AS cost, round(quantity * sell_price, 2) AS proceeds FROM met"""


@query(using("order_trades") + _SLIVER)
def fifo_in_a_sliver(spark, sf_dir):
    large = F.when(F.col("trade_id") % 1000 == 0, 1e6).otherwise(1.0)
    one = {"wallet_address": F.lit("all"), "token_address": F.lit("all"), "quantity": F.col("quantity") * large}
    matches = pnl.fifo_matches(A.order_trades(spark, sf_dir).withColumns(one))
    return rounded(matches.select("buy_id", "sell_id", "quantity", "cost", "proceeds"), 2, "cost", "proceeds")


# Half of all trades belong to one pair and that pair has no token.
_CROWDED = """, crowded AS (
    SELECT CASE WHEN trade_id % 2 = 0 THEN wallet_address END AS wallet_address, CASE WHEN trade_id % 2 = 0 THEN token_address END AS token_address,
           trade_id, trade_time, side, quantity, usd FROM order_trades)
  SELECT trade_id, wallet_address, token_address, round(usd - quantity * sum(CASE side WHEN 'BUY' THEN usd END) OVER w
         / sum(CASE side WHEN 'BUY' THEN quantity END) OVER w, 4) AS realized_pnl FROM crowded
  WINDOW w AS (PARTITION BY wallet_address, token_address ORDER BY trade_time) QUALIFY side = 'SELL'"""


@query(using("order_trades") + _CROWDED)
def crowded_sell_cost(spark, sf_dir):
    named = F.col("trade_id") % 2 == 0
    rows = A.order_trades(spark, sf_dir).withColumns({c: F.when(named, F.col(c)) for c in pnl.PAIR})
    sold = pnl.sells_with_cost(rows)
    result = F.when(F.col("has_cost_basis"), F.round("realized_pnl", 4))
    return sold.select("trade_id", *pnl.PAIR, result.alias("realized_pnl"))


# --- selections ---------------------------------------------------------------------------------------


@query(using("trades") + """, aged AS (SELECT *, date_diff('day', trade_time, TIMESTAMP '2024-01-31 00:00:00') AS age FROM trades),
  frames AS (SELECT * FROM (VALUES ('all', 100000), ('week', 7), ('month', 30), ('quarter', 90)) f(timeframe, days)),
  wallets AS (SELECT DISTINCT wallet_address FROM trades)
  SELECT w.wallet_address, f.timeframe, coalesce(sum(usd) FILTER (WHERE side = 'BUY'), 0) AS bought, coalesce(sum(usd) FILTER (WHERE side = 'SELL'), 0) AS sold,
         count(trade_id) AS trades, coalesce(sum(usd) FILTER (WHERE side = 'SELL'), 0) - coalesce(sum(usd) FILTER (WHERE side = 'BUY'), 0) AS net
  FROM wallets w CROSS JOIN frames f LEFT JOIN aged a ON a.wallet_address = w.wallet_address AND (f.timeframe = 'all' OR a.age BETWEEN 0 AND f.days)
  GROUP BY ALL""")
def lookback_results(spark, sf_dir):
    return pnl.by_lookback(trades(spark, sf_dir), F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))


@query(using("trades") + """, aged AS (SELECT *, trade_time >= TIMESTAMP '2024-01-24 00:00:00' AS fresh FROM trades),
  placed AS (SELECT *, row_number() OVER (PARTITION BY wallet_address, fresh ORDER BY trade_time DESC, trade_id DESC) AS n,
             count(*) FILTER (WHERE fresh) OVER (PARTITION BY wallet_address) AS n_fresh FROM aged)
  SELECT wallet_address, token_address, token_symbol, trade_id, trade_time, side, quantity, usd FROM placed WHERE fresh OR n <= 30 - n_fresh""")
def recent_with_topup(spark, sf_dir):
    return pnl.recent_with_topup(trades(spark, sf_dir), F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"), rows=30)


# --- traders ---------------------------------------------------------------------------------------------


_GOLD_COLUMNS = """, qualified AS (SELECT *, CASE WHEN total_pnl >= 10000 AND portfolio_roi >= 50 AND win_rate >= 30 THEN 'ELITE'
        WHEN total_pnl >= 1000 AND portfolio_roi >= 20 AND win_rate >= 20 THEN 'STRONG'
        WHEN total_pnl >= 100 AND portfolio_roi >= 10 AND win_rate >= 10 THEN 'PROMISING' ELSE 'QUALIFIED' END AS performance_tier,
        round(least(greatest(total_pnl, 0) / 1000, 100) * 0.4 + least(greatest(portfolio_roi, 0), 100) * 0.3 + win_rate * 0.2 + least(trade_count, 10) * 0.1, 2)
            AS smart_trader_score,
        CAST(date_diff('day', first_transaction, last_transaction) + 1 AS INTEGER) AS trading_experience_days,
        round((total_bought + total_sold) / trade_count, 2) AS avg_trade_size_usd,
        CASE WHEN total_bought > 0 THEN round(total_sold / total_bought * 100, 2) ELSE 0 END AS sell_ratio_percent
    FROM portfolios WHERE (win_rate > 0 OR total_pnl > 0) AND total_bought > 0)"""


@query(using("portfolios") + _GOLD_COLUMNS + """
  SELECT *, row_number() OVER (ORDER BY smart_trader_score DESC, total_pnl DESC, wallet_address) AS overall_rank,
         row_number() OVER (PARTITION BY performance_tier ORDER BY smart_trader_score DESC, total_pnl DESC, wallet_address) AS tier_rank FROM qualified""")
def gold_traders(spark, sf_dir):
    return traders.gold_traders(portfolios(spark, sf_dir))


_SIMPLE = """, rated AS (SELECT *, CASE WHEN total_pnl > 1000 AND win_rate > 50 THEN 'ELITE' WHEN total_pnl > 100 AND win_rate > 30 THEN 'STRONG'
        ELSE 'QUALIFIED' END AS performance_tier FROM portfolios WHERE total_pnl > 0 OR win_rate > 0)"""


@query(using("portfolios") + _SIMPLE + "SELECT wallet_address, total_pnl, win_rate, trade_count, roi, performance_tier FROM rated")
def simple_traders(spark, sf_dir):
    rated = traders.simple_traders(portfolios(spark, sf_dir))
    return rated.select("wallet_address", "total_pnl", "win_rate", "trade_count", "roi", "performance_tier")


@query(using("portfolios") + _SIMPLE + """, placed AS (SELECT wallet_address, performance_tier, total_pnl, row_number() OVER (
        ORDER BY CASE performance_tier WHEN 'ELITE' THEN 0 WHEN 'STRONG' THEN 1 ELSE 2 END, total_pnl DESC, wallet_address) AS place FROM rated)
  SELECT * FROM placed WHERE place <= 100""")
def publish_list(spark, sf_dir):
    listed = traders.publish_list(traders.simple_traders(portfolios(spark, sf_dir)))
    return listed.select("wallet_address", "performance_tier", "total_pnl", F.col("place").cast("bigint").alias("place"))


@query(using("portfolios") + """, gated AS (SELECT *, CAST(date_diff('day', first_transaction, last_transaction) AS INTEGER) AS days_active,
        round(roi * win_rate / 10000, 2) AS consistency_score,
        CASE WHEN avg_holding_time_hours > 0 THEN round(100 / (trade_frequency_daily + 1), 2) ELSE 50 END AS risk_score,
        round(total_pnl / total_bought * 100, 2) AS profit_factor,
        CASE WHEN total_pnl >= 1000 AND roi >= 30 AND win_rate >= 60 THEN 'elite'
             WHEN total_pnl >= 100 AND roi >= 15 THEN 'strong' ELSE 'promising' END AS performance_tier
    FROM portfolios WHERE total_pnl >= 10 AND roi >= 1 AND win_rate >= 40 AND trade_count >= 10)
  SELECT wallet_address, total_pnl, days_active, consistency_score, risk_score, profit_factor, performance_tier,
         row_number() OVER (ORDER BY total_pnl DESC, wallet_address) AS trader_rank FROM gated QUALIFY trader_rank <= 100""")
def top_performers(spark, sf_dir):
    top = traders.top_performers(portfolios(spark, sf_dir))
    return top.select(
        "wallet_address", "total_pnl", "days_active", "consistency_score", "risk_score", "profit_factor", "performance_tier",
        F.col("trader_rank").cast("bigint").alias("trader_rank"),
    )


_SCORED = "wallet_address, token_address, enhanced_smart_trader_score, performance_tier, execution_quality_tier, portfolio_size_tier"


@query(using("scored") + f"SELECT {_SCORED} FROM scored")
def scored_positions(spark, sf_dir):
    return traders.scored_positions(positions(spark, sf_dir)).select(*_SCORED.split(", "))


@query(using("scored") + """SELECT wallet_address, token_address,
       row_number() OVER (ORDER BY enhanced_smart_trader_score DESC, total_pnl DESC, wallet_address, token_address) AS overall_rank,
       row_number() OVER (ORDER BY total_pnl DESC, wallet_address, token_address) AS profitability_rank,
       row_number() OVER (ORDER BY avg_trade_efficiency DESC, avg_timing_score DESC, wallet_address, token_address) AS execution_rank,
       row_number() OVER (ORDER BY roi DESC, wallet_address, token_address) AS roi_rank,
       round(percent_rank() OVER (ORDER BY enhanced_smart_trader_score), 6) AS score_percentile,
       round(percent_rank() OVER (ORDER BY total_pnl), 6) AS pnl_percentile,
       round(percent_rank() OVER (ORDER BY avg_trade_efficiency), 6) AS efficiency_percentile FROM scored""")
def ranked_positions(spark, sf_dir):
    names = ["overall_rank", "profitability_rank", "execution_rank", "roi_rank", "score_percentile", "pnl_percentile", "efficiency_percentile"]
    scored = traders.scored_positions(positions(spark, sf_dir)).select(
        "wallet_address", "token_address", "enhanced_smart_trader_score", "total_pnl", "avg_trade_efficiency", "avg_timing_score", "roi"
    )
    ranked = traders.ranked_positions(scored).select("wallet_address", "token_address", *names)
    return rounded(ranked, 6, *names[4:])


_SUMMARY = """SELECT wallet_address, count(*) AS tokens_traded, round(sum(total_pnl), 4) AS total_portfolio_pnl,
       round(avg(enhanced_smart_trader_score), 9) AS avg_smart_trader_score, max(enhanced_smart_trader_score) AS best_token_score,
       count(*) FILTER (WHERE total_pnl > 0) AS profitable_tokens, count(*) FILTER (WHERE total_pnl < 0) AS losing_tokens,
       round(avg(pnl_quality_score), 9) AS avg_portfolio_quality, round(avg(avg_trade_efficiency), 9) AS avg_portfolio_efficiency,
       round(avg(avg_timing_score), 9) AS avg_portfolio_timing, arg_max(token_address, (total_pnl, token_address)) AS best_performing_token,
       round(max(total_pnl), 4) AS best_token_pnl FROM scored GROUP BY wallet_address"""
_SUMMARY_MEANS = ("avg_smart_trader_score", "avg_portfolio_quality", "avg_portfolio_efficiency", "avg_portfolio_timing")


@query(using("scored") + _SUMMARY)
def wallet_summary(spark, sf_dir):
    summary = traders.wallet_summary(traders.scored_positions(positions(spark, sf_dir)))
    return rounded(rounded(summary, 4, "total_portfolio_pnl", "best_token_pnl"), 9, *_SUMMARY_MEANS)


@query(using("scored") + f""", summary AS ({_SUMMARY}), ranked AS (
    SELECT *, row_number() OVER (ORDER BY enhanced_smart_trader_score DESC, total_pnl DESC, wallet_address, token_address) AS overall_rank,
           row_number() OVER (ORDER BY total_pnl DESC, wallet_address, token_address) AS profitability_rank,
           row_number() OVER (ORDER BY avg_trade_efficiency DESC, avg_timing_score DESC, wallet_address, token_address) AS execution_rank,
           percent_rank() OVER (ORDER BY enhanced_smart_trader_score) AS score_percentile, percent_rank() OVER (ORDER BY total_pnl) AS pnl_percentile,
           percent_rank() OVER (ORDER BY avg_trade_efficiency) AS efficiency_percentile FROM scored)
  SELECT wallet_address, token_address, round(total_pnl, 4) AS total_pnl, enhanced_smart_trader_score, performance_tier, execution_quality_tier,
         portfolio_size_tier, overall_rank, profitability_rank, execution_rank, round(score_percentile, 6) AS score_percentile,
         round(pnl_percentile, 6) AS pnl_percentile, round(efficiency_percentile, 6) AS efficiency_percentile, tokens_traded, total_portfolio_pnl,
         avg_smart_trader_score, profitable_tokens, losing_tokens, best_performing_token FROM ranked LEFT JOIN summary USING (wallet_address)""")
def enhanced_traders(spark, sf_dir):
    found = traders.enhanced_traders(positions(spark, sf_dir)).select(
        "wallet_address", "token_address", "total_pnl", "enhanced_smart_trader_score", "performance_tier", "execution_quality_tier", "portfolio_size_tier",
        "overall_rank", "profitability_rank", "execution_rank", "score_percentile", "pnl_percentile", "efficiency_percentile", "tokens_traded",
        "total_portfolio_pnl", "avg_smart_trader_score", "profitable_tokens", "losing_tokens", "best_performing_token",
    )
    found = rounded(found, 4, "total_pnl", "total_portfolio_pnl")
    return rounded(rounded(found, 6, "score_percentile", "pnl_percentile", "efficiency_percentile"), 9, "avg_smart_trader_score")


@query(using("scored") + f""", summary AS ({_SUMMARY})
  SELECT wallet_address, token_address, round(total_pnl, 4) AS total_pnl, enhanced_smart_trader_score, performance_tier, tokens_traded,
         best_performing_token, total_portfolio_pnl FROM scored LEFT JOIN summary USING (wallet_address)""")
def positions_with_summary(spark, sf_dir):
    scored = traders.scored_positions(positions(spark, sf_dir))
    joined = scored.join(traders.wallet_summary(scored), "wallet_address", "left")
    return rounded(
        joined.select("wallet_address", "token_address", "total_pnl", "enhanced_smart_trader_score", "performance_tier", "tokens_traded",
                      "best_performing_token", "total_portfolio_pnl"),
        4, "total_pnl", "total_portfolio_pnl",
    )


@query(using("portfolios") + """SELECT CASE WHEN total_pnl >= 1000 AND roi >= 20 AND win_rate >= 60 AND trade_count >= 10 THEN 'current_criteria'
        WHEN total_pnl >= 500 AND roi >= 15 AND win_rate >= 55 AND trade_count >= 5 THEN 'relaxed_criteria'
        WHEN total_pnl > 0 THEN 'positive_only' ELSE 'negative_pnl' END AS qualification_tier, count(*) AS wallet_count,
        round(avg(total_pnl), 4) AS avg_pnl, round(avg(roi), 4) AS avg_roi, round(avg(win_rate), 4) AS avg_win_rate, round(avg(trade_count), 4) AS avg_trades
    FROM portfolios GROUP BY 1""")
def qualification_counts(spark, sf_dir):
    counted = traders.qualification_counts(portfolios(spark, sf_dir))
    return rounded(counted, 4, "avg_pnl", "avg_roi", "avg_win_rate", "avg_trades")


@query(using("portfolios") + """SELECT count(*) AS n_rows, count(DISTINCT wallet_address) AS wallets, count(*) FILTER (WHERE total_pnl = 0) AS zero_pnl,
        round(count(*) FILTER (WHERE total_pnl = 0) * 100 / count(*), 2) AS zero_pnl_pct, count(*) FILTER (WHERE total_pnl > 0) AS profitable,
        min(total_pnl) AS min_pnl, max(total_pnl) AS max_pnl, round(avg(total_pnl), 4) AS avg_pnl, count(*) - count(total_pnl) AS null_pnl FROM portfolios""")
def wallet_pnl_profile(spark, sf_dir):
    return rounded(traders.pnl_profile(portfolios(spark, sf_dir)), 4, "avg_pnl")


@query(using("portfolios") + "SELECT wallet_address, total_pnl, trade_count FROM portfolios ORDER BY abs(total_pnl) DESC, wallet_address LIMIT 20")
def largest_results(spark, sf_dir):
    top = top_n(portfolios(spark, sf_dir), [F.desc(F.abs("total_pnl")), F.asc("wallet_address")], 20)
    return top.select("wallet_address", "total_pnl", "trade_count")


@query(using("trades") + "SELECT wallet_address, max(trade_time) AS latest_activity, count(*) AS n_rows FROM trades GROUP BY wallet_address")
def latest_activity(spark, sf_dir):
    from tidemark.operators.incremental import latest_activity as activity

    return activity(trades(spark, sf_dir), "wallet_address", "trade_time")
