"""Portfolio back-tests over ordered (price, action) rows.

Rules per portfolio: action 1 buys one share when the balance covers the
price, 2 sells one when any is held, anything else holds; net worth is
balance + shares * price.  At a missing price nothing is traded, and the net
worth is missing.

Share counts follow ``s = max(s + x, 0)`` with x = +1 or -1, which has a
closed form over running sums and minima.  So as long as every buy is
affordable, the whole path is computed in parallel, however long one
portfolio is.  Which later buys are affordable after a refused one depends on
all prices between, so portfolios with a refused buy are folded in order: one of
at most ``FOLD_ROWS`` steps as one array expression, all of them at once; a longer
one partition by partition, and no task takes more than one partition of the
layout.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import column
from tidemark.operators.features import with_next_state
from tidemark.operators.ordering import PART, SLOT, OrderedLayout, Running, lay_out
from tidemark.session import materialise, scratch_path

# fixed values of the trading rules
INITIAL_BALANCE = 10_000.0
BUY = 1
SELL = 2
# a portfolio of at most so many steps is folded as one array
FOLD_ROWS = 512
# a balance this close to the price is decided by the replay, in the replay's own rounding
_TIE = 1e-9


def _parallel_path(
    df: DataFrame, by: Sequence[str], order: Sequence[str], initial_balance: float
) -> OrderedLayout:
    """Path under affordable buys, with ``_refused`` marking buys the balance may not cover."""
    price = F.col("price").cast("double")
    known = price.isNotNull() & ~F.isnan(price)
    traded = F.when(~known, 0).when(F.col("action") == BUY, 1).when(F.col("action") == SELL, -1)
    laid = lay_out(df, order, by).with_columns(_wish=traded.otherwise(0).cast("bigint"))
    shares = _with_shares(laid)
    spent = F.when(known, (F.col("shares") - F.col("_shares_before")) * price).otherwise(0.0)
    cash = shares.with_running(_spent=Running("sum", spent)).with_columns(
        balance=F.lit(float(initial_balance)) - F.col("_spent")
    )
    before = F.col("balance") + F.when(known, (F.col("shares") - F.col("_shares_before")) * price).otherwise(0.0)
    slack = F.lit(_TIE) * F.greatest(F.abs(before), F.abs(price), F.lit(1.0))
    path = cash.with_columns(
        net_worth=F.when(known, F.col("balance") + F.col("shares") * price),
        _refused=(F.col("_wish") == 1) & ~(before >= price + slack),
    )
    return replace(path, df=path.df.drop("_wish", "_shares_before", "_spent")).frozen()


def _with_shares(laid: OrderedLayout) -> OrderedLayout:
    """Add ``shares`` and ``_shares_before`` from ``_wish``: the running sum less its lowest point so far.

    Sum and lowest point are carried between partitions together, so one pass
    over the layout yields both.
    """
    columns = [column(c) for c in laid.df.columns]
    window = laid.local_window()
    upto_now = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    local = laid.placed_rows().withColumn("_net", F.sum("_wish").over(upto_now)).withColumn(
        "_low_before", F.min("_net").over(earlier)
    )
    across = Window.partitionBy(*laid.by).orderBy(PART)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        local.groupBy(PART, *laid.by)
        .agg(F.sum("_wish").alias("_total"), F.min("_net").alias("_lowest"))
        .withColumn("_sum", F.sum("_total").over(before))
        .withColumn("_floor", F.min(F.coalesce("_sum", F.lit(0)) + F.col("_lowest")).over(before))
        .filter(F.col("_sum").isNotNull())
    )
    joined = laid.join_carried(local, carried, ["_sum", "_floor"])
    start = F.coalesce("_sum", F.lit(0))
    net = start + F.col("_net")
    floor_before = F.least(F.lit(0), F.col("_floor"), start + F.col("_low_before"))
    return replace(
        laid,
        placed=True,
        df=joined.select(
            *columns,
            (net - F.least(floor_before, net)).alias("shares"),
            (net - F.col("_wish") - floor_before).alias("_shares_before"),
        ),
    )


def _levels(continued: Sequence, by: Sequence[str]) -> dict[int, int]:
    """How many earlier partitions each continued portfolio segment waits for.

    A partition holds at most one segment continued from an earlier one, its first.
    """
    groups = {row[PART]: tuple(row[b] for b in by) for row in continued}
    levels: dict[int, int] = {}
    for row in sorted(continued, key=lambda r: r[PART]):
        part, source = row[PART], row["_from"]
        same = groups.get(source) == groups[part]
        levels[part] = levels[source] + 1 if same else 1
    return levels


def _fold_segments(rows: DataFrame, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """Trade through each (partition, portfolio) segment from the state in ``_balance0, _shares0``."""
    kept = [f for f in rows.schema.fields if f.name not in ("_balance0", "_shares0")]
    schema = T.StructType(
        [
            *kept,
            T.StructField("shares", T.LongType()),
            T.StructField("balance", T.DoubleType()),
            T.StructField("net_worth", T.DoubleType()),
        ]
    )
    keys = [PART, *by]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, balance, shares = None, 0.0, 0
        for batch in batches:
            # a missing key arrives as NaN, which would not equal itself
            named = [[None if v != v else v for v in batch[k].tolist()] for k in keys]
            starts = zip(batch["_balance0"].tolist(), batch["_shares0"].tolist())
            steps = zip(batch["action"].tolist(), batch["price"].astype(float).tolist())
            held, cash, worth = [], [], []
            for key, start, (action, price) in zip(zip(*named), starts, steps):
                if key != current:
                    current, (balance, shares) = key, start
                if action == BUY and balance >= price:
                    balance, shares = balance - price, shares + 1
                elif action == SELL and shares > 0 and price == price:
                    balance, shares = balance + price, shares - 1
                held.append(shares)
                cash.append(balance)
                worth.append(balance + shares * price if price == price else None)
            yield batch.drop(columns=["_balance0", "_shares0"]).assign(shares=held, balance=cash, net_worth=worth)

    # one task per partition of the whole layout, or of the few given ones
    placed = rows.repartitionById(parts, PART) if parts else rows.repartition(PART)
    return placed.sortWithinPartitions(PART, SLOT).mapInPandas(fold, schema)


def _replay(
    given: DataFrame, settled: DataFrame, by: Sequence[str], initial_balance: float, layout_parts: int
) -> DataFrame:
    """Exact row-by-row path of laid-out rows, in one table with the ``settled`` paths.

    All segments that start a portfolio are replayed at once.  A portfolio that
    runs on into further partitions is replayed one partition per round, with
    its last balance and share count handed on, so no task sees more than the
    rows of a partition.
    """
    spark = given.sparkSession
    across = Window.partitionBy(*by).orderBy(PART)
    segments = given.select(PART, *by).distinct().withColumn("_from", F.lag(PART).over(across))
    # at most one row per partition of the layout
    continued = segments.filter(F.col("_from").isNotNull()).collect()
    levels = _levels(continued, by)
    sources = {row[PART]: row["_from"] for row in continued}

    renamed = {PART: "_s_part", **{b: f"_s_{b}" for b in by}}
    waiting = segments.filter(F.col("_from").isNotNull()).withColumnsRenamed(renamed)
    here = (F.col(PART) == F.col("_s_part")) & _same_portfolio(by)
    started = materialise(
        given.join(F.broadcast(waiting), here, "left").drop(*renamed.values()), "replay-rows"
    )
    done: list[str] = []
    schema = None
    for level in range(max(levels.values(), default=0) + 1):
        if level == 0:
            ready = started.filter(F.col("_from").isNull()).withColumns(
                {"_balance0": F.lit(float(initial_balance)), "_shares0": F.lit(0).cast("bigint")}
            )
        else:
            parts = [p for p, n in levels.items() if n == level]
            # the state left by the last row of each awaited partition; one row per partition
            ends = (
                spark.read.schema(schema).parquet(done[-1])
                .filter(F.col(PART).isin([sources[p] for p in parts]))
                .groupBy(F.col(PART).alias("_end_part"))
                .agg(F.max_by(F.struct("balance", "shares"), SLOT).alias("_end"))
            )
            ready = (
                started.filter(F.col("_from").isNotNull() & F.col(PART).isin(parts))
                .join(F.broadcast(ends), F.col("_from") == F.col("_end_part"))
                .withColumns({"_balance0": F.col("_end.balance"), "_shares0": F.col("_end.shares")})
                .drop("_end_part", "_end")
            )
        folded = _fold_segments(ready.drop("_from"), by, layout_parts if level == 0 else None)
        schema = folded.schema
        done.append(scratch_path(spark, "replay"))
        folded.write.parquet(done[-1])
    replayed = spark.read.schema(schema).parquet(*done)
    return replayed.unionByName(materialise(settled, "settled"))


def _same_portfolio(by: Sequence[str]) -> Column:
    """Match against a table whose portfolio columns are prefixed ``_s_``; null keys match each other."""
    match = F.lit(True)
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_s_{b}"))
    return match


def _fold_arrays(given: DataFrame, by: Sequence[str], initial_balance: float) -> DataFrame:
    """Paths of portfolios of bounded length, each folded step by step in one expression."""
    names = [c for c in given.columns if c not in by]
    step = F.struct(F.col(SLOT).alias("_at"), F.struct(*[column(c).alias(c) for c in names]).alias("row"))
    kind = "struct<balance:double,shares:bigint,path:array<struct<shares:bigint,balance:double,net_worth:double>>>"

    def trade(state: Column, one: Column) -> Column:
        price, action = one["row"]["price"].cast("double"), one["row"]["action"]
        known = price.isNotNull() & ~F.isnan(price)
        buys = known & (action == BUY) & (state["balance"] >= price)
        sells = known & (action == SELL) & (state["shares"] > 0)
        balance = F.when(buys, state["balance"] - price).when(sells, state["balance"] + price).otherwise(state["balance"])
        shares = F.when(buys, state["shares"] + 1).when(sells, state["shares"] - 1).otherwise(state["shares"])
        worth = F.when(known, balance + shares * price)
        after = F.struct(shares.alias("shares"), balance.alias("balance"), worth.alias("net_worth"))
        return F.struct(balance.alias("balance"), shares.alias("shares"), F.array_append(state["path"], after).alias("path")).cast(kind)

    start = F.struct(
        F.lit(float(initial_balance)).alias("balance"), F.lit(0).cast("bigint").alias("shares"), F.array().alias("path")
    ).cast(kind)
    gathered = given.groupBy(*by).agg(F.sort_array(F.collect_list(step)).alias("_steps"))
    walked = gathered.withColumn("_path", F.aggregate("_steps", start, trade)["path"])
    rows = walked.select(*by, F.explode(F.arrays_zip("_steps", "_path")).alias("_one"))
    return rows.select(*by, "_one._steps.row.*", "_one._path.*")


def _path_layout(
    df: DataFrame, order: Sequence[str], by: Sequence[str], initial_balance: float
) -> OrderedLayout:
    """The path, still laid out in order for the operators that follow."""
    layout = _parallel_path(df, by, order, initial_balance)
    counted = layout.df.groupBy(*by).agg(F.count(F.lit(1)).alias("_steps_n"), F.max("_refused").alias("_any"))
    refused = materialise(counted.filter("_any").drop("_any"), "refused-portfolios")
    # an array of rows is sorted as a whole, which maps do not allow
    sortable = not any(isinstance(f.dataType, T.MapType) for f in df.schema.fields)
    short = F.col("_steps_n") <= (FOLD_ROWS if sortable else 0)
    n_short, n_long = refused.agg(F.count_if(short), F.count_if(~short)).first()
    if not n_short + n_long:
        return replace(layout, df=layout.df.drop("_refused"))
    # partition and slot travel with the rows, so the layout stays valid
    given = layout.df.select(*[column(c) for c in df.columns], PART, SLOT)
    named = refused.withColumnsRenamed({b: f"_s_{b}" for b in by})
    settled = layout.df.drop("_refused")
    done = settled.join(named, _same_portfolio(by), "left_anti") if by else settled.limit(0)
    if n_short:
        done = done.unionByName(_fold_arrays(_of(given, named.filter(short), by), by, initial_balance))
    if not n_long:
        return replace(layout, df=materialise(done, "back-tested"))
    return replace(layout, df=_replay(_of(given, named.filter(~short), by), done, by, initial_balance, layout.parts))


def _of(given: DataFrame, portfolios: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of some portfolios."""
    return given.join(portfolios, _same_portfolio(by), "left_semi") if by else given


def backtest_path(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    initial_balance: float = INITIAL_BALANCE,
) -> DataFrame:
    """Add ``shares, balance, net_worth`` after each step to rows holding ``price`` and ``action``."""
    return _path_layout(df, order, by, initial_balance).rows()


def _with_reward(layout: OrderedLayout, initial_balance: float) -> OrderedLayout:
    price = F.col("price").cast("double")
    laid = layout.with_previous(_price_before=price)
    first = F.col("net_worth") - F.lit(float(initial_balance))
    moved = F.col("shares") * (price - F.col("_price_before"))
    rewarded = laid.with_columns(reward=F.when(F.col("_price_before").isNull(), first).otherwise(moved))
    return replace(rewarded, df=rewarded.df.drop("_price_before"))


def step_reward(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), initial_balance: float = INITIAL_BALANCE
) -> DataFrame:
    """Back-test ``df`` and add ``reward``: shares held after the trade times the move into the price.

    The first step's reward is its net worth minus the initial balance.
    """
    return _with_reward(_path_layout(df, order, by, initial_balance), initial_balance).rows()


def backtest_summary(
    path: DataFrame, order: Sequence[str], by: Sequence[str] = (), initial_balance: float = INITIAL_BALANCE
) -> DataFrame:
    """Final net worth, profit and profit percentage of each portfolio.

    ``order`` must tell a portfolio's steps apart; of equal last keys, a hash of
    the row decides, as it does where the path is laid out.
    """
    start = F.lit(float(initial_balance))
    last = F.struct(*order, F.xxhash64(*[c for c in path.columns if c not in ("shares", "balance", "net_worth")]))
    final = path.groupBy(*by).agg(F.max_by("net_worth", last).alias("final_net_worth"))
    profit = F.col("final_net_worth") - start
    return final.select(
        *by,
        "final_net_worth",
        profit.alias("total_profit"),
        (F.try_divide(profit, start) * 100).alias("profit_percentage"),
    )


def transitions(
    df: DataFrame,
    features: Sequence[str],
    order: Sequence[str],
    by: Sequence[str] = (),
    initial_balance: float = INITIAL_BALANCE,
) -> DataFrame:
    """``by, order, state, action, reward, next_state, done`` for rows holding features, price and action."""
    path = _path_layout(df, order, by, initial_balance)
    state = F.array(*[F.col(f).cast("double") for f in features])
    rewarded = _with_reward(path.with_columns(state=state), initial_balance)
    stepped = with_next_state(rewarded, "state", len(features))
    return stepped.rows().select(*by, *order, "state", "action", "reward", "next_state", "done")
