"""The registered queries again, as plain SQL over the sample tables.

Written from the definitions, not from the Spark code: baselines by self-join, positions
by `row_number`, returns by `lag`.
"""

from __future__ import annotations

# --- shared common table expressions, in dependency order -----------------------------------------


def _bars(symbol: str, name: str) -> str:
    return f"""
ticks_{name} as (
  select {symbol} as symbol, cast(l.l_shipdate as date) as date,
         100 + l.l_extendedprice / 10000 as price, l.l_quantity as qty,
         row_number() over (partition by {symbol}, cast(l.l_shipdate as date)
           order by l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity) as rn,
         count(*) over (partition by {symbol}, cast(l.l_shipdate as date)) as n
  from lineitem l join part p on l.l_partkey = p.p_partkey),
{name} as (
  select symbol,
       case when symbol = 'Brand#1' then 'benchmark'
            when symbol in ('Brand#2','Brand#3','Brand#4','Brand#5','Brand#6','Brand#7','Brand#8',
                            'Brand#9','Brand#10','Brand#11','Brand#12') then 'sector'
            else 'basket' end as category,
       date,
       max(case when rn = 1 then price end) as open, max(price) as high, min(price) as low,
       max(case when rn = n then price end) as close, cast(sum(qty) as bigint) as volume
  from ticks_{name} group by symbol, date)"""


def _returns(bars: str, name: str) -> str:
    return f"""
{name}_lagged as (
  select *, lag(close) over (partition by symbol order by date) as prev,
         lag(date) over (partition by symbol order by date) as prev_date
  from {bars}),
{name} as (
  select * exclude (prev), close - prev as change, (close - prev) / nullif(prev, 0) as daily_return
  from {name}_lagged)"""


CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "bars": (_bars("p.p_brand", "bars"), ()),
    "part_bars": (_bars("cast(l.l_partkey as varchar)", "part_bars"), ()),
    "ret": (_returns("bars", "ret"), ("bars",)),
    "part_ret": (_returns("part_bars", "part_ret"), ("part_bars",)),
    "indicators": (
        """
indicators as (
  select o_orderpriority as series, cast(date_trunc('month', o_orderdate) as date) as date,
         max(o_totalprice) as value
  from orders where o_orderpriority <> '1-URGENT' group by 1, 2
  union all
  select '1-URGENT' as series, cast(o_orderdate as date) as date, max(o_totalprice) as value
  from orders where o_orderpriority = '1-URGENT' group by 1, 2)""",
        (),
    ),
    "attention": (
        """
attention as (
  select o_orderstatus as topic, cast(o_orderdate as date) as date, count(*) as views from orders group by 1, 2)""",
        (),
    ),
    "event_days": (
        """
event_days as (
  select event_type, cast(ts as date) as snapshot_date, count(*) as n from events group by 1, 2)""",
        (),
    ),
    "levels": (
        """
levels as (
  select event_type as entity, snapshot_date,
         cast(sum(n) over (partition by event_type order by snapshot_date) as bigint) as level
  from event_days)""",
        ("event_days",),
    ),
    "counts": (
        """
counts as (
  select event_type as category, snapshot_date,
         cast(sum(n) over (partition by event_type order by snapshot_date
              range between interval 6 days preceding and current row) as bigint) as count
  from event_days)""",
        ("event_days",),
    ),
    "run_log": (
        """
run_log as (
  select cast(ts as date) as date, ts, event_id, event_type as event, strftime(ts, '%H:%M') as time_utc,
         case when event_type = 'view' then null when event_type = 'error' then 'failure' else 'success' end
           as conclusion,
         case when event_type = 'view' then 'in_progress' when event_type = 'error' then 'failure'
              else 'success' end as status
  from events)""",
        (),
    ),
    "vol": (
        """
vol_counted as (
  select *, sum(case when daily_return is not null then 1 else 0 end)
              over (partition by symbol order by date) as seen,
         stddev_samp(daily_return) over (partition by symbol order by date
              rows between 19 preceding and current row) as dev
  from ret),
vol as (
  select symbol, category, date, case when seen >= 20 then dev end as rolling_volatility from vol_counted)""",
        ("ret",),
    ),
    "part_vol": (
        """
part_counted as (
  select *, count(daily_return) over (partition by symbol order by date) as seen,
         stddev_samp(daily_return) over (partition by symbol order by date
              rows between 19 preceding and current row) as dev
  from part_ret)""",
        ("part_ret",),
    ),
    "bench_vol": (
        "bench_vol as (select symbol, date, rolling_volatility from vol where category = 'benchmark')",
        ("vol",),
    ),
    "spread": (
        """
basket_mean as (select date, avg(daily_return) as basket_return from ret where category = 'basket' group by date),
bench_ret as (select date, daily_return as benchmark_return from ret where category = 'benchmark'),
spread as (
  select coalesce(a.date, b.date) as date, a.basket_return, b.benchmark_return,
         a.basket_return - b.benchmark_return as spread
  from basket_mean a full outer join bench_ret b on a.date = b.date)""",
        ("ret",),
    ),
    "attn": (
        """
attn_total as (select date, cast(sum(views) as bigint) as views from attention group by date),
attn_lagged as (select *, lag(views) over (order by date) as prev from attn_total),
attn as (select date, views, (views - prev) / nullif(prev, 0) as pct_change from attn_lagged)""",
        ("attention",),
    ),
    "lags": (
        """
lag_merged as (
  select a.pct_change as x, s.basket_return as y,
         row_number() over (order by coalesce(a.date, s.date)) as pos
  from attn a full outer join spread s on a.date = s.date),
lag_list as (select cast(k as integer) as lag from range(-10, 11) as t(k)),
lags as (
  select l.lag, count(b.y) as n_pairs, case when count(b.y) >= 3 then corr(a.x, b.y) end as correlation
  from lag_list l
  left join lag_merged a on a.x is not null
  left join lag_merged b on b.pos = a.pos + l.lag and b.y is not null
  group by l.lag)""",
        ("attn", "spread"),
    ),
    "symbol_lags": (
        """
bench as (select date, daily_return as y from ret where category = 'benchmark'),
symbol_dates as (
  select symbol, date from ret union select s.symbol, b.date from (select distinct symbol from ret) s cross join bench b),
symbol_line as (
  select d.symbol, r.daily_return as x, b.y, row_number() over (partition by d.symbol order by d.date) as pos
  from symbol_dates d left join ret r on r.symbol = d.symbol and r.date = d.date left join bench b on b.date = d.date),
symbol_list as (select s.symbol, cast(k as integer) as lag from (select distinct symbol from ret) s, range(-10, 11) as t(k)),
symbol_lags as (
  select l.symbol, l.lag, count(b.y) as n_pairs,
         case when count(b.y) >= 3 and stddev_pop(b.y) > 0 and stddev_pop(a.x) > 0 then corr(a.x, b.y) end as correlation
  from symbol_list l
  left join symbol_line a on a.symbol = l.symbol and a.x is not null
  left join symbol_line b on b.symbol = l.symbol and b.pos = a.pos + l.lag and b.y is not null
  group by l.symbol, l.lag)""",
        ("ret",),
    ),
    "symbol_study": (
        """
own_days as (
  select r.symbol, r.date, r.daily_return as change, b.daily_return as r,
         row_number() over (partition by r.symbol order by r.date) as pos
  from ret r left join (select date, daily_return from ret where category = 'benchmark') b on b.date = r.date),
own_spikes as (
  select * from (select *, row_number() over (partition by symbol order by change desc, date) as place
                 from own_days where change is not null) w where place <= 5),
symbol_study as (
  select e.symbol, e.date as spike_date, e.change * 100 as spike_size_pct,
         (coalesce(product(1 + d.r) filter (where d.pos < e.pos), 1) - 1) * 100 as return_before_pct,
         count(d.r) filter (where d.pos < e.pos) as n_before,
         (coalesce(product(1 + d.r) filter (where d.pos > e.pos), 1) - 1) * 100 as return_after_pct,
         count(d.r) filter (where d.pos > e.pos) as n_after
  from own_spikes e
  left join own_days d on d.symbol = e.symbol and d.pos between e.pos - 10 and e.pos + 10 and d.pos <> e.pos and d.r is not null
  group by e.symbol, e.date, e.change, e.pos)""",
        ("ret",),
    ),
    "best": (
        """
best_row as (select * from lags where correlation is not null order by abs(correlation) desc, lag limit 1),
best as (
  select lag as best_lag, correlation as best_corr, n_pairs,
         (select 2 / sqrt(avg(n_pairs)) from lags) as threshold,
         abs(correlation) >= (select 2 / sqrt(avg(n_pairs)) from lags) as above_noise
  from best_row)""",
        ("lags",),
    ),
    "study": (
        """
attn_pos as (select *, row_number() over (order by date) as pos from attn),
spikes as (select * from attn_pos where pct_change is not null order by pct_change desc, date limit 5),
attn_ret as (select p.pos, s.basket_return as r from attn_pos p join spread s on p.date = s.date
             where s.basket_return is not null),
study as (
  select e.date as spike_date, e.pct_change * 100 as spike_size_pct,
         (coalesce(product(1 + r.r) filter (where r.pos < e.pos), 1) - 1) * 100 as return_before_pct,
         count(r.r) filter (where r.pos < e.pos) as n_before,
         (coalesce(product(1 + r.r) filter (where r.pos > e.pos), 1) - 1) * 100 as return_after_pct,
         count(r.r) filter (where r.pos > e.pos) as n_after
  from spikes e left join attn_ret r on r.pos between e.pos - 10 and e.pos + 10 and r.pos <> e.pos
  group by e.date, e.pct_change, e.pos)""",
        ("attn", "spread"),
    ),
    "study_mean": (
        """
study_mean as (
  select avg(return_before_pct) as return_before_pct, avg(return_after_pct) as return_after_pct,
         avg(return_after_pct) - avg(return_before_pct) as gap_pts from study)""",
        ("study",),
    ),
    "rates": (
        """
rate_lagged as (select date, value, lag(value) over (order by date) as prev
                from indicators where series = '1-URGENT'),
rates as (select date, case when value > prev then 'rising' when value < prev then 'falling' end as direction
          from rate_lagged)""",
        ("indicators",),
    ),
    "sensitivity": (
        """
sensitivity as (
  select s.symbol,
         round((product(1 + s.daily_return) filter (where r.direction = 'rising') - 1) * 100, 2) as rising,
         round((product(1 + s.daily_return) filter (where r.direction = 'falling') - 1) * 100, 2) as falling
  from ret s join rates r on s.date = r.date
  where s.category = 'sector' and s.daily_return is not null and r.direction is not null
  group by s.symbol)""",
        ("ret", "rates"),
    ),
    "cohorts": (
        """
cohort_list as (
  select 'core' as cohort, 'Brand#' || i as symbol from range(13, 19) as t(i)
  union all select 'infra', 'Brand#' || i from range(19, 26) as t(i)
  union all select 'legacy', 'Brand#' || i from range(13, 16) as t(i)),
cohorts as (select c.cohort, r.* from ret r join cohort_list c on r.symbol = c.symbol where r.category = 'basket')""",
        ("ret",),
    ),
    "summary": (
        """
cohort_mean as (
  select cohort, date, avg(daily_return) as mean_return from cohorts
  where daily_return is not null and cohort <> 'legacy' group by cohort, date),
member_total as (
  select cohort, symbol, (product(1 + daily_return) - 1) * 100 as total from cohorts
  where daily_return is not null and cohort <> 'legacy' group by cohort, symbol),
summary as (
  select d.cohort, d.final_return_pct, d.annual_vol, m.members, m.negative_members, m.worst_member,
         m.worst_return_pct, m.median_return_pct
  from (select cohort, (product(1 + mean_return) - 1) * 100 as final_return_pct,
               stddev_samp(mean_return) * sqrt(252) as annual_vol from cohort_mean group by cohort) d
  join (select cohort, count(*) as members, count(*) filter (where total < 0) as negative_members,
               arg_min(symbol, total) as worst_member, min(total) as worst_return_pct,
               median(total) as median_return_pct from member_total group by cohort) m
  on d.cohort = m.cohort)""",
        ("cohorts",),
    ),
    "gap": (
        """
gap as (
  select i.final_return_pct as left_final_pct, c.final_return_pct as right_final_pct,
         i.final_return_pct - c.final_return_pct as gap_pts, i.annual_vol / c.annual_vol as vol_ratio,
         i.negative_members
  from summary i, summary c where i.cohort = 'infra' and c.cohort = 'core')""",
        ("summary",),
    ),
    "history": (
        """
history as (
  select cast(date_trunc('month', date) as date) as snapshot_date, 'volume' as section, symbol as metric,
         cast(sum(volume) as double) as value from bars group by 1, 3)""",
        ("bars",),
    ),
    "fresh": (
        """
probed as (
  select 'market_daily' as "table", max(date) as latest_date, count(*) as total_rows, 'trading_day' as cadence from ret
  union all select 'volatility', max(date), count(*), 'trading_day' from bench_vol
  union all select 'spread', max(date), count(*), 'trading_day' from spread
  union all select 'indicators', max(date), count(*), 'mixed' from indicators
  union all select 'attention', max(date), count(*), 'daily_lagged' from attention
  union all select 'levels', max(snapshot_date), count(*), 'daily' from levels),
fresh as (
  select *, case when latest_date is null then 'NO DATA'
                 when cadence = 'trading_day' then
                   case when latest_date >= date '2001-11-02' then 'FRESH' else 'STALE' end
                 when cadence = 'mixed' then 'SEE PER-SERIES'
                 when date '2001-11-05' - latest_date <= case cadence when 'daily' then 1 else 2 end
                   then 'FRESH' else 'STALE' end as status
  from probed)""",
        ("ret", "bench_vol", "spread", "indicators", "attention", "levels"),
    ),
    "series_fresh": (
        """
series_fresh as (
  select series, max(date) as latest_date, count(*) as total_rows,
         case when date '2001-11-05' - max(date) <= case when series = '1-URGENT' then 5 else 75 end
              then 'FRESH' else 'STALE' end as status
  from indicators group by series)""",
        ("indicators",),
    ),
    "stale": (
        """
stale as (
  select "table" as source from fresh where status = 'STALE'
  union all select 'series:' || series from series_fresh where status = 'STALE')""",
        ("fresh", "series_fresh"),
    ),
    "state": (
        """
state as (
  select cast(arg_max(ts, ts) filter (where conclusion is not null) as date) as completed_date,
         arg_max(conclusion, ts) filter (where conclusion is not null) as completed_status,
         coalesce(bool_or(conclusion is null and date = date '2024-01-31'), false) as in_progress_today
  from run_log)""",
        ("run_log",),
    ),
    "incidents": (
        """
incidents as (
  select count(*) as open_incidents, cast(max(ts) as date) as latest_opened,
         arg_max('incident ' || event_id, ts) as latest_title
  from events where event_type = 'error' and value > 100)""",
        (),
    ),
}


def _with(body: str, *needs: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for dep in CTES[name][1]:
            add(dep)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    return "with " + ",\n".join(CTES[n][0].strip() for n in order) + "\n" + body if order else body


# --- pieces used by several queries -----------------------------------------------------------------


def _compound(source: str, span: int | None) -> str:
    cut = "true" if span is None else f"date >= anchor - {span}"
    used = "where daily_return is not null"
    return f"""
select symbol, round(product(1 + daily_return) filter ({used}) - 1, 6) as value,
       arg_min(coalesce(prev_date, date), date) filter ({used}) as start_date,
       max(date) filter ({used}) as end_date
from (select *, max(date) over (partition by symbol) as anchor from {source}) w
where {cut} group by symbol"""


def _delta(table: str, ent: str, dt: str, val: str, days: int | None, out: str = "value") -> str:
    cut = "true" if days is None else f"{dt} >= anchor - {days}"
    return f"""
select {ent}, case when count(*) >= 2 then arg_max({val}, {dt}) - arg_min({val}, {dt}) end as {out},
       case when count(*) >= 2 then min({dt}) end as start_date, case when count(*) >= 2 then max({dt}) end as end_date
from (select *, max({dt}) over (partition by {ent}) as anchor from {table} where {val} is not null) w
where {cut} group by {ent}"""


def _concentration(source: str, where: str, places: int | None) -> str:
    share = "volume * 100.0 / total" if places is None else f"round(volume / total * 100, {places})"
    return f"""
select n, round(hhi, 6) as hhi, top_entity, round(top, 6) as top_share_pct, round(second, 6) as second_share_pct,
       round(10000 / nullif(hhi, 0), 6) as effective_n,
       case when hhi > 2500 then 'highly concentrated' when hhi > 1500 then 'moderately concentrated'
            else 'unconcentrated' end as band,
       round(100e0 / n, 6) as fair_share_pct, round(100 - top, 6) as rest_share_pct,
       round(top / (100e0 / n), 6) as top_vs_fair, round(top / nullif(second, 0), 6) as top_vs_second,
       case when top > 100 - top then 'more than the rest' when top >= (100 - top) * 0.8 then 'nearly the rest'
            else 'clear minority' end as top_vs_rest
from (select count(*) as n, sum(share * share) as hhi,
             max(case when place = 1 then symbol end) as top_entity,
             max(case when place = 1 then share end) as top, max(case when place = 2 then share end) as second
      from (select symbol, share, row_number() over (order by share desc, symbol) as place
            from (select symbol, {share} as share
                  from (select symbol, cast(sum(volume) as double) as volume,
                               sum(sum(volume)) over () as total
                        from {source} where {where} group by symbol) a) b) c) d"""


def _return_windows(source: str) -> str:
    used = "where daily_return is not null"
    parts = [
        f"""
select symbol, cast({'null' if days is None else days} as integer) as days,
       round(product(1 + daily_return) filter ({used}) - 1, 6) as value,
       arg_min(coalesce(prev_date, date), date) filter ({used}) as start_date, max(date) filter ({used}) as end_date,
       arg_min(open, date) as open, max(high) as high, min(low) as low, arg_max(close, date) as close, max(date) as as_of
from (select *, max(date) over (partition by symbol) as anchor from {source}) w
where {'true' if days is None else f'date >= anchor - {max(days - 1, 0)}'} group by symbol"""
        for days in (1, 7, 30, 90, None)
    ]
    return " union all ".join(parts)


def _volume_windows() -> str:
    parts = [
        f"""
select symbol, cast({'null' if days is None else days} as integer) as days, cast(sum(volume) as bigint) as value, count(volume) as bars
from (select *, max(date) over () as anchor from bars) w
where {'true' if days is None else f'date >= anchor - {days}'} group by symbol"""
        for days in (1, 7, 30, 90, None)
    ]
    return " union all ".join(parts)


_BASKET_SUMS = """
select symbol, cast(sum(volume) as bigint) as value
from (select *, max(date) over () as anchor from ret where category = 'basket') w
where date >= anchor - 30 group by symbol"""

_READY = """
select '{name}' as input, count(*) as collected, cast(20 as bigint) as needed, count({val}) as usable,
       count(distinct {dt}) as dates, count({val}) > 0 as ready, count(distinct {dt}) < 2 as latest_only from {table}"""


def _metric(section: str, metric: str, value: str, table: str, label: str = "null") -> str:
    return f"""
select (select max(date) from ret) as snapshot_date, '{section}' as section, '{metric}' as metric,
       round(cast({value} as double), 6) as value, cast({label} as varchar) as label from {table}"""


_TREND = """select series, date, value, value - prev as change,
       case when prev is null then 'n/a' when value > prev then 'up' when value < prev then 'down' else 'flat' end
         as trend
from (select *, lag(value) over (partition by series order by date) as prev from indicators) x"""

_TOTALS = """(select (product(1 + basket_return) - 1) * 100 as l, (product(1 + benchmark_return) - 1) * 100 as r
 from spread where basket_return is not null and benchmark_return is not null) t"""

_CONC_ALL = f"({_concentration('ret', "category = 'basket'", None)}) t"

ORACLE: dict[str, str] = {
    # gold
    "market_daily": _with("select * exclude (prev_date) from ret", "ret"),
    "market_daily_by_part": _with("select * exclude (prev_date) from part_ret", "part_ret"),
    "sector_returns": _with("select symbol, date, volume, daily_return from ret where category = 'sector'", "ret"),
    "basket_detail": _with("select symbol, date, volume, daily_return from ret where category = 'basket'", "ret"),
    "rolling_volatility": _with(
        "select symbol, date, round(rolling_volatility, 6) as rolling_volatility from vol", "vol"
    ),
    "bucketed_volatility": _with(
        "select symbol, date, round(rolling_volatility, 6) as rolling_volatility from vol", "vol"
    ),
    "rolling_volatility_by_part": _with(
        "select symbol, date, round(case when seen >= 20 then dev end, 6) as rolling_volatility from part_counted",
        "part_vol",
    ),
    "bucketed_volatility_by_part": _with(
        "select symbol, date, round(case when seen >= 20 then dev end, 6) as rolling_volatility from part_counted",
        "part_vol",
    ),
    "basket_vs_benchmark": _with(
        "select date, round(basket_return, 6) as basket_return, round(benchmark_return, 6) as benchmark_return,"
        " round(spread, 6) as spread from spread",
        "spread",
    ),
    "indicator_trend": _with(_TREND, "indicators"),
    "table_rebuild": _with(_TREND, "indicators"),
    "attention_index": _with(
        """select a.topic, a.date, a.views, round(a.views / nullif(b.views, 0) * 100, 6) as index
from attention a
join (select topic, min(date) as date from attention group by topic) f on a.topic = f.topic
join attention b on b.topic = f.topic and b.date = f.date""",
        "attention",
    ),
    "level_history": _with("select * from levels", "levels"),
    "trailing_count": _with("select * from counts", "counts"),
    "count_history": _with("select * from counts", "counts"),
    # panels
    "compound_return_1": _with(_compound("ret", 0), "ret"),
    "compound_return_7": _with(_compound("ret", 6), "ret"),
    "compound_return_30": _with(_compound("ret", 29), "ret"),
    "compound_return_90": _with(_compound("ret", 89), "ret"),
    "compound_return_all": _with(_compound("ret", None), "ret"),
    "compound_return_90_by_part": _with(_compound("part_ret", 89), "part_ret"),
    "trailing_rows_7d": _with(
        "select symbol, date, close, volume from (select *, max(date) over (partition by symbol) as anchor from bars) w"
        " where date >= anchor - 7",
        "bars",
    ),
    "spread_return_30d": _with(
        " union all ".join(
            f"""select '{side}' as side, round(product(1 + {side}) - 1, 6) as value,
       arg_min(coalesce(prev_date, date), date) filter (where {side} is not null) as start_date,
       max(date) filter (where {side} is not null) as end_date
from (select *, lag(date) over (order by date) as prev_date, max(date) over () as anchor from spread) w
where date >= anchor - 29"""
            for side in ("basket_return", "benchmark_return")
        ),
        "spread",
    ),
    "ohlc_window_30d": _with(
        """select symbol, round(product(1 + daily_return) - 1, 6) as value,
       arg_min(coalesce(prev_date, date), date) filter (where daily_return is not null) as start_date,
       max(date) filter (where daily_return is not null) as end_date,
       arg_min(open, date) as open, max(high) as high, min(low) as low, arg_max(close, date) as close,
       max(date) as as_of
from (select *, max(date) over (partition by symbol) as anchor from ret) w
where date >= anchor - 29 group by symbol""",
        "ret",
    ),
    "sector_board": _with(
        f"select * from ({_compound("(select * from ret where category = 'sector')", 29)}) x where value is not null",
        "ret",
    ),
    "level_delta_1": _with(_delta("levels", "entity", "snapshot_date", "level", 1), "levels"),
    "level_delta_7": _with(_delta("levels", "entity", "snapshot_date", "level", 7), "levels"),
    "level_delta_all": _with(_delta("levels", "entity", "snapshot_date", "level", None), "levels"),
    "growth_board": _with(
        f"select * from ({_delta('levels', 'entity', 'snapshot_date', 'level', 30)}) x where value is not null",
        "levels",
    ),
    "indicator_board": _with(
        f"""select n.series, n.date, n.value, round(d.change, 6) as change, d.start_date, d.end_date,
       d.change is not null as enough_history, n.series <> '5-LOW' as rate_series
from (select series, max(date) as date, arg_max(value, date) as value from indicators group by series) n
left join ({_delta('indicators', 'series', 'date', 'value', 30, 'change')}) d on n.series = d.series""",
        "indicators",
    ),
    "window_volume_30d": _with(
        """select symbol, cast(sum(volume) as bigint) as value, min(min(date)) over () as start_date,
       max(max(date)) over () as end_date
from (select *, max(date) over () as anchor from bars) w where date >= anchor - 30 group by symbol""",
        "bars",
    ),
    "top_n_other": _with(
        """, sums as (select symbol, cast(sum(volume) as bigint) as value from bars group by symbol),
placed as (select *, row_number() over (order by value desc, symbol) as place from sums)
select symbol, value, cast(place as integer) as slot from placed where place <= 6
union all select 'Other', cast(sum(value) as bigint), 7 from placed where place > 6 having count(*) > 0""",
        "bars",
    ),
    "volume_board_by_part": _with(
        """, sums as (select symbol, cast(sum(volume) as bigint) as value from part_bars group by symbol),
placed as (select *, row_number() over (order by value desc, symbol) as place from sums),
slots as (
  select symbol, value, cast(place as integer) as slot from placed where place <= 10
  union all select 'Other', cast(sum(value) as bigint), 11 from placed where place > 10 having count(*) > 0)
select symbol, value, slot, round(value / (select sum(value) from sums) * 100, 6) as share_pct from slots""",
        "part_bars",
    ),
    "volume_share_30d": _with(
        f""", sums as ({_BASKET_SUMS}),
placed as (select *, row_number() over (order by value desc, symbol) as place from sums),
slots as (
  select symbol, value, cast(place as integer) as slot from placed where place <= 6
  union all select 'Other', cast(sum(value) as bigint), 7 from placed where place > 6 having count(*) > 0)
select symbol, value, slot, round(value / (select sum(value) from sums) * 100, 6) as share_pct from slots""",
        "ret",
    ),
    "rebased_index_90d": _with(
        """, win as (select topic, date, views from (select *, max(date) over () as anchor from attention) w
            where date >= anchor - 90)
select topic, date, views, round(views / nullif(first_value(views) over (partition by topic order by date), 0) * 100, 6)
         as index from win""",
        "attention",
    ),
    "aligned_series": _with(
        """, win as (select topic, date, views from (select *, max(date) over () as anchor from attention) w
            where date >= anchor - 90)
select d.date, t.topic, w.views from (select distinct date from win) d
cross join (select * from (values ('F'), ('O'), ('P')) as v(topic)) t
left join win w on w.date = d.date and w.topic = t.topic""",
        "attention",
    ),
    "return_windows": _with(_return_windows("ret"), "ret"),
    "return_windows_by_part": _with(_return_windows("part_ret"), "part_ret"),
    "refreshed_windows": _with(_return_windows("ret"), "ret"),
    "volume_windows": _with(_volume_windows(), "bars"),
    "latest_per_series": _with(
        "select series, max(date) as date, arg_max(value, date) as value from indicators group by series", "indicators"
    ),
    "readiness": _with(
        " union all ".join(
            _READY.format(name=n, dt=d, val=v, table=t)
            for n, d, v, t in (
                ("market_daily", "date", "daily_return", "ret"),
                ("volatility", "date", "rolling_volatility", "bench_vol"),
                ("levels", "snapshot_date", "level", "levels"),
            )
        ),
        "bench_vol",
        "levels",
    ),
    "as_of_dates": _with(
        """select 'bars' as input, max(date) as as_of from bars
union all select 'indicators', max(date) from indicators
union all select 'attention', max(date) from attention
union all select 'levels', max(snapshot_date) from levels""",
        "bars",
        "indicators",
        "attention",
        "levels",
    ),
    "volatility_panel_90d": _with(
        """select symbol, date, round(rolling_volatility, 6) as rolling_volatility,
       (select max(date) from bench_vol) as latest_date,
       (select round(arg_max_null(rolling_volatility, date), 6) from bench_vol) as latest_value
from (select *, max(date) over () as anchor from bench_vol where rolling_volatility is not null) w
where date >= anchor - 90""",
        "bench_vol",
    ),
    # findings
    "cumulative_curves": _with(
        """, whole as (select * from spread where basket_return is not null and benchmark_return is not null)
select date, round(basket_return, 6) as basket_return, round(benchmark_return, 6) as benchmark_return,
       round(product(1 + basket_return) over (order by date rows unbounded preceding) - 1, 6) as basket_cum,
       round(product(1 + benchmark_return) over (order by date rows unbounded preceding) - 1, 6) as benchmark_cum
from whole""",
        "spread",
    ),
    "spread_totals": _with(
        """select round(l, 6) as left_total_pct, round(r, 6) as right_total_pct, start_date, end_date,
       round(l - r, 6) as spread_pts, case when l - r > 0 then 'outperformed' else 'underperformed' end as side,
       case when abs(l - r) >= 5 then 'wide' else 'narrow' end as width
from (select (product(1 + basket_return) - 1) * 100 as l, (product(1 + benchmark_return) - 1) * 100 as r,
             min(date) as start_date, max(date) as end_date
      from spread where basket_return is not null and benchmark_return is not null) x""",
        "spread",
    ),
    "attention_change": _with("select date, views, round(pct_change, 6) as pct_change from attn", "attn"),
    "attention_spikes": _with(
        "select date, views, round(pct_change, 6) as pct_change from attn where pct_change is not null"
        " order by attn.pct_change desc, date limit 5",
        "attn",
    ),
    "lag_correlation": _with("select lag, round(correlation, 6) as correlation, n_pairs from lags", "lags"),
    "best_lag": _with(
        "select best_lag, round(best_corr, 6) as best_corr, n_pairs, round(threshold, 6) as threshold, above_noise"
        " from best",
        "best",
    ),
    "event_study": _with(
        """select spike_date, round(spike_size_pct, 6) as spike_size_pct, round(return_before_pct, 6)
  as return_before_pct, n_before, round(return_after_pct, 6) as return_after_pct, n_after from study""",
        "study",
    ),
    "lag_correlation_by_symbol": _with(
        "select symbol, lag, round(correlation, 6) as correlation, n_pairs from symbol_lags", "symbol_lags"
    ),
    "best_lag_by_symbol": _with(
        """
select symbol, arg_max(lag, {'r': abs(correlation), 'l': -lag}) filter (where correlation is not null) as best_lag,
       round(arg_max(correlation, {'r': abs(correlation), 'l': -lag}) filter (where correlation is not null), 6) as best_corr,
       arg_max(n_pairs, {'r': abs(correlation), 'l': -lag}) filter (where correlation is not null) as n_pairs,
       round(2 / sqrt(nullif(avg(n_pairs), 0)), 6) as threshold,
       max(abs(correlation)) >= 2 / sqrt(nullif(avg(n_pairs), 0)) as above_noise
from symbol_lags group by symbol""",
        "symbol_lags",
    ),
    "event_study_by_symbol": _with(
        """
select symbol, spike_date, round(spike_size_pct, 6) as spike_size_pct, round(return_before_pct, 6) as return_before_pct,
       n_before, round(return_after_pct, 6) as return_after_pct, n_after from symbol_study""",
        "symbol_study",
    ),
    "event_summary": _with(
        "select round(return_before_pct, 6) as return_before_pct, round(return_after_pct, 6) as return_after_pct,"
        " round(gap_pts, 6) as gap_pts from study_mean",
        "study_mean",
    ),
    "volume_share": _with(
        """select symbol, volume, round(volume / total * 100, 6) as share_pct
from (select symbol, cast(sum(volume) as bigint) as volume, sum(sum(volume)) over () as total
      from ret where category = 'basket' group by symbol) x""",
        "ret",
    ),
    "concentration": _with(_concentration("ret", "category = 'basket'", None), "ret"),
    "concentration_cohort": _with(
        " union all ".join(
            f"select '{g}' as cohort, * from ({_concentration('cohorts', f"cohort = '{g}'", 1)}) x"
            for g in ("core", "infra", "legacy")
        ),
        "cohorts",
    ),
    "rate_direction": _with("select * from rates", "rates"),
    "rate_sensitivity": _with("select * from sensitivity", "sensitivity"),
    "rate_exceptions": _with("select * from sensitivity where rising > falling", "sensitivity"),
    "rate_exception_counts": _with(
        """select count(*) as total, count(*) filter (where rising > falling) as exceptions,
       count(*) - count(*) filter (where rising > falling) as typical from sensitivity""",
        "sensitivity",
    ),
    "volatility_extremes": _with(
        """, known as (select *, rolling_volatility as v from bench_vol where rolling_volatility is not null)
select symbol, min(date) as first_date, round(arg_min(v, date), 6) as first_value, max(date) as latest_date,
       round(arg_max(v, date), 6) as latest_value,
       min(date) filter (where v = (select max(v) from known)) as max_date, round(max(v), 6) as max_value,
       min(date) filter (where v = (select min(v) from known)) as min_date, round(min(v), 6) as min_value,
       round(avg(v), 6) as mean_value, round(max(v) / avg(v), 6) as max_to_mean
from known group by symbol""",
        "bench_vol",
    ),
    "cohort_members": _with("select cohort, symbol, count(*) as bars from cohorts group by cohort, symbol", "cohorts"),
    "cohort_curve": _with(
        """select cohort, date, round(mean_return, 6) as mean_return,
       round(product(1 + mean_return) over (partition by cohort order by date rows unbounded preceding) - 1, 6)
         as cumulative
from cohort_mean""",
        "summary",
    ),
    "entity_total_return": _with(
        """select symbol, round((product(1 + daily_return) - 1) * 100, 6) as total_return_pct from ret
where daily_return is not null group by symbol""",
        "ret",
    ),
    "cohort_summary": _with(
        """select cohort, round(final_return_pct, 6) as final_return_pct, round(annual_vol, 6) as annual_vol, members,
       negative_members, worst_member, round(worst_return_pct, 6) as worst_return_pct,
       round(median_return_pct, 6) as median_return_pct from summary""",
        "summary",
    ),
    "cohort_gap": _with(
        """select round(left_final_pct, 6) as left_final_pct, round(right_final_pct, 6) as right_final_pct,
       round(gap_pts, 6) as gap_pts, round(vol_ratio, 6) as vol_ratio, negative_members from gap""",
        "gap",
    ),
    "input_coverage": _with(
        """select 'market_daily' as input, max(date) as latest_date, count(daily_return) as known_values from ret
union all select 'attention', max(date), count(views) from attention
union all select 'spread', max(date), count(basket_return) from spread""",
        "spread",
        "attention",
    ),
    # snapshots
    "metric_change": _with(
        """select snapshot_date, section, metric, value, previous,
       case when previous is null then 'first' when round(value - previous, 1) = 0 then 'flat'
            when value > previous then 'up' else 'down' end as moved,
       abs(round(value - previous, 1)) as magnitude
from (select *, lag(value) over (partition by section, metric order by snapshot_date) as previous from history) x""",
        "history",
    ),
    "snapshot_history": _with("select snapshot_date, section, metric, value from history", "history"),
    "snapshot_last_two": _with(
        """select * from (select *, cast(dense_rank() over (order by snapshot_date desc) as integer) as age
from history) x where age <= 2""",
        "history",
    ),
    "metric_snapshot": _with(
        " union all ".join(
            [
                _metric("spread", "basket_pct", "l", _TOTALS),
                _metric("spread", "benchmark_pct", "r", _TOTALS),
                _metric("spread", "spread_pts", "l - r", _TOTALS),
                _metric("lag", "best_lag", "best_lag", "best"),
                _metric("lag", "best_corr", "best_corr", "best"),
                _metric("events", "return_before_pct", "return_before_pct", "study_mean"),
                _metric("events", "return_after_pct", "return_after_pct", "study_mean"),
                _metric("events", "gap_pts", "gap_pts", "study_mean"),
                _metric("concentration", "top_entity", "null", _CONC_ALL, "top_entity"),
                _metric("concentration", "top_share_pct", "top_share_pct", _CONC_ALL),
                _metric("concentration", "hhi", "hhi", _CONC_ALL),
                _metric("concentration", "effective_n", "effective_n", _CONC_ALL),
                _metric("rates", "typical", "count(*) - count(*) filter (where rising > falling)", "sensitivity"),
                _metric("rates", "total", "count(*)", "sensitivity"),
                _metric("volatility", "latest_pct", "arg_max(rolling_volatility, date) * 100", "bench_vol"),
                _metric("volatility", "max_pct", "max(rolling_volatility) * 100", "bench_vol"),
                _metric("volatility", "max_date", "null", "bench_vol", "arg_max(date, rolling_volatility)"),
                """
select (select max(date) from ret), 'rates', 'exception:' || symbol, cast(null as double), symbol
from sensitivity where rising > falling""",
                _metric("cohorts", "left_final_pct", "left_final_pct", "gap"),
                _metric("cohorts", "right_final_pct", "right_final_pct", "gap"),
                _metric("cohorts", "gap_pts", "gap_pts", "gap"),
                _metric("cohorts", "negative_members", "negative_members", "gap"),
            ]
        ),
        "best",
        "study_mean",
        "sensitivity",
        "bench_vol",
        "gap",
    ),
    # landing and shaping
    "explode_records": _with(
        "select *, cast(date_trunc('month', date) as date) as fetched_on from bars", "bars"
    ),
    "quarantined_documents": _with(
        """
select symbol, date, close, 'landed' as status from bars where month(date) <> 5
union all select null, null, cast(count(distinct (symbol, date_trunc('month', date))) as double), 'broken' from bars where month(date) = 5""",
        "bars",
    ),
    "melt_series": _with("select series, date, value, date as snapshot_date from indicators", "indicators"),
    "parse_json_props": "select event_id, event_type, cast(json_extract(props, '$.k') as bigint) as k from events",
    "settled_bars": _with(
        "select symbol, date, open, high, low, close, volume from bars where volume % 7 not in (0, 1, 2)", "bars"
    ),
    "last_n_bars": _with(
        """select symbol, date, close, volume
from (select *, row_number() over (partition by symbol order by date desc) as rn from bars) x where rn <= 3""",
        "bars",
    ),
    "classify": """select p.p_partkey, p.p_brand,
       case when q.qty > 700 then 'busy' when q.qty is not null then 'quiet' else 'idle' end as category
from part p left join (select l_partkey, sum(l_quantity) as qty from lineitem group by l_partkey) q
  on p.p_partkey = q.l_partkey""",
    "missing_entities": """select c_custkey from customer
where c_custkey not in (select o_custkey from orders where extract(year from o_orderdate) = 1998)""",
    "missing_marker": """select o_orderkey, case when o_orderstatus <> 'P' then o_totalprice end as value from orders""",
    "compact_dates": "select o_orderkey, cast(o_orderdate as date) as date from orders",
    "rounded_bars": _with(
        "select symbol, date, "
        + ", ".join(
            f"cast(round(cast(cast({c} as varchar) as decimal(38, 20)), 2) as double) as {c}"
            for c in ("open", "high", "low", "close")
        )
        + ", volume from bars",
        "bars",
    ),
    "tidy_labels": "select p_partkey, p_name as label from part",
    # tables
    "upsert_overlap": _with(
        """select symbol, category, date, open, high, low, close, volume, cast(1 as integer) as fetched_at
from bars where date < date '1998-06-01'
union all select symbol, category, date, open, high, low, close + 1, volume, 2 from bars where date >= date '1998-06-01'""",
        "bars",
    ),
    "table_profile": _with(
        """select 'bars' as "table", count(*) as rows from bars
union all select 'indicators', count(*) from indicators union all select 'attention', count(*) from attention
union all select 'levels', count(*) from levels union all select 'market_daily', count(*) from ret
union all select 'spread', count(*) from spread""",
        "spread",
        "indicators",
        "attention",
        "levels",
    ),
    "export_clean": _with(
        "select symbol, date, volume, case when volume % 5 > 1 then daily_return end as daily_return from ret", "ret"
    ),
    "export_array": _with("select symbol, date, volume, daily_return from ret", "ret"),
    "snapshot_overwrite": "select s_suppkey, s_acctbal from supplier",
    # freshness
    "last_run_per_day": _with(
        """, ranked as (
  select *, row_number() over (partition by date order by ts desc, event_id desc) as rn,
         row_number() over (partition by date, conclusion is null order by ts desc, event_id desc) as crn
  from run_log),
spine as (select cast(d as date) as date from range(date '2024-01-25', date '2024-02-01', interval 1 day) as t(d))
select s.date, r.time_utc, r.event, r.status, c.conclusion from spine s
left join ranked r on r.date = s.date and r.rn = 1
left join ranked c on c.date = s.date and c.crn = 1 and c.conclusion is not null""",
        "run_log",
    ),
    "run_state": _with("select * from state", "state"),
    "open_incidents": _with("select * from incidents", "incidents"),
    "expected_dates": """select event_id,
       cast(case isodow(d) when 6 then d - 1 when 7 then d - 2 else d end as date) as expected
from (select event_id, cast(ts as date) - case when hour(ts) < 21 then 1 else 0 end as d from events) x""",
    "holiday_status": """
with days as (
  select cast(d as date) as day from generate_series(timestamp '2023-12-01', timestamp '2024-12-31', interval 1 day) t(d)),
open_days as (
  select day from days where isodow(day) < 6 and day not in (date '2023-12-25', date '2024-01-01', date '2024-01-15')),
due as (
  select event_id, cast(ts as date) - cast(event_id % 6 as integer) as latest,
         cast(ts as date) - case when hour(ts) < 21 then 1 else 0 end as ended from events),
expected as (
  select e.*, (select max(day) from open_days o where o.day <= e.ended) as expected from due e),
counted as (
  select *, (select count(*) from open_days o where o.day <= e.expected)
            - (select count(*) from open_days o where o.day <= e.latest) as missing from expected e)
select event_id, latest, expected, missing, case when missing <= 0 then 'FRESH' else 'STALE' end as status from counted""",
    "table_freshness": _with("select * from fresh", "fresh"),
    "table_freshness_from_footers": _with("select * from fresh", "fresh"),
    "table_lineage": _with(
        """select f."table", m.silver, m.bronze, m.date_col, f.cadence, m.panel, f.latest_date, f.total_rows, f.status
from fresh f join (select * from (values
  ('market_daily', 'bars', 'lineitem', 'date', 'Market snapshot'),
  ('volatility', 'bars', 'lineitem', 'date', 'Volatility'),
  ('spread', 'bars', 'lineitem', 'date', 'Basket and benchmark'),
  ('indicators', 'indicators', 'orders', 'date', 'Indicators'),
  ('attention', 'attention', 'orders', 'date', 'Attention'),
  ('levels', 'levels', 'events', 'snapshot_date', 'Growth')) as v(t, silver, bronze, date_col, panel)) m
on f."table" = m.t""",
        "fresh",
    ),
    "series_freshness": _with("select * from series_fresh", "series_fresh"),
    "stale_sources": _with("select * from stale", "stale"),
    "stale_verdict": _with(
        """select *, case when run_ok and data_ok then 'HEALTHY' when data_ok then 'CHECK RUN LOG'
                when run_ok then 'CHECK DATA' else 'NEEDS ATTENTION' end as verdict
from (select *, completed_status = 'success' and open_incidents = 0 as run_ok, stale_sources = 0 as data_ok
      from (select s.*, (select open_incidents from incidents) as open_incidents,
                   (select count(*) from stale) as stale_sources from state s) x) y""",
        "state",
        "incidents",
        "stale",
    ),
    "latest_digest": _with(
        """select 'market' as source, symbol as entity, max(date) as date, round(arg_max(close, date), 6) as value
from ret where category = 'benchmark' group by symbol
union all select 'spread', null, date, round(spread, 6) from spread where date = (select max(date) from spread)
union all select 'volatility', symbol, max(date), round(arg_max(rolling_volatility, date), 6) from bench_vol
  where rolling_volatility is not null group by symbol
union all select 'indicators', series, max(date), round(arg_max(value, date), 6) from indicators group by series
union all select 'attention', topic, max(date), round(arg_max(views, date), 6) from attention group by topic
union all select 'counts', category, max(snapshot_date), round(arg_max(count, snapshot_date), 6) from counts
  group by category
union all select 'levels', entity, snapshot_date, cast(level as double) from levels
  where snapshot_date = (select max(snapshot_date) from levels)""",
        "bench_vol",
        "spread",
        "indicators",
        "attention",
        "counts",
        "levels",
    ),
    # streaming
    "stream_upsert": _with("select * from bars", "bars"),
    "stream_sliding_count": """
select event_type, cast(w as date) as window_start, cast(w as date) + 7 as window_end, count(*) as count
from (select event_type, unnest(range(cast(ts as date) - interval 6 days, cast(ts as date) + interval 1 day,
        interval 1 day)) as w from events) x
group by 1, 2""",
    "stream_sliding_count_kept": """
select event_type, cast(w as date) as window_start, cast(w as date) + 7 as window_end, count(*) as count
from (select event_type, unnest(range(cast(ts as date) - interval 6 days, cast(ts as date) + interval 1 day,
        interval 1 day)) as w from events) x
group by 1, 2""",
    "late_recovery": _with("select * from ret", "ret"),
    "upsert_partial_columns": _with("select * replace (case when month(date) in (3, 6) then close * 2 else close end as close) from bars", "bars"),
    "upsert_catalog_table": _with("select * replace (case when month(date) in (3, 6) then close * 2 else close end as close) from bars", "bars"),
    "incremental_gold": _with(
        """
select 'market_daily' as "table", symbol as key, date, round(daily_return, 6) as value from ret
union all select 'volatility', symbol, date, round(rolling_volatility, 6) from vol
union all select 'spread', 'spread', date, round(spread, 6) from spread
union all select 'curves', cohort, date, round(product(1 + mean_return) over (partition by cohort order by date) - 1, 6) from cohort_mean
union all select 'indexed', topic, date, round(100.0 * views / nullif(first(views) over (partition by topic order by date), 0), 6)
  from attention
union all select 'counts', category, snapshot_date, cast(count as double) from counts""",
        "ret",
        "vol",
        "spread",
        "summary",
        "attention",
        "counts",
    ),
}
