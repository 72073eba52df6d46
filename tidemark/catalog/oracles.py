"""The same answers in DuckDB SQL, written on their own terms to check the Spark plans against.

Named steps below are put together into one statement per query, each with the steps it needs. Joins are
the plain range joins and windows the plain textbook ones; nothing here is meant to scale.
"""

from __future__ import annotations

import re

from tidemark import fixed_values as fixed
from tidemark.catalog.queries import CALENDAR, LOOSE_QUALITY, RUN_DATE
from tidemark.catalog.warehouse import DEFAULT, RELAXED
from tidemark.params import SurveillanceParams

STEPS: dict[str, str] = {}
FINAL: dict[str, str] = {}


def rnd(x: str, places: int) -> str:
    """Half up on the first nine decimals (from five places on: on five more than are kept), so that noise decides no tie."""
    return f"cast(round(cast({x} as decimal(38, {9 if places < 5 else places + 5})), {places}) as double)"


def txt(x: str, places: int, sign: str = "") -> str:
    return f"format('{{:{sign}.{places}f}}', {rnd(x, places)})"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def said(template: str, *parts: str) -> str:
    """A phrase with %s and %% as a chain of SQL strings."""
    pieces = template.split("%s")
    out = []
    for i, piece in enumerate(pieces):
        piece = piece.replace("%%", "%").replace("'", "''")
        if piece:
            out.append(f"'{piece}'")
        if i < len(parts):
            out.append(f"cast({parts[i]} as varchar)")
    return "(" + " || ".join(out) + ")"


def plain(x: str) -> str:
    return f"lower(replace({x}, '_', ' '))"


# ---------- source tables ----------

STEPS["nat"] = """
select n_nationkey, n_name as symbol, r_name as industry from nation, region where n_regionkey = r_regionkey"""

STEPS["tr"] = """
select nat.symbol, cast(l.l_shipdate as date) as trade_date,
       cast(round(1e6 + 1e5 * ln(l.l_extendedprice / l.l_quantity)) as bigint) as tick,
       l.l_orderkey * 8 + l.l_linenumber as seq, cast(l.l_quantity as bigint) as qty,
       cast(round(l.l_extendedprice * 100) as bigint) as cents, l.*
from lineitem l join supplier s on s.s_suppkey = l.l_suppkey join nat on nat.n_nationkey = s.s_nationkey"""


def bar_columns() -> str:
    return """
       first(tick order by seq, tick) / 10000 as open, max(tick) / 10000 as high, min(tick) / 10000 as low,
       last(tick order by seq, tick) / 10000 as close, sum(tick * qty) / sum(qty) / 10000 as vwap,
       cast(sum(qty) as bigint) as volume, sum(cents) / 100000 as turnover_lacs, count(*) as num_trades,
       cast(sum(case when l_returnflag <> 'R' then qty else 0 end) as bigint) as deliv_qty,
       100.0::double * sum(case when l_returnflag <> 'R' then qty else 0 end) / sum(qty) as deliv_pct"""


STEPS["day_bar"] = f"select symbol, trade_date, {bar_columns()} from tr group by all"
STEPS["bars_all"] = """
select trade_date, symbol, 'EQ' as series, open, high, low, close,
       lag(close) over (partition by symbol order by trade_date) as prev_close, vwap, volume, close as raw_close,
       volume as raw_volume, 1.0::double as adj_factor, turnover_lacs, num_trades, deliv_qty, deliv_pct
from day_bar"""
STEPS["ser_bar"] = f"""
select *, close as last, lag(close) over (partition by symbol, series order by trade_date) as prev_close
from (select symbol, trade_date,
             case when l_linestatus = 'O' then 'EQ' when l_returnflag = 'R' then 'GC' else 'BE' end as series,
             {bar_columns()} from tr group by all)"""

STEPS["ord"] = """
select o.*, cast(o.o_orderdate as date) as day, c.c_name, c.c_mktsegment, nat.*, left(o.o_orderpriority, 1) as pri
from orders o join customer c on c.c_custkey = o.o_custkey join nat on nat.n_nationkey = c.c_nationkey"""


def filing_class(category: str, summary: str) -> str:
    arms = []
    for label, contains, starts, equals in fixed.FILING_CLASSES:
        tests = [f"contains(lower({category}), '{w}')" for w in contains]
        tests += [f"starts_with(lower({category}), '{w}')" for w in starts]
        if equals:
            tests.append(f"{category} in ({quoted(equals)})")
        if label == "RESULTS":
            tests.append(f"regexp_matches({summary}, '{fixed.RESULTS_SUMMARY_PATTERN}')")
        arms.append(f"when {' or '.join(tests)} then '{label}'")
    return f"case {' '.join(arms)} else '{fixed.FILING_OTHER}' end"


STEPS["filing"] = f"""
select *, {filing_class('category', 'summary')} as news_type from (
  select cast(o_orderkey as varchar) as seq_id, symbol, o_orderdate as announced_at, day as announced_date,
         case pri when '1' then 'Spurt in Volume' when '2' then 'Financial Result Updates'
                  when '3' then 'Bagging/Receiving of orders/contracts' when '4' then 'Trading Window'
                  else case o_orderstatus when 'O' then 'Acquisition' when 'F' then 'Credit Rating'
                       else 'General Updates' end end as category,
         case when o_totalprice > 300000 then 'Business update for q' || quarter(day) || ' FY' || strftime(day, '%y')
              else 'Letter of order ' || o_orderkey end as summary,
         'filing-' || o_orderkey || '.pdf' as attachment_url
  from ord)"""

STEPS["lists"] = """
select date_trunc('month', day)::date as snapshot_date, symbol,
       case pri when '1' then 'STASM' when '2' then 'LTASM' when '3' then 'GSM' when '4' then 'STASM'
            else 'LTASM' end as list_type,
       'Stage ' || count(*) as stage,
       'Order worth ' || max(cast(round(o_totalprice * 100) as bigint)) as description
from ord where o_orderstatus = 'P' and o_totalprice > 400000 group by 1, 2, 3"""

STEPS["master"] = """
select date_trunc('quarter', day)::date as snapshot_date, symbol,
       concat_ws(' ', symbol, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]), 'Limited') as company_name,
       case o_orderstatus when 'P' then 'BE' else 'EQ' end as series,
       date '1990-01-01' + n_nationkey as listing_date, 'INE' || lpad(n_nationkey::varchar, 4, '0') as isin,
       case pri when '1' then 1 when '2' then 2 when '3' then 5 else 10 end::double as face_value,
       case when c_mktsegment <> 'FURNITURE' then industry end as industry, o_totalprice > 450000 as in_nifty500
from (select *, rank() over (partition by symbol, date_trunc('quarter', day) order by o_totalprice desc, o_orderkey) as r
      from ord)
where r = 1 and o_orderpriority <> '5-LOW'"""

# A full grid of symbols and snapshots shows appearance, change and absence as plain cell differences.
STEPS["cells"] = """
select s.symbol, q.snapshot_date, m.company_name, m.series, m.listing_date, m.isin, m.face_value,
       coalesce(m.industry, 'Unclassified') as industry, m.in_nifty500,
       case when m.symbol is not null then concat_ws('|', m.company_name, m.isin, m.face_value,
            coalesce(m.industry, 'Unclassified'), m.series, m.in_nifty500) end as look
from (select distinct symbol from master) s cross join (select distinct snapshot_date from master) q
left join master m on m.symbol = s.symbol and m.snapshot_date = q.snapshot_date"""
STEPS["turns"] = """
select * from (select *, look is distinct from lag(look) over (partition by symbol order by snapshot_date) as turned
               from cells) where turned"""
STEPS["dim"] = f"""
select md5(symbol || '|' || opened::varchar) as stock_sk, symbol, company_name, isin, series, face_value,
       listing_date, industry, in_nifty500,
       case when version_no = 1 then date '1900-01-01' else opened end as valid_from,
       coalesce(closed, date '9999-12-31') as valid_to, closed is null as is_current, version_no::integer as version_no
from (select *, row_number() over (partition by symbol order by opened) as version_no
      from (select *, snapshot_date as opened,
                   lead(snapshot_date) over (partition by symbol order by snapshot_date) as closed from turns)
      where look is not null)
union all
select 'unknown', 'UNKNOWN', '{fixed.UNKNOWN_NAME}', null, null, null, null, 'Unclassified', false,
       date '1900-01-01', date '9999-12-31', true, 1"""

STEPS["act_text"] = """
select symbol, o_orderkey, o_totalprice, day as ex_date,
       case pri when '1' then 'Face Value Split (Sub-Division) - From Rs ' || 2 * (o_orderkey % 3 + 1)
                              || '/- Per Share To Re ' || (o_custkey % 5 + 1) || '/- Per Share'
                when '2' then 'Bonus ' || (o_orderkey % 3 + 1) || ':' || (o_custkey % 5 + 1)
                when '3' then 'Interim Dividend - Rs ' || (o_custkey % 5 + 1) || ' Per Share'
                when '4' then 'Rights issue from Rs ' || (o_orderkey % 3 + 1) || ' to Rs ' || (o_custkey % 5 + 1)
                else 'Annual General Meeting' end as subject, o_orderkey % 3 + 1 as a, o_custkey % 5 + 1 as b, pri
from ord"""
# The factor straight from the numbers the text was made of.
STEPS["act_rated"] = """
select *, case when pri = '1' and 2 * a <> b then 'SPLIT' when pri = '2' then 'BONUS' end as action_type,
       case when pri = '1' and 2 * a <> b then 2 * a / b when pri = '2' then (a + b) / b end as factor
from act_text"""
STEPS["actions"] = """
select symbol, ex_date, action_type, factor, subject
from (select *, row_number() over (partition by symbol, year(ex_date) order by o_totalprice desc, o_orderkey) as r
      from act_rated where action_type is not null) where r = 1"""
STEPS["adjusted"] = f"""
select b.*, f, {', '.join(rnd(f'b.{c} / f', 4) + f' as adj_{c}' for c in
                          ('prev_close', 'open', 'high', 'low', 'last', 'close', 'vwap'))},
       cast(trunc(b.volume * f) as bigint) as adj_volume
from ser_bar b join (
  select d.symbol, d.trade_date, {rnd('coalesce(product(a.factor), 1)', 6)} as f
  from (select distinct symbol, trade_date from ser_bar) d
  left join actions a on a.symbol = d.symbol and a.ex_date > d.trade_date group by 1, 2) x using (symbol, trade_date)"""

STEPS["sch"] = """
select cast(regexp_extract(p.p_brand, '\\d+') as bigint) as scheme_code, cast(l.l_shipdate as date) as nav_date,
       cast(round(1e6 + 1e5 * ln(l.l_extendedprice / l.l_quantity)) as bigint) as tick, l.l_linestatus
from lineitem l join part p on p.p_partkey = l.l_partkey"""
STEPS["nav_src"] = """
select *, 'Scheme ' || scheme_code || ' - ' || case scheme_code % 2 when 0 then 'Direct Plan' else 'Regular Plan' end
       || ' - ' || case scheme_code % 3 when 0 then 'Growth' when 1 then 'IDCW' else 'Bonus' end as scheme_name,
       'House ' || scheme_code % 4 || ' Mutual Fund' as amc,
       case scheme_code % 5 when 0 then 'Equity Scheme - Large Cap Fund' when 1 then 'Debt Scheme - Liquid Fund'
            when 2 then 'Hybrid Scheme - Arbitrage Fund' when 3 then 'Solution Oriented Scheme - Children'
            else 'Index Funds' end as category,
       case when daily then 'INF' || lpad(scheme_code::varchar, 5, '0') end as isin_growth
from (select scheme_code, nav_date, bool_or(l_linestatus = 'O') as daily,
             coalesce(max(tick) filter (where l_linestatus = 'O'), min(tick)) / 10000 as nav from sch group by 1, 2)"""
STEPS["nav"] = f"""
select cast(strftime(nav_date, '%Y%m%d') as integer) as date_key, nav_date, scheme_code, nav,
       {rnd('(nav / lag(nav) over (partition by scheme_code order by nav_date) - 1) * 100', 6)} as return_pct
from nav_src"""
STEPS["fund"] = """
select scheme_code, scheme_name, amc, category,
       case when starts_with(category, 'Equity') then 'Equity' when starts_with(category, 'Debt') then 'Debt'
            when starts_with(category, 'Hybrid') then 'Hybrid'
            when starts_with(category, 'Solution') then 'Solution Oriented' else 'Other' end as asset_class,
       coalesce(trim(string_split(category, ' - ')[2]), '') as sub_category,
       case scheme_code % 2 when 0 then 'Direct' else 'Regular' end as plan,
       case scheme_code % 3 when 0 then 'Growth' when 1 then 'IDCW' else 'Other' end as option_type,
       isin_growth, nav_date as latest_nav_date, nav as latest_nav
from nav_src where (scheme_code, nav_date) in (select (scheme_code, max(nav_date)) from nav_src group by scheme_code)"""

STEPS["idx"] = f"""
select index_name, trade_date, min(tick) / 10000 as open, max(tick) / 10000 as high, min(tick) / 10000 as low,
       max(tick) / 10000 as close, {rnd('max(tick) / 10000 - min(tick) / 10000', 4)} as points_change,
       {rnd('(max(tick) / 10000) / (min(tick) / 10000) * 100 - 100', 4)} as pct_change,
       cast(sum(qty) as bigint) as volume, sum(cents) / 100000 as turnover_cr, count(*)::double as pe,
       null::double as pb, 0.5::double as div_yield
from (select case p_type when 'ECONOMY' then 'Nifty Midcap ' when 'SMALL' then 'Nifty Smallcap '
                  when 'MEDIUM' then 'Nifty Bank ' when 'LARGE' then 'India VIX ' when 'PROMO' then 'Nifty G-Sec '
                  else 'Nifty Alpha ' end || p_size as index_name, cast(l_shipdate as date) as trade_date,
             cast(round(1e6 + 1e5 * ln(l_extendedprice / l_quantity)) as bigint) as tick,
             cast(l_quantity as bigint) as qty, cast(round(l_extendedprice * 100) as bigint) as cents
      from lineitem join part on p_partkey = l_partkey)
group by 1, 2"""
STEPS["idx_dim"] = """
select md5(index_name) as index_sk, index_name, family as index_family
from (select distinct index_name,
             case split_part(index_name, ' ', 2) when 'Midcap' then 'Broad Market' when 'Smallcap' then 'Broad Market'
                  when 'Bank' then 'Sectoral' when 'VIX' then 'Volatility' when 'G-Sec' then 'Fixed Income'
                  else 'Strategy / Thematic' end as family from idx)"""

STEPS["hol"] = """
select day as holiday, 'Closed for order ' || o_orderkey as description
from (select *, row_number() over (partition by day order by o_totalprice desc, o_orderkey) as r
      from (select *, cast(o_orderdate as date) as day from orders)) where r = 1 and o_orderpriority = '1-URGENT'"""

STEPS["runs"] = """
select *, user_id || '-' || strftime(ts, '%Y%m%d') as run_id,
       case event_type when 'click' then 'extract' when 'view' then 'silver' when 'purchase' then 'dbt'
            when 'signup' then 'quality' else 'alerts' end as step,
       case when value > 60 then 'FAILED' when value < 1 then 'SKIPPED' else 'SUCCESS' end as status
from events"""

# ---------- facts ----------

STEPS["fact"] = f"""
select cast(strftime(b.trade_date, '%Y%m%d') as integer) as date_key, b.trade_date, b.symbol,
       coalesce(d.stock_sk, 'unknown') as stock_sk, b.series, b.open, b.high, b.low, b.close, b.prev_close, b.vwap,
       b.volume, b.raw_close, b.raw_volume, b.adj_factor, b.turnover_lacs, b.num_trades, b.deliv_qty, b.deliv_pct,
       {rnd('(b.close / prev_close - 1) * 100', 4)} as return_pct, {rnd('(b.open / prev_close - 1) * 100', 4)} as gap_pct,
       {rnd('(b.high - b.low) / prev_close * 100', 4)} as range_pct,
       {rnd('(b.close / back5 - 1) * 100', 4)} as return_5d_pct, b.avg_volume_20d,
       {rnd('b.volume / b.avg_volume_20d', 3)} as volume_ratio_20d, b.avg_deliv_pct_20d,
       {rnd('b.vola', 4)} as volatility_20d_pct, b.history_days
from (select *, avg(volume) over prior20 as avg_volume_20d, avg(deliv_pct) over prior20 as avg_deliv_pct_20d,
             stddev_samp(close / prev_close - 1) over prior20 * 100 as vola, lag(close, 5) over o as back5,
             row_number() over o as history_days
      from bars_all
      window o as (partition by symbol order by trade_date),
             prior20 as (partition by symbol order by trade_date rows between 20 preceding and 1 preceding)) b
left join dim d on d.symbol = b.symbol and b.trade_date >= d.valid_from and b.trade_date < d.valid_to"""


def surveillance(s: str, p: SurveillanceParams) -> None:
    """Steps sig_<s>, alert_<s> and what hangs on them, for one set of parameters."""
    bands = " or ".join(f"abs(abs(return_pct) - {b}) < {p.circuit_tolerance}" for b in p.circuit_bands)
    STEPS[f"meas_{s}"] = f"""
select *, max(case when pumping then 1 else 0 end) over (partition by symbol order by trade_date
              rows between {p.dump_lookback_days} preceding and 1 preceding) = 1 as pumped
from (select *, return_5d_pct >= {p.pump_return_5d_pct} and vol5 >= {p.pump_volume_x}
                and dv5 < dvb * {p.pump_low_delivery_ratio} as pumping,
             n - coalesce(max(case when not limit_close then n end) over (partition by symbol order by trade_date
                 rows between unbounded preceding and current row), 0) as circuit_streak
      from (select f.*, d.industry, d.company_name, row_number() over o as n,
                   (ln(greatest(volume, 1)) - avg(ln(greatest(volume, 1))) over p20)
                     / nullif(stddev_samp(ln(greatest(volume, 1))) over p20, 0) as zvol,
                   avg(volume) over c5 / avg(volume) over e20 as vol5, avg(deliv_pct) over c5 as dv5,
                   avg(deliv_pct) over e20 as dvb, stddev_samp(deliv_pct) over e20 as dvs,
                   avg(turnover_lacs) over e20 / 100 as cr, close / lag(close, 3) over o - 1 as r3,
                   coalesce(((close = high and return_pct > 0) or (close = low and return_pct < 0)) and ({bands}), false)
                     as limit_close
            from fact f join dim d using (stock_sk)
            where not (f.symbol like '%BEES') and not contains(f.symbol, 'ETF')
            window o as (partition by f.symbol order by trade_date),
                   p20 as (partition by f.symbol order by trade_date rows between 20 preceding and 1 preceding),
                   c5 as (partition by f.symbol order by trade_date rows between 4 preceding and current row),
                   e20 as (partition by f.symbol order by trade_date rows between 24 preceding and 5 preceding)))"""
    STEPS[f"sect_{s}"] = f"""
select trade_date, industry, median(return_pct) as med from meas_{s} where industry <> 'Unclassified' group by 1, 2"""
    STEPS[f"mark_{s}"] = f"select trade_date, median(return_pct) as med from meas_{s} group by 1"
    zvol, zpx = f"m.zvol >= {p.volume_spike_z}", f"zpx >= {p.price_shock_z}"
    money = f"turnover_lacs >= {p.min_spike_turnover_cr * 100}"
    if p.baseline == "per_stock":
        spike = f"{zvol} and volume_ratio_20d >= {p.volume_spike_min_x} and {money}"
        shock = f"{zpx} and abs(return_pct - peer) >= {p.price_shock_min_pct}"
    else:
        spike = f"volume_ratio_20d >= {p.volume_spike_x} and {money}"
        shock = f"abs(return_pct) >= {p.price_shock_pct} and abs(peer) < {p.sector_calm_pct}"
        if p.baseline == "hybrid":
            spike, shock = f"{spike} and {zvol}", f"{shock} and {zpx}"
    old = f"history_days >= {p.min_history_days}"
    STEPS[f"sig_{s}"] = f"""
select trade_date, date_key, symbol, stock_sk, company_name, industry, series, close, return_pct, gap_pct, return_5d_pct,
       {rnd('r3 * 100', 2)} as return_3d_pct, volume, volume_ratio_20d, {rnd('vol5', 2)} as volume_ratio_5d,
       {rnd('zvol', 2)} as volume_z, {rnd('zpx', 2)} as price_z, deliv_pct, {rnd('dv5', 2)} as deliv_pct_5d,
       {rnd('dvb', 2)} as deliv_pct_20d_avg, {rnd('peer', 2)} as peer_return_pct, {rnd('cr', 2)} as avg_turnover_cr_20d,
       circuit_streak, history_days,
       {old} and coalesce({spike}, false) as r_volume_spike, {old} and coalesce({shock}, false) as r_price_shock,
       {old} and coalesce(pumping, false) as r_pump,
       {old} and pumped and (return_pct <= {-p.dump_return_pct} or r3 <= {-p.dump_return_3d_pct / 100}) as r_dump_after_pump,
       {old} and coalesce((deliv_pct >= dvb + {p.delivery_z} * dvs and volume_ratio_20d >= {p.delivery_high_min_x})
          or (deliv_pct <= dvb * {p.delivery_low_ratio} and volume_ratio_20d >= {p.delivery_low_min_x}), false)
          as r_delivery_anomaly,
       {old} and circuit_streak >= {p.circuit_streak_days} as r_circuit_streak,
       {old} and coalesce(abs(gap_pct) >= {p.gap_pct} and sign(close - open) = sign(gap_pct), false) as r_gap_move
from (select m.*, coalesce(sc.med, mk.med) as peer,
             abs(return_pct - coalesce(sc.med, mk.med)) / greatest(volatility_20d_pct, {p.volatility_floor_pct}::double) as zpx
      from meas_{s} m left join sect_{s} sc using (trade_date, industry)
      left join mark_{s} mk on mk.trade_date = m.trade_date) m"""
    # one row per rule that fired: its points and its words
    vr, up = txt("volume_ratio_20d", 1), "+"
    move, peer = txt("return_pct", 1, up), txt("peer_return_pct", 1, up)
    if p.baseline == "per_stock":
        volume_pts, shock_pts = "8 * volume_z", "6 * price_z"
        volume_text = said(fixed.REASON_VOLUME_Z, vr, txt("volume_z", 1))
        shock_text = said(fixed.REASON_SHOCK_Z, move, peer, txt("price_z", 1))
    else:
        volume_pts, shock_pts = "10 * log2(volume_ratio_20d)", "2 * abs(return_pct - peer_return_pct)"
        volume_text, shock_text = said(fixed.REASON_VOLUME, vr), said(fixed.REASON_SHOCK, move, peer)
    usual = txt("deliv_pct_20d_avg", 0)
    rules = [
        (f"least(40, {rnd(volume_pts, 0)})", volume_text),
        (f"least(30, {rnd(shock_pts, 0)})", shock_text),
        ("25", said(fixed.REASON_PUMP, txt("return_5d_pct", 1), txt("volume_ratio_5d", 1), txt("deliv_pct_5d", 0), usual)),
        ("30", said(fixed.REASON_DUMP, txt("return_pct", 1), txt("return_3d_pct", 1))),
        ("15", said(fixed.REASON_DELIVERY, txt("deliv_pct", 0), usual, vr)),
        ("least(30, 10 * circuit_streak)", said(fixed.REASON_CIRCUIT, "circuit_streak")),
        (f"least(20, {rnd('2 * abs(gap_pct)', 0)})", said(fixed.REASON_GAP, txt("gap_pct", 1, up))),
    ]
    STEPS[f"fired_{s}"] = "\nunion all\n".join(
        f"select trade_date, symbol, {i} as no, '{name}' as rule, ({pts})::double as pts, {words} as words "
        f"from sig_{s} where {flag}" for i, ((flag, _, name), (pts, words)) in enumerate(zip(fixed.RULES, rules), 1))
    STEPS[f"tally_{s}"] = f"""
select trade_date, symbol, max(pts) + (sum(pts) - max(pts)) / 2 as base, string_agg(rule, ', ' order by no) as names,
       string_agg(words, '; ' order by no) as words,
       {', '.join(f"coalesce(max(pts) filter (where no = {i}), 0) as {c}" for i, (_, c, _) in enumerate(fixed.RULES, 1))}
from fired_{s} group by 1, 2"""
    STEPS[f"hot_{s}"] = f"""
select *, least(100, round(base + pts_illiquid))::double as risk_score
from (select *, case when avg_turnover_cr_20d < {p.illiquid_turnover_cr} then 10 else 0 end::double as pts_illiquid
      from tally_{s} join sig_{s} using (trade_date, symbol))
where least(100, round(base + pts_illiquid)) >= {p.min_alert_score}"""
    STEPS[f"alert_{s}"] = f"""
select md5(trade_date::varchar || '|' || symbol) as alert_id, date_key, trade_date, symbol, stock_sk, company_name,
       industry, risk_score, case when risk_score >= {p.high_score} then 'HIGH' when risk_score >= {p.medium_score}
       then 'MEDIUM' else 'LOW' end as risk_band, names as rules_triggered,
       concat_ws('; ', words, case when pts_illiquid > 0 then {said(fixed.REASON_ILLIQUID, txt('avg_turnover_cr_20d', 2))}
       end) as reason, close, return_pct, gap_pct, return_5d_pct, volume, volume_ratio_20d, deliv_pct, deliv_pct_20d_avg,
       peer_return_pct, avg_turnover_cr_20d, circuit_streak, volume_z, price_z,
       {', '.join(c for _, c, _ in fixed.RULES)}, pts_illiquid, news_types,
       coalesce(material_news_count, 0) as material_news_count, coalesce(exchange_query, false) as exchange_query
from hot_{s} left join (
  select h.trade_date, h.symbol, bool_or(news_type = 'EXCHANGE_QUERY') as exchange_query,
         string_agg(distinct news_type, ', ' order by news_type)
           filter (where news_type not in ('ROUTINE', 'EXCHANGE_QUERY')) as news_types,
         count(*) filter (where news_type not in ('ROUTINE', 'EXCHANGE_QUERY')) as material_news_count
  from hot_{s} h join filing a on a.symbol = h.symbol
       and h.trade_date - a.announced_date between 0 and {p.news_lookback_days}
  group by 1, 2) using (trade_date, symbol)"""
    STEPS[f"span_{s}"] = f"select min(trade_date) as lo, max(trade_date) as hi from alert_{s}"
    STEPS[f"out_{s}"] = f"""
select u.symbol, coalesce(case b when 3 then 'HIGH' when 2 then 'MEDIUM' when 1 then 'LOW' end, 'NOT_ALERTED')
         as best_band, a.top as max_risk_score, a.f as first_alert_date, a.fh as first_high_date,
       coalesce(a.n, 0) as alert_days, q.f as first_query_date, coalesce(q.n, 0) as exchange_queries,
       q.n is not null as exchange_queried, (q.f - a.f)::integer as query_lead_days,
       coalesce(st, false) as on_stasm, coalesce(lt, false) as on_ltasm, coalesce(gs, false) as on_gsm,
       coalesce(st or lt or gs, false) as on_any_list, l.f as first_listed_date, coalesce(known, false) as listing_date_known
from (select distinct symbol from sig_{s} cross join span_{s} where trade_date >= lo and trade_date <= hi) u
left join (select symbol, max(risk_score) as top, min(trade_date) as f, count(*) as n,
                  max(case risk_band when 'HIGH' then 3 when 'MEDIUM' then 2 else 1 end) as b,
                  min(case when risk_band = 'HIGH' then trade_date end) as fh from alert_{s} group by 1) a
  on a.symbol = u.symbol
left join (select symbol, min(announced_date) as f, count(*) as n from filing cross join span_{s}
           where news_type = 'EXCHANGE_QUERY' and announced_date >= lo - 5 and announced_date <= hi + 1 group by 1) q
  on q.symbol = u.symbol
left join (select symbol, min(snapshot_date) as f, min(snapshot_date) > (select min(snapshot_date) from lists) as known,
                  {', '.join(f"bool_or(list_type = '{k}' and snapshot_date = (select max(snapshot_date) from lists)) as {c}"
                             for k, c in (('STASM', 'st'), ('LTASM', 'lt'), ('GSM', 'gs')))}
           from lists group by 1) l on l.symbol = u.symbol"""


surveillance("d", DEFAULT)
surveillance("h", SurveillanceParams(baseline="hybrid"))
surveillance("p", SurveillanceParams(baseline="per_stock"))
surveillance("r", RELAXED)
surveillance("rh", SurveillanceParams(**{**RELAXED.__dict__, "baseline": "hybrid"}))
surveillance("rp", SurveillanceParams(**{**RELAXED.__dict__, "baseline": "per_stock"}))

# ---------- finals: prices, dimensions, facts ----------

FINAL["bars"] = "select * from bars_all"
FINAL["stock_metrics"] = f"select * replace ({rnd('avg_deliv_pct_20d', 6)} as avg_deliv_pct_20d) from fact"
FINAL["sector_performance"] = f"""
select date_key, trade_date, industry, count(*) as stocks, {rnd('avg(return_pct)', 3)} as avg_return_pct,
       {rnd('median(return_pct)', 3)} as median_return_pct,
       {rnd('sum(return_pct * turnover_lacs) / sum(turnover_lacs)', 3)} as weighted_return_pct,
       count(case when return_pct > 0 then 1 end) as advancers, count(case when return_pct < 0 then 1 end) as decliners,
       {rnd('sum(turnover_lacs) / 100', 2)} as turnover_cr, {rnd('avg(deliv_pct)', 2)} as avg_deliv_pct
from fact join (select stock_sk, industry from dim) using (stock_sk) where return_pct is not null group by 1, 2, 3"""
FINAL["split_adjust"] = """
select trade_date, symbol, series, f as adj_factor, adj_open, adj_high, adj_low, adj_close, adj_prev_close, adj_vwap,
       adj_volume from adjusted"""
FINAL["staged_prices"] = """
select trade_date, symbol, series, adj_open as open, adj_high as high, adj_low as low, adj_close as close,
       adj_prev_close as prev_close, adj_vwap as vwap, adj_volume as volume, close as raw_close, volume as raw_volume,
       f as adj_factor, turnover_lacs, num_trades, deliv_qty, deliv_pct
from adjusted a where series = 'EQ' or (series = 'BE' and not exists (
  select 1 from adjusted e where e.series = 'EQ' and e.symbol = a.symbol and e.trade_date = a.trade_date))"""
FINAL["corporate_action_factor"] = f"""
select o_orderkey, symbol, ex_date, subject, action_type, {rnd('factor', 6)} as factor from act_rated"""
FINAL["corporate_actions"] = f"select symbol, ex_date, action_type, {rnd('factor', 6)} as factor, subject from actions"
FINAL["scd2_dim_stock"] = "select * from dim"
FINAL["latest_stock_master"] = """
select symbol, company_name, series, listing_date, isin, face_value, coalesce(industry, 'Unclassified') as industry,
       in_nifty500, snapshot_date from master where snapshot_date = (select max(snapshot_date) from master)"""
FINAL["scd2_fact_join"] = """
select f.trade_date, f.symbol, f.close, f.stock_sk, d.company_name, d.industry, d.version_no
from fact f left join dim d on d.stock_sk = f.stock_sk and d.stock_sk <> 'unknown'"""
FINAL["dim_date"] = """
select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as date, year(d)::integer as year,
       quarter(d)::integer as quarter, month(d)::integer as month, monthname(d)[1:3] as month_name, strftime(d, '%Y-%m') as year_month, week(d)::integer as iso_week,
       isodow(d)::integer as day_of_week, dayname(d)[1:3] as day_name, isodow(d) > 5 as is_weekend,
       'FY' || strftime(d + interval 9 month, '%y') as fiscal_year, quarter(d - interval 3 month)::integer as fiscal_quarter,
       d in (select trade_date from bars_all) as is_trading_day,
       d not in (select trade_date from bars_all) and isodow(d) <= 5 and d between lo and hi as is_nse_holiday,
       d between lo and hi as in_loaded_range
from (select min(trade_date) as lo, max(trade_date) as hi from bars_all),
     (select unnest(generate_series(date '1994-01-01', date '2002-03-31', interval 1 day))::date as d)"""
FINAL["dim_fund"] = "select * from fund"
FINAL["dim_index"] = "select * from idx_dim"
FINAL["fact_index_daily"] = """
select cast(strftime(trade_date, '%Y%m%d') as integer) as date_key, trade_date, md5(index_name) as index_sk,
       * exclude (trade_date) from idx"""
FINAL["staged_nav"] = """
select scheme_code, nav_date, nav, scheme_name, amc, category, isin_growth,
       case when daily then 0 else 1 end as src_priority from nav_src"""
FINAL["fact_fund_nav"] = "select * from nav"
FINAL["news_classifier"] = "select * from filing"

# ---------- finals: signals and alerts ----------

FINAL["volume_zscore"] = "select trade_date, symbol, volume, volume_ratio_20d, volume_z from sig_d"
FINAL["peer_move"] = "select trade_date, symbol, industry, return_pct, peer_return_pct, price_z from sig_d"
FINAL["signals_default"] = "select * from sig_d"
FINAL["signals_relaxed"] = "select * from sig_r"
FINAL["facts_by_day"], FINAL["signals_by_day"] = FINAL["stock_metrics"], FINAL["signals_relaxed"]
for name, flag, columns in (
        ("rule_volume_spike", "r_volume_spike", "volume, volume_ratio_20d"),
        ("rule_price_shock", "r_price_shock", "return_pct, peer_return_pct"),
        ("rule_pump", "r_pump", "return_5d_pct, volume_ratio_5d, deliv_pct_5d, deliv_pct_20d_avg"),
        ("rule_dump_after_pump", "r_dump_after_pump", "return_pct, return_3d_pct"),
        ("rule_delivery", "r_delivery_anomaly", "deliv_pct, deliv_pct_20d_avg, volume_ratio_20d"),
        ("rule_circuit_streak", "r_circuit_streak", "close, return_pct, circuit_streak"),
        ("rule_gap", "r_gap_move", "gap_pct, return_pct")):
    FINAL[name] = f"select trade_date, symbol, {columns} from sig_r where {flag}"
FINAL["alerts_flat"] = "select * from alert_d"
FINAL["alerts_hybrid"] = "select * from alert_h"
FINAL["alerts_per_stock"] = "select * from alert_p"
FINAL["alert_reasons"] = "select alert_id, trade_date, symbol, risk_score, risk_band, rules_triggered, reason from alert_r"
FINAL["alert_news"] = """
select alert_id, trade_date, symbol, news_types, material_news_count, exchange_query from alert_r"""
FINAL["score_breakdown"] = """
select alert_id, trade_date, symbol, rule, pts as points from alert_r join fired_r using (trade_date, symbol) where pts > 0
union all select alert_id, trade_date, symbol, 'ILLIQUID', pts_illiquid from alert_r where pts_illiquid > 0"""

# ---------- finals: validation ----------

FINAL["alert_outcomes"] = "select * from out_r"
STEPS["seg"] = """
select 'ALL_STOCKS' as segment, 6 as sort_order, * from out_r
union all select 'ANY_ALERT', 4, * from out_r where alert_days > 0
union all select best_band, case best_band when 'HIGH' then 1 when 'MEDIUM' then 2 when 'LOW' then 3 else 5 end, *
from out_r"""


def share(c: str) -> str:
    return f"{rnd(f'100 * count_if({c}) / count(*)', 1)}"


def lift(c: str) -> str:
    return rnd(f"(count_if({c}) / count(*)) / nullif((select count_if({c}) / count(*) from out_r), 0)", 1)


STEPS["valid"] = f"""
select segment, sort_order, count(*) as stocks, count_if(exchange_queried)::bigint as queried,
       {share('exchange_queried')} as queried_pct, {lift('exchange_queried')} as queried_lift,
       count_if(on_stasm)::bigint as on_stasm, {share('on_stasm')} as stasm_pct, {lift('on_stasm')} as stasm_lift,
       count_if(on_any_list)::bigint as on_any_list, {share('on_any_list')} as any_list_pct,
       {lift('on_any_list')} as any_list_lift, count_if(query_lead_days > 0)::bigint as flagged_before_query,
       count_if(query_lead_days = 0)::bigint as flagged_same_day,
       count_if(query_lead_days < 0)::bigint as flagged_after_query,
       median(query_lead_days) as median_query_lead_days
from seg group by 1, 2"""
FINAL["surveillance_validation"] = "select * from valid"
FINAL["validation_headline"] = f"""
select h.stasm_pct as high_stasm_pct, h.queried_pct as high_queried_pct, y.queried as caught, a.queried as queried,
       y.flagged_before_query + y.flagged_same_day as on_or_before,
       y.flagged_before_query + y.flagged_same_day + y.flagged_after_query as flagged,
       {rnd('100 * y.queried / a.queried', 1)} as recall_pct,
       {rnd('100 * (y.flagged_before_query + y.flagged_same_day) / '
            '(y.flagged_before_query + y.flagged_same_day + y.flagged_after_query)', 1)} as on_or_before_pct
from (select * from valid where segment = 'ALL_STOCKS') a
left join (select * from valid where segment = 'ANY_ALERT') y on true
left join (select * from valid where segment = 'HIGH') h on true"""
FINAL["lead_histogram"] = """
select bucket::integer as bucket, count(symbol) as n,
       coalesce(array_to_string(list_sort(list(symbol) filter (where symbol is not null))[1:8], ', ')
                || case when count(symbol) > 8 then ' and more' else '' end, '') as names
from range(-3, 8) b(bucket) left join (
  select symbol, case when query_lead_days < -3 then -3 when query_lead_days > 7 then 7 else query_lead_days end as k
  from out_r where exchange_queried and alert_days > 0) on k = bucket
group by 1"""
FINAL["acted_on_high"] = """
select symbol, max_risk_score, first_alert_date, first_query_date, query_lead_days, on_stasm
from out_r where exchange_queried and best_band = 'HIGH'"""


def ablation_row(baseline: str, s: str) -> str:
    return f"""
select '{baseline}' as baseline, {rnd(f'''(select count(*) from alert_{s}) / (select count(distinct trade_date)
         from sig_{s} cross join span_{s} where trade_date >= lo and trade_date <= hi)''', 1)} as alerts_per_day,
       count_if(alert_days > 0)::bigint as stocks_alerted,
       {rnd('100 * count_if(alert_days > 0 and exchange_queried) / nullif(count_if(exchange_queried), 0)', 1)}
         as recall_queried_pct,
       {rnd('100 * count_if(alert_days > 0 and on_stasm) / nullif(count_if(on_stasm), 0)', 1)} as recall_stasm_pct,
       {rnd('(count_if(alert_days > 0 and exchange_queried) / nullif(count_if(alert_days > 0), 0)) / nullif('
            'count_if(exchange_queried) / count(*), 0)', 1)} as any_alert_lift,
       (select {rnd('100 * avg(case when exchange_queried or on_stasm then 1 else 0 end)', 1)} from (
          select symbol, row_number() over (partition by trade_date order by risk_score desc, symbol) as r from alert_{s})
        join out_{s} using (symbol) where r <= 10) as top10_acted_pct,
       count_if(best_band = 'HIGH')::bigint as high_stocks,
       {rnd("100 * count_if(best_band = 'HIGH' and exchange_queried) / nullif(count_if(best_band = 'HIGH'), 0)", 1)}
         as high_queried_pct
from out_{s}"""


FINAL["baseline_ablation"] = " union all ".join(
    ablation_row(b, s) for b, s in (("flat", "r"), ("hybrid", "rh"), ("per_stock", "rp")))
STEPS["moves"] = """
select symbol, trade_date, entry, leave, (leave / entry - 1) * 100 as ret
from (select symbol, trade_date, lead(open) over o as entry, lead(close, 5) over o as leave
      from fact window o as (partition by symbol order by trade_date))
where entry > 0 and leave is not null"""
STEPS["ev"] = """
select a.trade_date, a.symbol, a.company_name, a.risk_band, a.risk_score, a.rules_triggered, a.news_types, m.ret, k.med
from alert_r a join moves m using (symbol, trade_date)
join (select trade_date, median(ret) as med from moves group by 1) k using (trade_date)"""
FINAL["event_study_5d"] = f"""
select trade_date, symbol, company_name, risk_band, risk_score, rules_triggered, news_types, {rnd('ret', 4)} as ret,
       {rnd('med', 4)} as market_ret from ev"""
FINAL["event_summary"] = f"""
select count(*) as alerts, count(distinct trade_date) as alert_days, {rnd('avg(ret)', 4)} as avg_ret,
       {rnd('avg(ret - med)', 4)} as edge, {rnd('100 * count_if(ret > 0) / count(*)', 2)} as pct_up from ev"""
FINAL["event_pnl"] = f"""
select d.trade_date, {rnd('sum(ev.ret) * 100', 2)} as you, {rnd('sum(ev.med) * 100', 2)} as market
from (select distinct trade_date from ev) d join ev on ev.trade_date <= d.trade_date group by 1"""
FINAL["outcome_stats"] = f"""
select risk_band, count(*) as n, {rnd('avg(m.ret)', 4)} as avg_ret,
       {rnd('100 * count_if(leave < entry) / count(*)', 2)} as pct_down
from alert_r join moves m using (symbol, trade_date) group by 1"""

# ---------- finals: funds ----------

STEPS["many"] = "select * from nav where scheme_code in (select scheme_code from nav group by 1 having count(*) >= 250)"


def fund_steps(s: str, table: str) -> None:
    STEPS[f"newest_{s}"] = f"""
select scheme_code, max(nav_date) as as_of, arg_max(nav, nav_date) as nav_now from {table} group by 1"""
    STEPS[f"dd_{s}"] = f"""
select scheme_code, min(nav / peak - 1) as low from (
  select n.scheme_code, n.nav, max(n.nav) over (partition by n.scheme_code order by n.nav_date) as peak
  from {table} n join newest_{s} using (scheme_code) where as_of - nav_date < 1095) group by 1"""
    STEPS[f"roll_{s}"] = f"""
select scheme_code, avg(g) as roll_avg, min(g) as roll_min, max(g) as roll_max, avg((g > 0)::integer) as roll_positive
from (select e.scheme_code, e.nav / arg_max(b.nav, b.nav_date) - 1 as g
      from {table} e join newest_{s} using (scheme_code)
      join {table} b on b.scheme_code = e.scheme_code and b.nav_date <= e.nav_date - 365
      where as_of - e.nav_date < 1095 group by e.scheme_code, e.nav_date, e.nav) group by 1"""


fund_steps("a", "nav")
fund_steps("m", "many")


def back(days: int, annual: bool) -> str:
    then = f"(select arg_max(b.nav, b.nav_date) from many b where b.scheme_code = l.scheme_code and b.nav_date <= as_of - {days})"
    if not annual:
        return f"nav_now / {then} - 1"
    on = f"(select max(b.nav_date) from many b where b.scheme_code = l.scheme_code and b.nav_date <= as_of - {days})"
    return f"pow(nav_now / {then}, 365.0::double / (as_of - {on})) - 1"


STEPS["gains"] = f"""
select scheme_code, {', '.join(f'{back(d, y)} as ret_{n}' for n, d, y in (
    ('1m', 30, False), ('3m', 91, False), ('6m', 182, False), ('1y', 365, False), ('3y', 1095, True),
    ('5y', 1826, True)))} from newest_m l"""
FINAL["fund_returns"] = "select scheme_code, " + ", ".join(
    f"{rnd(c, 6)} as {c}" for c in ("ret_1m", "ret_3m", "ret_6m", "ret_1y", "ret_3y", "ret_5y")) + " from gains"
FINAL["fund_drawdown"] = f"select scheme_code, {rnd('low', 6)} as max_drawdown_3y from dd_a"
FINAL["fund_rolling_1y"] = "select scheme_code, " + ", ".join(
    f"{rnd(c, 6)} as {c}" for c in ("roll_avg", "roll_min", "roll_max", "roll_positive")) + " from roll_a"
STEPS["risk"] = """
select scheme_code, stddev_samp(return_pct / 100) * sqrt(252) as vol from many join newest_m using (scheme_code)
where as_of - nav_date < 365 group by 1"""
FINAL["fund_performance"] = f"""
select l.scheme_code, scheme_name, amc, category, asset_class, plan, option_type, as_of as as_of_date,
       nav_now as latest_nav, {rnd('ret_1m * 100', 2)} as return_1m_pct, {rnd('ret_3m * 100', 2)} as return_3m_pct,
       {rnd('ret_6m * 100', 2)} as return_6m_pct, {rnd('ret_1y * 100', 2)} as return_1y_pct,
       {rnd('ret_3y * 100', 2)} as cagr_3y_pct, {rnd('ret_5y * 100', 2)} as cagr_5y_pct,
       {rnd('vol * 100', 2)} as volatility_1y_pct, {rnd('(ret_1y - 0.065) / vol', 2)} as sharpe_1y,
       {rnd('low * 100', 2)} as max_drawdown_3y_pct, {rnd('roll_avg * 100', 2)} as rolling_1y_avg_pct,
       {rnd('roll_min * 100', 2)} as rolling_1y_min_pct, {rnd('roll_max * 100', 2)} as rolling_1y_max_pct,
       {rnd('roll_positive * 100', 1)} as rolling_1y_positive_pct
from newest_m l left join gains using (scheme_code) left join risk using (scheme_code) left join dd_m using (scheme_code)
left join roll_m using (scheme_code) left join fund using (scheme_code)"""

# ---------- finals: portfolio ----------

STEPS["ptxn"] = """
select row_number() over (order by owner, txn_date, instrument_id, spelt, quantity nulls last, amount nulls last,
         price nulls last)
         as txn_id, * exclude (spelt)
from (select c_name as owner, day as txn_date,
             case when pri in ('1', '2') then case o_orderstatus when 'F' then 'SELL' else 'BUY' end
                  else case o_orderstatus when 'F' then 'REDEEM' when 'O' then 'SIP' else 'LUMPSUM' end end as txn_type,
             case when pri in ('1', '2') then case o_orderstatus when 'F' then ' sell ' else 'Buy' end
                  else case o_orderstatus when 'F' then 'redeem' when 'O' then 'sip ' else 'LUMPSUM' end end as spelt,
             case when pri in ('1', '2') then symbol else (o_orderkey % 25 + 1)::varchar end as instrument_id,
             case when pri in ('1', '2') then 'STOCK' else 'MUTUAL_FUND' end as asset_class,
             case when pri in ('1', '2') then (o_orderkey % 50 + 1)::double end as quantity,
             case when pri in ('1', '2') then (100 + o_custkey % 97)::double end as price,
             case when pri not in ('1', '2') then round(o_totalprice / 100) * 100 end as amount
      from ord)"""
STEPS["ftxn"] = """
select txn_id, owner, cast(strftime(txn_date, '%Y%m%d') as integer) as date_key, txn_date, txn_type, asset_class,
       instrument_id, unit_price, used as nav_date_used, way * coalesce(quantity, amount / unit_price) as quantity,
       coalesce(amount, quantity * unit_price) as gross_amount, -way * coalesce(amount, quantity * unit_price) as cash_flow
from (select t.*, u.used, case t.asset_class when 'STOCK' then t.price else u.nav end as unit_price,
             case when txn_type in ('SELL', 'REDEEM') then -1 else 1 end as way
      from ptxn t left join (
        select t.txn_id, max(n.nav_date) as used, arg_max(n.nav, n.nav_date) as nav
        from ptxn t join nav n on t.asset_class = 'MUTUAL_FUND' and n.scheme_code = try_cast(t.instrument_id as bigint)
             and t.txn_date - n.nav_date between 0 and 10
        group by 1) u using (txn_id))"""
STEPS["lastpx"] = """
select 'STOCK' as asset_class, symbol as instrument_id, max(trade_date) as price_date,
       arg_max(close, trade_date) as current_price from fact group by 2
union all select 'MUTUAL_FUND', scheme_code::varchar, max(nav_date), arg_max(nav, nav_date) from nav group by 2"""
STEPS["titles"] = """
select 'STOCK' as asset_class, symbol as instrument_id, company_name as title, industry as sector from dim where is_current
union all select 'MUTUAL_FUND', scheme_code::varchar, scheme_name, category from fund"""
STEPS["hold"] = f"""
select owner, asset_class, instrument_id, title as instrument_name, sector as sector_or_category, first_txn_date, txn_count,
       {rnd('held', 4)} as held_qty, {rnd('cost', 4)} as avg_cost, current_price, price_date,
       {rnd('cost * held', 2)} as invested_value, {rnd('current_price * held', 2)} as current_value,
       {rnd('current_price * held - cost * held', 2)} as unrealized_pnl,
       {rnd('(current_price / nullif(cost, 0) - 1) * 100', 2)} as unrealized_pnl_pct,
       {rnd('got - cost * gone', 2)} as realized_pnl,
       {rnd('current_price * held / nullif(sum(current_price * held) over (partition by owner), 0) * 100', 2)} as weight_pct
from (select *, paid / nullif(bought, 0) as cost from (
        select owner, asset_class, instrument_id, min(txn_date) as first_txn_date, count(*) as txn_count,
               sum(quantity) as held, sum(case when quantity > 0 then quantity end) as bought,
               sum(case when quantity > 0 then gross_amount end) as paid,
               coalesce(sum(case when quantity < 0 then -quantity end), 0) as gone,
               coalesce(sum(case when quantity < 0 then gross_amount end), 0) as got from ftxn group by 1, 2, 3))
left join lastpx using (asset_class, instrument_id) left join titles using (asset_class, instrument_id)"""
FINAL["portfolio_txn_staged"] = """
select txn_id, owner, txn_date, txn_type, instrument_id, asset_class, quantity, price, amount from ptxn"""
FINAL["portfolio_txn_asof"] = f"select * replace ({rnd('quantity', 6)} as quantity) from ftxn"
FINAL["portfolio_holdings"] = "select * from hold"
STEPS["due"] = """
select owner, max(price_date) as as_of from hold group by 1"""
STEPS["pieces"] = """
select owner, 'HOLDING' as level, asset_class, instrument_id, txn_date, cash_flow as amount, false as worth from ftxn
union all select owner, 'PORTFOLIO', null, null, txn_date, cash_flow, false from ftxn
union all select owner, 'HOLDING', asset_class, instrument_id, as_of, coalesce(current_value, 0), true
from hold join due using (owner)
union all select owner, 'PORTFOLIO', null, null, as_of, sum(coalesce(current_value, 0)), true
from hold join due using (owner) group by owner, as_of"""
STEPS["ledger"] = """
select owner, level, asset_class, instrument_id, min(txn_date) filter (where not worth) as started,
       coalesce(sum(case when not worth and amount < 0 then -amount end), 0) as spent,
       coalesce(sum(case when not worth and amount > 0 then amount end), 0) as got,
       sum(case when worth then amount end) as value,
       list({'t': txn_date, 'a': amount}) filter (where amount <> 0) as flows,
       bool_or(amount < 0) and bool_or(amount > 0) as mixed
from pieces group by 1, 2, 3, 4"""


def npv(rate: str) -> str:
    return f"list_sum(list_transform(flows, lambda f: f.a / pow(1 + {rate}, (f.t - started) / 365.0::double)))"


STEPS["halving"] = f"""
select owner, level, asset_class, instrument_id, started, flows, {npv('-0.9999::double')} as at_lo,
       -0.9999::double as lo, 100.0::double as hi, 0 as step
from ledger where mixed and {npv('-0.9999::double')} * {npv('100.0::double')} <= 0
union all
select owner, level, asset_class, instrument_id, started, flows, at_lo,
       case when at_lo * {npv('(lo + hi) / 2')} < 0 then lo else (lo + hi) / 2 end,
       case when at_lo * {npv('(lo + hi) / 2')} < 0 then (lo + hi) / 2 else hi end, step + 1
from halving where step < 40"""
FINAL["portfolio_xirr"] = f"""
select l.owner, l.level, l.asset_class, l.instrument_id, as_of as as_of_date, l.started as first_txn_date,
       (as_of - l.started)::integer as holding_days, {rnd('spent', 2)} as total_invested, {rnd('got', 2)} as total_received,
       {rnd('value', 2)} as current_value, {rnd('(value + got - spent) / nullif(spent, 0) * 100', 2)} as absolute_return_pct,
       {rnd('(lo + hi) / 2 * 100', 2)} as xirr_pct, as_of - l.started >= 365 as xirr_is_meaningful,
       case when as_of - l.started >= 365 then {rnd('(lo + hi) / 2 * 100', 2)}
            else {rnd('(value + got - spent) / nullif(spent, 0) * 100', 2)} end as display_return_pct,
       case when as_of - l.started >= 365 then 'XIRR' else 'ABSOLUTE' end as display_return_type
from ledger l join due using (owner) left join (select * from halving where step = 40) h
  on h.owner = l.owner and h.level = l.level and h.instrument_id is not distinct from l.instrument_id"""
FINAL["sip_tracker"] = f"""
select owner, scheme_code, scheme_name, n as installments, f as first_sip_date, z as last_sip_date, usual as typical_amount,
       total as total_invested, {rnd('units', 4)} as units_accumulated,
       ((year(e) - year(f)) * 12 + month(e) - month(f) + 1)::integer as months_since_start,
       {rnd('n / ((year(e) - year(f)) * 12 + month(e) - month(f) + 1) * 100', 1)} as regularity_pct,
       (z + interval 1 month)::date as next_expected_date, e - z > 45 as is_lapsed
from (select owner, instrument_id as scheme_code, count(*) as n, min(txn_date) as f, max(txn_date) as z,
             sum(gross_amount) as total, sum(quantity) as units
      from ftxn where txn_type = 'SIP' group by 1, 2)
join (select owner, instrument_id as scheme_code, gross_amount as usual,
             row_number() over (partition by owner, instrument_id order by count(*) desc, gross_amount) as r
      from ftxn where txn_type = 'SIP' group by 1, 2, 3) using (owner, scheme_code)
left join (select scheme_code::varchar as scheme_code, scheme_name from fund) using (scheme_code),
(select max(nav_date) as e from nav)
where r = 1"""
FINAL["symbols_held"] = "select distinct instrument_id as symbol from ftxn where asset_class = 'STOCK'"
STEPS["paper"] = f"""
select symbol, day as date, (o_orderkey % 50 + 1)::double as qty, (100 + o_custkey % 97)::double as price,
       (o_orderkey % 50 + 1)::double * (100 + o_custkey % 97) as amount, current_price as last_close, price_date as as_of,
       {rnd('(o_orderkey % 50 + 1) * current_price', 2)} as value,
       {rnd('(o_orderkey % 50 + 1) * current_price - (o_orderkey % 50 + 1) * (100 + o_custkey % 97)', 2)} as pnl,
       {rnd('((o_orderkey % 50 + 1) * current_price - (o_orderkey % 50 + 1) * (100 + o_custkey % 97)) '
            '/ ((o_orderkey % 50 + 1) * (100 + o_custkey % 97)) * 100', 2)} as pnl_pct
from ord left join lastpx on asset_class = 'STOCK' and instrument_id = symbol where o_orderstatus = 'O'"""
FINAL["paper_mark_to_market"] = "select * from paper"
FINAL["paper_totals"] = f"""
select count(*) as positions, {rnd('sum(amount)', 2)} as invested, {rnd('sum(value)', 2)} as worth,
       {rnd('sum(pnl)', 2)} as pnl, {rnd('100 * sum(pnl) / sum(amount)', 2)} as pnl_pct, max(as_of) as as_of from paper"""

# ---------- finals: triage and digest ----------

STEPS["ruled"] = f"""
select alert_id, date_key, trade_date, symbol, news_types,
       case when news_types is not null then 'UNCLEAR' else 'UNEXPLAINED' end as verdict,
       case when news_types is not null then {said(fixed.TRIAGE_NEWS, plain('news_types'))}
            when exchange_query then '{fixed.TRIAGE_QUERY}' else '{fixed.TRIAGE_NONE}' end as line from alert_r"""
FINAL["triage_rules"] = "select alert_id, trade_date, symbol, verdict, line, 'rules' as source from ruled"
# what each shape of stored reply must lead to
STEPS["triaged"] = """
select alert_id, trade_date, symbol, coalesce(v, verdict) as verdict, coalesce(t, line) as line,
       case when v is null then 'rules' else 'llm:m1' end as source
from (select *, case when news_types is not null then case date_key % 6 when 0 then 'EXPLAINED' when 2 then 'UNEXPLAINED'
                     when 4 then 'UNCLEAR' end end as v,
             case when news_types is not null then case date_key % 6 when 0 then 'Results of ' || symbol
                     when 2 then 'spaced out line' when 4 then ('Results of ' || repeat(symbol, 20))[1:140] end end as t
      from ruled)"""
FINAL["triage_replies"] = "select * from triaged"
FINAL["triage_cache"] = """
select t.alert_id, t.trade_date, t.symbol,
       case when r.date_key % 3 = 1 then 'EXPLAINED' when r.date_key % 3 = 0 and t.source = 'rules' then r.verdict
            else t.verdict end as verdict,
       case when r.date_key % 3 = 1 then r.line when r.date_key % 3 = 0 and t.source = 'rules' then r.line
            else t.line end as line,
       case when r.date_key % 3 = 1 then 'llm:m0' else t.source end as source
from triaged t join ruled r using (alert_id)"""
FINAL["triage_context"] = """
select alert_id, symbol, trade_date, count(*) as filings,
       string_agg('- ' || strftime(announced_at, '%d %b %H:%M') || ' [' || category || '] ' || left(summary, 400), chr(10)
                  order by r) as context
from (select a.alert_id, a.symbol, a.trade_date, f.announced_at, f.category, f.summary,
             row_number() over (partition by a.alert_id order by f.announced_at desc, f.seq_id) as r
      from alert_r a join filing f on f.symbol = a.symbol and f.news_type <> 'ROUTINE'
           and a.trade_date - f.announced_date between 0 and 3
      where a.news_types is not null) where r <= 8 group by 1, 2, 3"""
STEPS["read_day"] = """
select a.alert_id, a.trade_date, symbol, company_name, industry, risk_score, risk_band, rules_triggered, reason,
       news_types, material_news_count, exchange_query, case when risk_band = 'HIGH' then t.verdict end as verdict,
       case when risk_band = 'HIGH' then t.line end as triage,
       case when risk_band = 'HIGH' then t.source end as triage_source
from alert_r a left join (select alert_id, verdict, line, source from triaged) t using (alert_id)"""
FINAL["day_alerts"] = "select * from read_day"
STEPS["alert_no"] = "select trade_date, row_number() over (order by trade_date) as k from (select distinct trade_date from alert_r)"
STEPS["watch"] = """
select a.*, row_number() over (partition by a.trade_date order by risk_score desc, a.symbol) as position
from alert_r a join alert_no n using (trade_date)
where risk_band = 'MEDIUM' and not exists (
  select 1 from alert_r b join alert_no o using (trade_date) where b.symbol = a.symbol and o.k between n.k - 5 and n.k - 1)
qualify position <= 10"""
FINAL["digest_watchlist"] = """
select trade_date, position::integer as position, symbol, risk_score, rules_triggered, news_types, exchange_query from watch"""
STEPS["day_n"] = """
select trade_date, count(*) as n, count_if(risk_band = 'HIGH') as h, count_if(risk_band = 'MEDIUM') as m
from alert_r group by 1"""
STEPS["day_rows"] = "select trade_date, count(*) as stocks from fact group by 1"
STEPS["day_grade"] = """
select *, case when usual is null then 'WARN' when stocks / usual >= 0.9 then 'PASS' when stocks / usual >= 0.8 then 'WARN'
          else 'FAIL' end as status
from (select *, avg(stocks) over (order by trade_date rows between 20 preceding and 1 preceding) as usual from day_rows)"""
STEPS["high_no"] = """
select *, row_number() over (partition by trade_date order by risk_score desc, symbol) as k from read_day
where risk_band = 'HIGH'"""
_icons = " ".join(f"when '{v}' then '{i}'" for v, i in fixed.DIGEST_ICONS.items())
_bullet = "'• ' || symbol || ' (' || " + txt("risk_score", 0) + " || ') ' || "
FINAL["digest_lines"] = f"""
select trade_date, section::integer as section, position::integer as position, text from (
select trade_date, 1 as section, 0 as position, {said(fixed.DIGEST_TITLE, "strftime(trade_date, '%d %b %Y')")} as text from day_n
union all select trade_date, 2, 0, {said(fixed.DIGEST_COUNTS, 'n', 'h', 'm')} from day_n
union all select trade_date, 3, 0, case when h > 0 then {said(fixed.DIGEST_HIGH, 'h')} else '{fixed.DIGEST_NO_HIGH}' end
from day_n
union all select trade_date, 4, 3 * k, rtrim({_bullet} coalesce(company_name, '')) from high_no
union all select trade_date, 4, 3 * k + 1, '  ' || reason from high_no
union all select trade_date, 4, 3 * k + 2, '  ' || case verdict {_icons} else '{fixed.DIGEST_ICON_OTHER}' end || ' ' || triage
from high_no where triage is not null
union all select trade_date, 5, 0, {said(fixed.DIGEST_WATCH, 'count(*)')} from watch group by 1
union all select trade_date, 6, position, {_bullet} lower(rules_triggered)
       || coalesce(' · news: ' || {plain('news_types')}, '') || case when exchange_query then ' · NSE query' else '' end
from watch
union all select d.trade_date, 7, 0, {said(fixed.DIGEST_QUALITY, "case status when 'PASS' then 'all checks passed' else 'row_count_vs_20d_avg=' || status end")}
from day_n d join day_grade using (trade_date)
union all select trade_date, 8, 0, '{fixed.DIGEST_CLOSING}' from day_n)"""

# ---------- finals: screens ----------

STEPS["strong"] = """
select * from (
  select a.*, t.verdict, t.line, count(*) over (partition by a.symbol) as times,
         row_number() over (partition by a.symbol order by risk_score desc, a.trade_date desc) as r
  from alert_r a join triaged t using (alert_id)
  where risk_band <> 'LOW' and a.trade_date >= (
    select min(trade_date) from (select distinct trade_date from fact order by 1 desc limit 10))) where r = 1"""
STEPS["tail"] = """
select symbol, max(trade_date) as as_of, arg_max(close, trade_date) as close, arg_max(deliv_pct, trade_date) as dv,
       arg_max(avg_deliv_pct_20d, trade_date) as usual, avg(turnover_lacs) filter (where r <= 20) / 100 as cr,
       (arg_max(close, trade_date) / max(close) filter (where r = 21) - 1) * 100 as run
from (select *, row_number() over (partition by symbol order by trade_date desc) as r from fact) where r <= 25 group by 1"""
STEPS["asked"] = """
select symbol, count(*) as n, max(announced_date) as z, max(category) as category from filing
where news_type = 'EXCHANGE_QUERY' and announced_date >= (
  select min(trade_date) from (select distinct trade_date from fact order by 1 desc limit 22)) group by 1"""
_on = "l.symbol is not null"
_danger = "case s.risk_band when 'HIGH' then 'bad' else 'warn' end"
_two = "lower(array_to_string(string_split(s.reason, '; ')[1:2], '; '))"
STEPS["answers"] = f"""
select t.symbol, 1 as place, case when {_on} then 'bad' else 'ok' end as kind,
       case when {_on} then {said(fixed.CHECK_LISTED)} else {said(fixed.CHECK_NOT_LISTED)} end as title,
       case when {_on} then {said(fixed.DETAIL_LISTED, 'l.description', "strftime(l.snapshot_date, '%d %b')")}
            else {said(fixed.DETAIL_NOT_LISTED)} end as detail
from tail t left join (select * from lists where snapshot_date = (select max(snapshot_date) from lists)
                       qualify row_number() over (partition by symbol order by list_type) = 1) l using (symbol)
union all select t.symbol, 2, case when s.symbol is null then 'ok' else {_danger} end,
       case when s.symbol is null then {said(fixed.CHECK_CALM)} else
         {said(fixed.CHECK_FLAGGED, 's.times', "case when s.times > 1 then 's' else '' end", 'lower(s.risk_band)')} end,
       case when s.symbol is null then {said(fixed.DETAIL_CALM)} else
         {said(fixed.DETAIL_FLAGGED, "strftime(s.trade_date, '%d %b')", _two)} end
from tail t left join strong s using (symbol)
union all select symbol, 3, case verdict when 'EXPLAINED' then 'ok' when 'UNCLEAR' then 'warn' else 'bad' end,
       {said(fixed.CHECK_TRIAGE)}, line from strong
union all select t.symbol, 4, case when a.n is null then 'ok' else 'bad' end,
       case when a.n is null then {said(fixed.CHECK_NOT_QUERIED)} else {said(fixed.CHECK_QUERIED)} end,
       case when a.n is null then {said(fixed.DETAIL_NOT_QUERIED)}
            when a.n > 1 then {said(fixed.DETAIL_QUERIED_MORE, 'a.category', "strftime(a.z, '%d %b')", 'a.n - 1')}
            else {said(fixed.DETAIL_QUERIED_ONCE, 'a.category', "strftime(a.z, '%d %b')")} end
from tail t left join asked a using (symbol)
union all select symbol, 5, case when cr < 1 then 'warn' else 'ok' end,
       case when cr < 1 then {said(fixed.CHECK_THIN, txt('cr', 2))} else {said(fixed.CHECK_LIQUID, txt('cr', 0))} end,
       case when cr < 1 then {said(fixed.DETAIL_THIN)} else {said(fixed.DETAIL_LIQUID)} end from tail
union all select symbol, 6, 'warn', {said(fixed.CHECK_DELIVERY)},
       {said(fixed.DETAIL_DELIVERY, txt('dv', 0), txt('usual', 0))} from tail where dv < 0.6::double * usual
union all select symbol, 7, 'warn', {said(fixed.CHECK_RISE, txt('run', 0))}, {said(fixed.DETAIL_RISE)} from tail where run >= 30
union all select symbol, 7, 'warn', {said(fixed.CHECK_FALL, txt('-run', 0))}, {said(fixed.DETAIL_FALL)} from tail
where run <= -30"""
STEPS["checklist"] = """
select symbol, row_number() over (partition by symbol
         order by case kind when 'bad' then 0 when 'warn' then 1 else 2 end, place)::integer as position, kind, title, detail
from answers"""
FINAL["stock_check"] = "select * from checklist"
STEPS["levels"] = """
select symbol, case kind when 'bad' then 'red' when 'warn' then 'amber' else 'green' end as level,
       case kind when 'ok' then '—' else title end as main_reason, as_of, close
from checklist join tail using (symbol) where position = 1"""
FINAL["stock_levels"] = "select * from levels"
STEPS["scan"] = """
select owner, case level when 'red' then 0 when 'amber' then 1 else 2 end as rank, symbol, level, main_reason, close
from (select distinct owner, instrument_id as symbol from ftxn where asset_class = 'STOCK') join levels using (symbol)"""
FINAL["portfolio_scan"] = "select * from scan"
FINAL["portfolio_scan_counts"] = """
select owner, count(*) as checked, count_if(rank = 0)::bigint as high_caution, count_if(rank = 1)::bigint as some_signs,
       count_if(rank = 2)::bigint as no_signs from scan group by 1"""
STEPS["names"] = """
select f.symbol, max(d.company_name) as company_name, avg(f.turnover_lacs) as turnover
from fact f join dim d using (stock_sk) group by 1"""
FINAL["symbol_directory"] = f"select symbol, company_name, {rnd('turnover', 4)} as avg_turnover_lacs from names"
STEPS["typed"] = """
select distinct trim(token) as token, regexp_replace(upper(trim(token)), '\\.NS$', '') as t from (
  select case version_no % 4 when 0 then ' ' || lower(symbol) || '.ns '
              when 1 then split_part(company_name, ' ', 1) || ' ' || split_part(company_name, ' ', 2)
              when 2 then lower(split_part(company_name, ' ', 1) || ' ' || split_part(company_name, ' ', 2)[1:3])
              else split_part(company_name, ' ', 2) end as token from dim
  union all select c_name from customer)"""
FINAL["resolve_names"] = """
select token, coalesce(direct, found) as symbol,
       case when direct is not null then 'symbol' when k = 0 then 'exact name' when k = 1 then 'name starts with'
            when k = 2 then 'name contains' else 'not found' end as matched_by
from (select y.token, s.symbol as direct, n.symbol as found,
             case when n.symbol is null then null
                  when trim(regexp_replace(upper(n.company_name), '\\s+(LIMITED|LTD\\.?)$', '')) = t then 0
                  when starts_with(upper(n.company_name), t) then 1 else 2 end as k, n.turnover
      from typed y left join names s on s.symbol = y.t
      left join names n on s.symbol is null and contains(upper(n.company_name), y.t))
qualify row_number() over (partition by token order by k, turnover desc, found) = 1"""
FINAL["day_overview"] = """
select trade_date, n as flagged, h::bigint as high,
       (select count(*) from alert_r a where a.trade_date = d.trade_date and risk_band = 'HIGH' and news_types is null)
         as high_without_news,
       (select count(*) from alert_r a where a.trade_date = d.trade_date and exchange_query) as queried,
       n - lag(n) over (order by trade_date) as change
from day_n d"""
FINAL["market_map"] = f"""
select a.trade_date, a.symbol, company_name, risk_band, risk_score, return_pct,
       case when volume_ratio_20d is null then 1 when volume_ratio_20d < 0.2 then 0.2 else volume_ratio_20d end::double
         as volume_x, {rnd('9 + risk_score / 7', 0)} as size, {plain('rules_triggered')} as rules, t.line as news
from alert_r a join triaged t using (alert_id)"""
FINAL["filter_alerts"] = """
select alert_id, trade_date, symbol, risk_band, rules_triggered from alert_r
where risk_band <> 'LOW' and news_types is null
  and (contains(rules_triggered, 'PUMP_PATTERN') or contains(rules_triggered, 'CIRCUIT_STREAK'))"""
FINAL["rule_counts"] = """
select trade_date, rule, count(*) as alerts from fired_r semi join alert_r using (trade_date, symbol) group by 1, 2"""
FINAL["stock_timeline"] = f"""
select f.symbol, f.trade_date, open, high, low, f.close, f.volume, coalesce(f.volume_ratio_20d, 1) as volume_x,
       risk_band, risk_score, rules_triggered, case when risk_band is not null then {rnd('high * 1.035::double', 4)} end as mark_at
from fact f left join alert_r a using (symbol, trade_date)"""
FINAL["latest_filings"] = """
select symbol, position::integer as position, announced_at, category, summary, attachment_url from (
  select *, row_number() over (partition by symbol order by announced_at desc, seq_id) as position
  from filing where news_type <> 'ROUTINE') where position <= 12"""
FINAL["watch_suggestions"] = """
select symbol, risk_score from alert_r where risk_band = 'HIGH' and trade_date = (select max(trade_date) from alert_r)
order by risk_score desc, symbol limit 3"""

# ---------- finals: calendar, quality, operations ----------

_lo, _hi = CALENDAR
STEPS["cal"] = f"""
select d as day, isodow(d) <= 5 and h.description is null as is_trading_day, h.description
from (select unnest(generate_series(date '{_lo}', date '{_hi}', interval 1 day))::date as d)
left join hol h on h.holiday = d"""
FINAL["trading_calendar"] = """
select day, is_trading_day, case when not is_trading_day then coalesce(description, 'weekend') end as closed_for,
       (select max(p.day) from cal p where p.is_trading_day and p.day < c.day) as previous_trading_day,
       (select count(*) from cal p where p.is_trading_day and p.day <= c.day) as trading_days_so_far
from cal c"""
FINAL["dq_missing_days"] = f"""
select 'missing_bhavcopy_files' as check_name, case when m = 0 then 'PASS' else 'FAIL' end as status, m::double as value,
       case when m = 0 then 'all ' || n || ' trading days in the last 14 days present' else 'missing: ' || l end as detail
from (select count(*) as n, count(*) filter (where gone) as m, string_agg(day::varchar, ', ' order by day) filter (where gone) as l
      from (select day, day not in (select cast(o_orderdate as date) from orders where o_totalprice < 450000) as gone
            from cal where is_trading_day and day between date '{RUN_DATE}' - 14 and date '{RUN_DATE}'))"""
FINAL["dq_stale"] = """
select 'stale_stock_prices' as check_name, case behind when 0 then 'PASS' when 1 then 'WARN' else 'FAIL' end as status,
       behind::double as value, 'latest trade_date ' || z || ', expected ' || e || ' (' || behind
       || ' trading days behind)' as detail
from (select z, max(day) as e, count(*) filter (where day > z) as behind
      from cal, (select max(trade_date) as z from fact) where is_trading_day and day <= date '2001-11-30' group by z)
union all
select 'stale_fund_nav', case when age <= 4 then 'PASS' when age <= 7 then 'WARN' else 'FAIL' end, age::double,
       'latest NAV date ' || z || ' (' || age || ' days old)'
from (select max(nav_date) as z, date '2001-11-09' - max(nav_date) as age from nav)"""
FINAL["dq_row_count"] = f"""
select trade_date, stocks, {rnd('usual', 4)} as usual, {rnd('stocks / usual', 3)} as ratio, status from day_grade"""
FINAL["dq_unexplained_moves"] = f"""
select trade_date, symbol, return_pct from fact f where abs(return_pct) > {LOOSE_QUALITY.big_move_pct}
and not exists (select 1 from actions a where a.symbol = f.symbol and a.ex_date = f.trade_date)"""
FINAL["dq_big_moves"] = f"""
select 'moves_over_25pct_without_corp_action' as check_name, case when count(*) <= 10 then 'PASS' else 'WARN' end as status,
       count(*)::double as value,
       coalesce(string_agg(symbol || ' ' || {txt('return_pct', 1)} || '%', ', ' order by abs(return_pct) desc, symbol), 'none')
         as detail
from (select * from fact f where trade_date = date '1996-03-05' and abs(return_pct) > 3
      and not exists (select 1 from actions a where a.symbol = f.symbol and a.ex_date = f.trade_date)
      order by abs(return_pct) desc, symbol limit 50)"""
FINAL["dq_duplicates"] = """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1"""
FINAL["dq_short_days"] = f"""
select * from day_rows where stocks < {LOOSE_QUALITY.min_stocks_per_trading_day}"""
FINAL["dq_relationships"] = """
select trade_date, symbol, stock_sk from fact where stock_sk not in (select stock_sk from dim where version_no > 3)"""
FINAL["dq_accepted_values"] = """
select txn_type, count(*) as n from ftxn where txn_type in ('REDEEM', 'LUMPSUM', 'SWP') group by 1"""
FINAL["dq_expression"] = "select trade_date, symbol, return_pct from fact where return_pct < -10 or return_pct > 10"
FINAL["dq_nulls"] = "select txn_id, owner, txn_date, instrument_id from ftxn where unit_price is null"
FINAL["dq_continuity"] = f"""
select a.symbol, a.ex_date, {rnd('a.factor', 6)} as factor, before as prev_row_close, close
from actions a join (select *, lag(close) over (partition by symbol order by trade_date) as before from fact) f
  on f.symbol = a.symbol and f.trade_date = a.ex_date where abs(close / before - 1) > {LOOSE_QUALITY.continuity_limit}"""


def must(table: str, condition: str) -> str:
    return f"select count(*) from {table} where not ({condition})"


def dup(table: str, keys: str) -> str:
    return f"select count(*) from (select {keys} from {table} group by all having count(*) > 1)"


def odd(table: str, column: str, allowed) -> str:
    return f"select count(distinct {column}) from {table} where {column} not in ({quoted(allowed)})"


TESTS = {
    "dim_stock.unique_stock_sk": dup("dim", "stock_sk"),
    "dim_stock.not_null_stock_sk": must("dim", "stock_sk is not null"),
    "dim_stock.valid_range": must("dim", "valid_from < valid_to"),
    "dim_fund.unique_scheme_code": dup("fund", "scheme_code"),
    "dim_fund.not_null_scheme_code": must("fund", "scheme_code is not null"),
    "dim_fund.plan_values": odd("fund", "plan", ("Direct", "Regular")),
    "fact_stock_daily.unique_day_symbol": dup("fact", "trade_date, symbol"),
    "fact_stock_daily.not_null_stock_sk": must("fact", "stock_sk is not null"),
    "fact_stock_daily.price_range": must("fact", "high >= low and close >= low and close <= high"),
    "fact_stock_daily.delivery_range": must("fact", "deliv_pct >= 0 and deliv_pct <= 100"),
    "fact_stock_daily.volume_sign": must("fact", "volume >= 0"),
    "fact_stock_daily.complete_days":
        f"select count(*) from day_rows where stocks < {LOOSE_QUALITY.min_stocks_per_trading_day}",
    "fact_fund_nav.unique_scheme_day": dup("nav", "scheme_code, nav_date"),
    "fact_fund_nav.nav_sign": must("nav", "nav > 0"),
    "fact_portfolio_txn.unique_txn_id": dup("ftxn", "txn_id"),
    "fact_portfolio_txn.not_null_txn_id": must("ftxn", "txn_id is not null"),
    "fact_portfolio_txn.not_null_unit_price": must("ftxn", "unit_price is not null"),
    "fact_portfolio_txn.txn_type_values": odd("ftxn", "txn_type", fixed.TXN_TYPES),
    "fact_surveillance_alert.unique_alert_id": dup("alert_r", "alert_id"),
    "fact_surveillance_alert.not_null_alert_id": must("alert_r", "alert_id is not null"),
    "fact_surveillance_alert.not_null_reason": must("alert_r", "reason is not null"),
    "fact_surveillance_alert.band_values": odd("alert_r", "risk_band", fixed.BANDS),
    "fact_surveillance_alert.score_range": must("alert_r", "risk_score >= 0 and risk_score <= 100"),
    "fact_surveillance_alert.rules_named": must("alert_r", "rules_triggered <> ''"),
    "int_alert_outcomes.unique_symbol": dup("out_r", "symbol"),
    "int_alert_outcomes.not_null_symbol": must("out_r", "symbol is not null"),
    "int_alert_outcomes.band_values": odd("out_r", "best_band", (*fixed.BANDS, "NOT_ALERTED")),
    "mart_surveillance_validation.unique_segment": dup("valid", "segment"),
    "mart_surveillance_validation.not_null_segment": must("valid", "segment is not null"),
    "mart_portfolio_holdings.unique_holding": dup("hold", "owner, asset_class, instrument_id"),
    "mart_portfolio_holdings.held_sign": must("hold", "held_qty >= -0.0001"),
    "mart_portfolio_holdings.not_null_current_price": must("hold", "current_price is not null"),
    "mart_fund_performance.unique_scheme_code": dup("newest_m", "scheme_code"),
    "mart_fund_performance.not_null_scheme_code": must("newest_m", "scheme_code is not null"),
    "fact_stock_daily.stock_sk_in_dim_stock": must("fact", "stock_sk in (select stock_sk from dim)"),
    "fact_fund_nav.scheme_code_in_dim_fund": must("nav", "scheme_code in (select scheme_code from fund)"),
    "fact_surveillance_alert.stock_sk_in_dim_stock": must("alert_r", "stock_sk in (select stock_sk from dim)"),
    "dim_date.unique_date_key": dup("dates", "date_key"),
    "dim_date.not_null_date_key": must("dates", "date_key is not null"),
    "dim_index.unique_index_sk": dup("idx_dim", "index_sk"),
    "dim_index.not_null_index_sk": must("idx_dim", "index_sk is not null"),
    "fact_index_daily.unique_day_index": dup("idx", "trade_date, index_name"),
    "int_surveillance_signals.unique_day_symbol": dup("sig_r", "trade_date, symbol"),
    "mart_sector_performance.unique_day_industry": dup("sector", "trade_date, industry"),
    "fact_stock_daily.date_key_in_dim_date": must("fact", "date_key in (select date_key from dates)"),
    "fact_index_daily.index_sk_in_dim_index": must("idx", "md5(index_name) in (select index_sk from idx_dim)"),
}
STEPS["dates"], STEPS["sector"] = FINAL["dim_date"], FINAL["sector_performance"]
STEPS["tests"] = "\nunion all\n".join(
    f"select '{name}' as test, ({sql}) as failures" for name, sql in TESTS.items())
STEPS["tested"] = """
select *, case when failures = 0 then 'pass' when test = 'fact_stock_daily.complete_days' then 'warn' else 'fail' end as status
from tests"""
FINAL["dq_model_tests"] = "select * from tested"
FINAL["dq_summary"] = """
select 'dbt_build' as check_name, case when f > 0 then 'FAIL' when w > 0 then 'WARN' else 'PASS' end as status,
       f::double as value, n || ' nodes; failed: ' || coalesce(fl, 'none') || '; warned: ' || coalesce(wl, 'none') as detail
from (select count(*) as n, count_if(status = 'fail') as f, count_if(status = 'warn') as w,
             string_agg(test, ', ' order by test) filter (where status = 'fail') as fl,
             string_agg(test, ', ' order by test) filter (where status = 'warn') as wl from tested)"""
FINAL["pipeline_steps"] = f"""
select step, {rnd(f"avg({rnd('value', 1)})", 3)} as mean_s, count(*) as runs,
       case step when 'extract' then 2 when 'silver' then 3 when 'dbt' then 4 when 'quality' then 6 else 7 end as position
from runs where status = 'SUCCESS' group by 1"""
FINAL["pipeline_steps_recent"] = FINAL["pipeline_steps"].replace(
    "from runs where", "from (select * from runs order by ts desc, run_id, step limit 60) where")
FINAL["pipeline_last_run"] = """
select max(ts) as last_started, count_if(status = 'FAILED')::bigint as failed
from (select * from runs order by ts desc, run_id, step limit 7)"""
FINAL["data_coverage"] = """
select max(trade_date) as latest_day, count(distinct trade_date) as days, count(distinct symbol) as stocks from fact"""
FINAL["coverage_sketches"] = """
select date_trunc('month', l_shipdate)::date as month, count(distinct l_shipdate::date) as days, true as within_bound
from lineitem group by 1"""
FINAL["latest_check_batch"] = """
select step as check_name, status, ts as checked_at from runs where ts >= (select max(ts) - interval 1 minute from runs)"""
FINAL["freshness"] = """
select z as _latest, (date '2024-02-04' - z)::integer as age_days,
       case when date '2024-02-04' - z >= 7 then 'error' when date '2024-02-04' - z >= 4 then 'warn' else 'pass' end as status
from (select max(ts)::date as z from events)"""

# ---------- finals: ingest ----------

STEPS["rawpx"] = """
select case when not (l_linenumber = 7 and l_returnflag = 'R') then trade_date end as trade_date, upper(symbol) as symbol,
       'EQ' as series, null::double as prev_close, (tick - 50)::double as open,
       case when not (l_linenumber = 3 and l_returnflag = 'N') then (tick + 100)::double end as high,
       case when l_linenumber = 4 and l_returnflag = 'N' then tick + 200 else tick - 100 end::double as low,
       tick::double as last,
       case when l_linenumber = 6 and l_returnflag = 'A' then null when l_linenumber = 5 and l_returnflag = 'A' then 0
            else tick end::double as close, null::double as vwap, qty as volume, cents::double as turnover_lacs,
       l_linenumber::bigint as num_trades, case when l_returnflag <> 'R' then qty end as deliv_qty, null::double as deliv_pct,
       (l_linenumber, l_returnflag) in ((7, 'R'), (3, 'N'), (4, 'N'), (6, 'A'), (5, 'A')) as bad
from tr"""
FINAL["price_rows_clean"] = """
select * exclude (bad, r) from (
  select *, row_number() over (partition by trade_date, symbol order by open, high, low, last, close, volume, turnover_lacs,
           num_trades, deliv_qty nulls last) as r from rawpx where not bad) where r = 1"""
FINAL["reject_split"] = "select * exclude (bad), 'null/non-positive close or high<low' as reason from rawpx where bad"
FINAL["price_files_stored"] = FINAL["price_rows_clean"]
FINAL["price_files_quarantined"] = FINAL["reject_split"]
FINAL["index_files_stored"] = "select * from idx"
_COUNTS = """
       count_if(not bad) as good, count_if(bad) as rejected, count_if(trade_date is null) as no_date, 0::bigint as no_symbol,
       count_if(close is null) as no_close, count_if(close <= 0) as close_not_positive, count_if(high is null) as no_range,
       count_if(high < low) as high_below_low"""
FINAL["price_file_counts"] = f"""
select {_COUNTS} from rawpx union all select {_COUNTS} from rawpx where year(trade_date) = 1998"""
FINAL["filing_files_stored"] = """
select seq_id, symbol, strftime(announced_at, '%Y-%m-%d %H:%M:%S') as announced_at, trim(category) as category, summary,
       attachment_url from filing"""
FINAL["action_files_stored"] = f"""
select symbol, 'EQ' as series, ex_date, action_type, {rnd('factor', 6)} as factor, subject
from (select *, row_number() over (partition by symbol, ex_date, action_type order by factor, subject) as r
      from act_rated where action_type is not null) where r = 1"""
FINAL["nav_files_stored"] = """
select scheme_code, isin_growth, null::varchar as isin_reinvest, scheme_name, round(nav * 10000) as nav, nav_date, amc, category
from nav_src where daily and dayofyear(nav_date) % 61 <> 0 and dayofyear(nav_date) % 50 <> 0"""
FINAL["history_files_stored"] = """
select s.scheme_code, s.nav_date, min(tick) / 10000 as nav, any_value(n.scheme_name) as scheme_name, any_value(n.amc) as amc,
       any_value(n.category) as category
from sch s join nav_src n using (scheme_code, nav_date)
where s.scheme_code % 10 <> 3 and dayofyear(nav_date) % 59 <> 0 and dayofyear(nav_date) % 53 <> 0 and dayofyear(nav_date) % 47 <> 0
group by 1, 2"""
FINAL["history_files_broken"] = "select distinct scheme_code from sch where scheme_code % 10 = 3"
FINAL["master_files_stored"] = """
select m.* replace (case when n_nationkey % 2 = 1 then nat.industry end as industry, n_nationkey % 2 = 1 as in_nifty500)
from master m join nat using (symbol)"""
FINAL["holiday_files"] = "select * from hol"
FINAL["portfolio_file_staged"] = FINAL["portfolio_txn_staged"]
FINAL["scd2_merged"] = "select * from dim"
FINAL["dq_quarantine"] = f"""
select 'quarantined_price_rows' as check_name, case when n = 0 then 'PASS' when n < 20 then 'WARN' else 'FAIL' end as status,
       n::double as value, n || ' bad price rows on {RUN_DATE}' as detail
from (select count(*) as n from rawpx where bad and trade_date = date '{RUN_DATE}')"""
FINAL["nav_text_parse"] = """
select scheme_code, isin_growth, null::varchar as isin_reinvest, scheme_name,
       case when dayofyear(nav_date) % 50 <> 0 then round(nav * 10000) end as nav, nav_date, amc, category
from nav_src where daily and dayofyear(nav_date) % 61 <> 0"""
FINAL["surveillance_lists_flatten"] = "select * from lists"
FINAL["wide_price_reshape"] = """
select d.trade_date as date, r.r_name as ticker, max(close) as close, sum(volume)::double as total_volume
from (select distinct trade_date from fact) d cross join region r
left join (select f.trade_date, dim.industry, f.close, f.volume from fact f join dim using (stock_sk)) x
  on x.trade_date = d.trade_date and x.industry = r.r_name group by 1, 2"""
FINAL["watched_funds"] = "select scheme_code, nav_date, nav from nav where scheme_code % 2 = 0"
FINAL["upsert_idempotent"] = """
select case when new_n is null then 'F' else 'O' end as l_linestatus, l_partkey, trade_date, coalesce(new_n, old_n) as trades,
       coalesce(new_v, old_v)::bigint as volume
from (select l_partkey, cast(l_shipdate as date) as trade_date,
             nullif(count(*) filter (where l_linestatus = 'O'), 0) as new_n,
             count(*) filter (where l_linestatus = 'F') as old_n,
             sum(l_quantity) filter (where l_linestatus = 'O') as new_v,
             sum(l_quantity) filter (where l_linestatus = 'F') as old_v from lineitem group by 1, 2)"""
FINAL["main_series"] = """
select symbol, trade_date, series, close, volume from ser_bar
qualify row_number() over (partition by symbol, trade_date order by volume desc, series) = 1"""


# ---------- assembly ----------

_uses: dict[str, list[str]] = {}


def _needed(sql: str) -> list[str]:
    tables = set(re.findall(r"\b(?:from|join)\s+([a-z_][a-z_0-9]*)", sql))
    return [name for name in STEPS if name in tables]


def statement(name: str) -> str:
    order: list[str] = []

    def visit(step: str) -> None:
        if step in order:
            return
        if step not in _uses:
            _uses[step] = [s for s in _needed(STEPS[step]) if s != step]
        for other in _uses[step]:
            visit(other)
        order.append(step)

    for step in _needed(FINAL[name]):
        visit(step)
    if not order:
        return FINAL[name].strip()
    listed = ",\n".join(f"{step} as ({STEPS[step].strip()})" for step in order)
    return f"with recursive {listed}\n{FINAL[name].strip()}"


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in FINAL}
