"""The expected result of each query in SQL for DuckDB, written apart from the operators."""

import re

from .views import VIEWS, duckdb_view

# Named steps; a step may use the views and steps before it.
STEPS = {
    "ranked": "select *, row_number() over (partition by symbol, dt order by seq) as copy_no from bars_raw",
    "kept": "select * exclude (copy_no) from ranked where copy_no = 1",
    "rejected": "select * exclude (copy_no) from ranked where copy_no > 1",
    "sparse_ranked": "select *, row_number() over (partition by symbol, dt order by seq) as copy_no from bars_sparse",
    "sparse_kept": "select * exclude (copy_no) from sparse_ranked where copy_no = 1",
    "sparse_rejected": "select * exclude (copy_no) from sparse_ranked where copy_no > 1",
    "stored": """
        select * exclude (n) from (
            select *, row_number() over (partition by symbol, dt order by seq) as n
            from bars_raw where dt < date '2000-01-01') where n = 1""",
    "delivered": "select * from bars_raw where dt >= date '1999-07-01'",
    "arrivals": """
        select *, row_number() over (partition by symbol, dt order by prio, seq) as n,
               count(*) over (partition by symbol, dt) as key_rows
        from (select *, 0 as prio from stored union all select *, 1 as prio from delivered)""",
    "cumulative": """
        select symbol, dt, multiplier, product(multiplier) over (
            partition by symbol order by dt rows between unbounded preceding and current row) as cum_multiplier
        from multipliers_raw""",
    "adjusted": """
        select b.symbol, b.dt, b.open, b.high, b.low, b.close, b.volume,
               b.open * m.cum_multiplier as adj_open, b.high * m.cum_multiplier as adj_high,
               b.low * m.cum_multiplier as adj_low, b.close * m.cum_multiplier as adj_close
        from kept b asof left join cumulative m on b.symbol = m.symbol and b.dt >= m.dt""",
    # Membership as (change dates) x (symbols), the closed form of walking back in time.
    "change_days": """
        select index_name, dt, row_number() over (partition by index_name order by dt desc) as back
        from (select distinct index_name, dt from index_changes
              where index_name in (select index_name from index_current))""",
    "universe": """
        select d.index_name, d.dt, d.back, s.symbol, i.index_name is not null as has_in,
               o.index_name is not null as has_out, c.index_name is not null as in_current
        from change_days d
        join (select index_name, symbol from index_changes union select index_name, symbol from index_current) s
          on s.index_name = d.index_name
        left join (select distinct * exclude (seq) from index_changes where change_type = 'I') i
          on i.index_name = d.index_name and i.symbol = s.symbol and i.dt = d.dt
        left join (select distinct * exclude (seq) from index_changes where change_type = 'E') o
          on o.index_name = d.index_name and o.symbol = s.symbol and o.dt = d.dt
        left join (select distinct * from index_current) c
          on c.index_name = d.index_name and c.symbol = s.symbol""",
    "universe_next": """
        select *, last_value(case when has_in then 'I' when has_out then 'E' end ignore nulls) over (
            partition by index_name, symbol order by dt desc
            rows between unbounded preceding and 1 preceding) as next_kind
        from universe""",
    "snapshots": """
        select index_name, symbol, dt from universe_next
        where case when back = 1 then in_current when has_out then false when has_in then true
                   when next_kind is not null then next_kind = 'E' else in_current end""",
    "snap_days": """
        select index_name, dt, lead(dt) over (partition by index_name order by dt) as next_dt
        from (select distinct index_name, dt from snapshots)""",
    # Latest snapshot day of every index for every kept bar.
    "bar_snaps": """
        select b.symbol, b.dt, b.index_name, d.dt as snap_dt
        from (select k.symbol, k.dt, n.index_name from kept k
              cross join (select distinct index_name from snap_days) n) b
        asof left join snap_days d on b.index_name = d.index_name and b.dt >= d.dt""",
    "bar_flags": """
        select b.symbol, b.dt, b.index_name, case when s.symbol is null then 0 else 1 end as flag
        from bar_snaps b left join snapshots s
          on s.index_name = b.index_name and s.dt = b.snap_dt and s.symbol = b.symbol""",
    "wide_flags": """
        select symbol, dt,
               max(case when index_name = '1-URGENT' then flag else 0 end) as "1-URGENT",
               max(case when index_name = '2-HIGH' then flag else 0 end) as "2-HIGH",
               max(case when index_name = '3-MEDIUM' then flag else 0 end) as "3-MEDIUM",
               max(case when index_name = '4-NOT SPECIFIED' then flag else 0 end) as "4-NOT SPECIFIED",
               max(case when index_name = '5-LOW' then flag else 0 end) as "5-LOW"
        from bar_flags group by symbol, dt""",
    "urgent_flags": "select symbol, dt, flag from bar_flags where index_name = '1-URGENT'",
    "urgent_days": "select distinct dt from snapshots where index_name = '1-URGENT'",
    "urgent_held": "select distinct symbol, dt from snapshots where index_name = '1-URGENT'",
    "markers": """
        select symbol, dt, cast(case when held then 1 else 0 end as integer) as flag from (
            select s.symbol, d.dt, h.dt is not null as held,
                   lag(h.dt is not null) over (partition by s.symbol order by d.dt) as held_before
            from urgent_days d cross join (select distinct symbol from urgent_held) s
            left join urgent_held h on h.symbol = s.symbol and h.dt = d.dt)
        where held or held_before""",
    "named": """
        select f.seq, case when f.index_name = '5-LOW' then 'LOW' else f.index_name end as index_name,
               coalesce(r.new, s.symbol, f.scrip) as symbol,
               case when f.change_text like '%Inclusion%' then 'I' when f.change_text like '%Exclusion%' then 'E' end as change_type,
               cast(strptime(f.date_text, '%d-%m-%Y') as date) as dt
        from index_feed f left join scrip_map s on s.scrip = f.scrip
        left join renames r on r.old = coalesce(s.symbol, f.scrip)""",
    "normalised": """
        select n.index_name, n.seq, coalesce(m.correct_symbol, n.symbol) as symbol, n.change_type, n.dt
        from named n left join (select distinct symbol, dt, correct_symbol from manual_fix) m
          on m.symbol = n.symbol and m.dt = n.dt""",
    "stored_ranges": """
        select symbol, 'Dump' as source, min(dt) as start_dt, max(dt) as end_dt from stored group by symbol
        union all
        select coalesce(r.new, b.symbol), 'ModDump', min(dt), max(dt)
        from stored b left join renames r on r.old = b.symbol group by 1""",
    "new_ranges": """
        select symbol, 'Dump' as source, min(dt) as min_dt, max(dt) as max_dt from delivered group by symbol
        union all
        select coalesce(r.new, b.symbol), 'ModDump', min(dt), max(dt)
        from delivered b left join renames r on r.old = b.symbol group by 1""",
    "cleaned": """
        select coalesce(r.new, m.symbol) as symbol, m.dt, m.multiplier, m.seq,
               coalesce(
                   (select min(start_dt) from stored_ranges g where g.symbol = coalesce(r.new, m.symbol) and source = 'ModDump'),
                   (select min(start_dt) from stored_ranges g where g.symbol = coalesce(r.new, m.symbol) and source = 'Dump')
               ) as first_dt
        from multipliers_raw m left join renames r on r.old = m.symbol""",
    "landed": "select *, cast(date_trunc('month', dt) as date) as file_day from bars_raw",
}


def _scores(kept, rejected, since="1900-01-01"):
    """Distinct rejected rows beside the kept one; neighbours found by as-of joins."""
    n = lambda side, c: f"trunc(coalesce({side}.{c}, 0))"
    near = lambda c: f"(case when p.dt is null then {n('q', c)} else {n('p', c)} end" + (
        f" + case when q.dt is null then {n('p', c)} else {n('q', c)} end) / 2.0"
    )
    price = lambda side: " + ".join(
        f"power({near(c)} - {n(side, c)}, 2)" for c in ("open", "high", "low", "close")
    )
    volume = lambda side: f"power({near('volume')} - {n(side, 'volume')}, 2)"
    return f"""
        select s.symbol, s.dt, s.open, s.high, s.low, s.close, s.volume, s.seq,
               k.open as kept_open, k.high as kept_high, k.low as kept_low, k.close as kept_close,
               k.volume as kept_volume,
               cast((case when p.dt is null then 0 else 1 end) + (case when q.dt is null then 0 else 1 end) as integer) as neighbours,
               {price('s')} as price_error, {volume('s')} as volume_error,
               {price('k')} as kept_price_error, {volume('k')} as kept_volume_error
        from (select symbol, dt, open, high, low, close, volume, min(seq) as seq from {rejected}
              where dt >= date '{since}' group by all) s
        join {kept} k on k.symbol = s.symbol and k.dt = s.dt
        left join (select a.symbol, a.dt as at, b.* exclude (symbol) from {kept} a
                   asof join {kept} b on a.symbol = b.symbol and a.dt > b.dt where year(a.dt) = year(b.dt)) p
          on p.symbol = s.symbol and p.at = s.dt
        left join (select a.symbol, a.dt as at, b.* exclude (symbol) from {kept} a
                   asof join {kept} b on a.symbol = b.symbol and a.dt < b.dt where year(a.dt) = year(b.dt)) q
          on q.symbol = s.symbol and q.at = s.dt"""


_BETTER = "neighbours > 0 and (price_error < kept_price_error or volume_error < kept_volume_error)"
STEPS["scores"] = _scores("kept", "rejected")
STEPS["sparse_scores"] = _scores("sparse_kept", "sparse_rejected")
STEPS["picked"] = f"""
        select symbol, dt, open, high, low, close, volume, seq from (
            select *, row_number() over (partition by symbol, dt order by seq) as n from scores where {_BETTER})
        where n = 1"""
STEPS["modified"] = """
        select *, row_number() over (partition by symbol, dt order by prio, seq, came_as) as n from (
            select coalesce(r.new, b.symbol) as symbol, b.* exclude (symbol), b.symbol as came_as
            from (select *, 0 as prio from picked union all select *, 1 as prio from kept) b
            left join renames r on r.old = b.symbol)"""

# The whole run: actions cleaned by the ranges of all bars, then modified bars adjusted.
STEPS["run_actions"] = """
        select symbol, dt, product(multiplier) over (
            partition by symbol order by dt rows between unbounded preceding and current row) as cum_multiplier
        from (select *, row_number() over (partition by symbol, dt order by seq) as n from (
            select coalesce(r.new, m.symbol) as symbol, m.dt, m.multiplier, m.seq
            from multipliers_raw m left join renames r on r.old = m.symbol) c
            where c.dt >= coalesce((select min(dt) from modified g where g.symbol = c.symbol),
                                   (select min(dt) from kept k where k.symbol = c.symbol)))
        where n = 1"""
STEPS["run_result"] = """
        select b.symbol, b.dt, b.open, b.high, b.low, b.close, b.volume,
               b.open * m.cum_multiplier as adj_open, b.high * m.cum_multiplier as adj_high,
               b.low * m.cum_multiplier as adj_low, b.close * m.cum_multiplier as adj_close
        from (select * from modified where n = 1) b
        asof left join run_actions m on b.symbol = m.symbol and b.dt >= m.dt"""

# The same run with the pairs that a review accepts in place of the picked rows.
_STRUCK = "volume in (5, 11, 17, 23, 31, 41)"
STEPS["reviewed"] = f"""
        select symbol, dt, open, high, low, close, volume, seq from (
            select *, row_number() over (partition by symbol, dt order by seq) as n
            from scores where ({_BETTER}) and not {_STRUCK}) where n = 1"""
STEPS["modified_reviewed"] = STEPS["modified"].replace("from picked", "from reviewed")
STEPS["run_reviewed"] = STEPS["run_result"].replace("from modified", "from modified_reviewed")

# Snapshots of the changes as the feed gives them, in the closed form of those of `index_changes`.
STEPS["feed_changes"] = """
        select case when index_name = 'LOW' then '5-LOW' else index_name end as index_name, symbol, dt, change_type, seq
        from normalised"""
for _step in ("change_days", "universe", "universe_next", "snapshots"):
    _text = re.sub(r"\b(change_days|universe_next|universe|snapshots)\b", r"feed_\1", STEPS[_step])
    STEPS[f"feed_{_step}"] = _text.replace("index_changes", "feed_changes")

# Bars of lines that parse.
STEPS["sound_ranked"] = """
        select symbol, dt, row_number() over (partition by symbol, dt order by seq) as n
        from bars_raw where volume not in (7, 13, 21)"""

_NULL_ADJUSTED = ", ".join(
    f"cast(null as double) as adj_{p}" for p in ("open", "high", "low", "close")
)
_BAR = "symbol, dt, open, high, low, close, volume"
_ADJ = "adj_open, adj_high, adj_low, adj_close"

_SUMS = ", ".join(
    f"cast(sum(cast(floor({c} * 100 + 0.5) as decimal(19,0))) as double) / 100 as {c}_sum"
    for c in ("open", "high", "low", "close", "adj_open", "adj_high", "adj_low", "adj_close")
)


def _totals(table, where):
    sums = ", ".join(
        f"cast(trunc(cast(sum(cast(floor({c} * 100 + 0.5) as decimal(19,0))) as double) / 100) as bigint) as {c}_sum"
        for c in ("open", "high", "low", "close")
    )
    return f"""select cast(year(dt) as integer) as year, count(*) as row_count, {sums},
                      cast(sum(volume) as bigint) as volume_sum from {table} where {where} group by 1"""


def _recon(limit):
    """Every bar and every day by themselves; `limit` holds for snapshots and flags."""
    where = f"where {limit}" if limit else ""
    return f"""
        with flagged as (
            select distinct coalesce(r.new, b.symbol) as symbol, b.dt, b.index_name, b.snap_dt
            from (select * from bar_snaps {where}) b join bar_flags f
              on f.symbol = b.symbol and f.dt = b.dt and f.index_name = b.index_name
            left join renames r on r.old = b.symbol
            where f.flag = 1 and b.dt >= date '1995-01-01'),
        until as (
            select index_name, dt, coalesce(lead(dt) over (partition by index_name order by dt) - 1,
                   greatest(dt, (select max(dt) from kept {where}))) as last_dt
            from snap_days {where}),
        expected as (
            select distinct s.index_name, s.dt as snap_dt, cast(y.year as integer) as year, s.symbol
            from snapshots s join until u on u.index_name = s.index_name and u.dt = s.dt
            join (select unnest(range(1990, 2010)) as year) y on y.year between year(u.dt) and year(u.last_dt)),
        found as (
            select distinct index_name, coalesce(snap_dt, date '1900-01-01') as snap_dt,
                   cast(year(dt) as integer) as year, symbol from flagged)
        select *, 'snapshot only' as side from (select * from expected except select * from found)
        union all
        select *, 'flags only' from (select * from found except select * from expected)"""


_HISTORY = """
        select a.symbol, a.dt as date, a.open, a.high, a.low, a.close, a.volume,
               coalesce(a.adj_open, a.open) as adjopen, coalesce(a.adj_high, a.high) as adjhigh,
               coalesce(a.adj_low, a.low) as adjlow, coalesce(a.adj_close, a.close) as adjclose,
               case when a.dt < date '1997-01-01' then true end as buffer"""
STEPS["served"] = f"""{_HISTORY}, f.flag as idxflag, coalesce(m.multiplier, 0.0) as split
        from adjusted a join urgent_flags f on f.symbol = a.symbol and f.dt = a.dt
        left join multipliers_raw m on m.symbol = a.symbol and m.dt = a.dt
        where a.dt between date '1996-07-01' and date '2001-06-30'"""

ORACLES = {
    # files
    "scan_bars": f"select {_BAR}, file_day from landed where year(file_day) >= 1996",
    "scan_bars_delta": f"select {_BAR}, file_day from landed where file_day >= date '2000-01-01'",
    "fetch_bars": f"""select {_BAR} from kept where dt between date '1996-03-01' and date '1999-10-31'
        and symbol in (select symbol from wanted_symbols)""",
    "ingest_stream": f"""
        select {_BAR}, 'bars' as went_to from kept
        union all
        select {_BAR}, 'bars_skipped' from rejected where dt >= date '2000-01-01'
        union all
        select {_BAR}, 'bars_mod' from (
            select *, row_number() over (partition by symbol, dt order by prio, seq) as n
            from (select *, 0 as prio from picked union all select *, 1 as prio from kept)
            where dt >= date '2000-01-01') where n = 1
        union all
        select {_BAR}, 'bars_late' from landed
        where file_day >= date '1999-11-01' and file_day <= (select max(dt) from kept where dt < date '2000-01-01')""",
    "full_load": "select * from run_result",
    "full_load_again": "select * from run_result",
    "full_load_from_year": f"select {_BAR} from kept",
    "read_multipliers": "select symbol, dt, multiplier from multipliers_raw",
    "read_renames": "select old, new from renames",
    "read_index_feed": "select index_name, date_text, scrip, change_text from index_feed",
    "read_scrip_map": "select * from scrip_map",
    "read_manual_fixes": """
        select concat(symbol, ' \u2013 Caf\u00e9 \u201cx') as symbol, dt, correct_symbol from manual_fix""",
    "read_index_current": "select * from index_current",
    "read_replacements": f"""
        with judged as (
            select symbol, dt, case when volume <> 41 then open end as open, volume, seq,
                   case volume when 41 then 'malformed line' when 11 then 'no selected row'
                               when 17 then 'another symbol' when 23 then 'another date' end as reason
            from scores where ({_BETTER}) and volume not in (5, 31))
        select symbol, dt, open, volume, case when n > 1 then 'bar replaced already' end as reason from (
            select *, row_number() over (partition by symbol, dt order by seq) as n from judged where reason is null)
        union all
        select symbol, dt, open, volume, reason from judged where reason is not null
        union all
        select symbol, dt, kept_open, kept_volume, 'no skipped row' from scores where ({_BETTER}) and volume = 31""",
    "malformed_lines": """
        select symbol, dt, cast(null as integer) as fields, case when n = 1 then 'bars' else 'bars_skipped' end as went_to
        from sound_ranked
        union all
        select symbol, dt, cast(case volume when 7 then 7 when 13 then 6 else 8 end as integer), 'bars_malformed'
        from bars_raw where volume in (7, 13, 21)""",
    "full_load_reviewed": "select * from run_reviewed",
    "ingest_stream_files": """
        select symbol, dt, case when copy_no = 1 then 'bars' else 'bars_skipped' end as went_to from ranked""",
    "refresh_membership": """
        select index_name, symbol, dt, change_type from feed_changes
        union all select index_name, symbol, dt, 'snapshot' from feed_snapshots""",
    "update_adjusted": f"""
        select {_BAR}, case when dt >= date '1999-01-01' then adj_open end as adj_open,
               case when dt >= date '1999-01-01' then adj_high end as adj_high,
               case when dt >= date '1999-01-01' then adj_low end as adj_low,
               case when dt >= date '1999-01-01' then adj_close end as adj_close from run_result""",
    "delta_run_append": "select * from run_result",
    "rename_stored_run": """
        select symbol, dt, case when n > 1 then came_as end as old_symbol from (
            select symbol, dt, came_as, row_number() over (
                partition by symbol, dt order by case when symbol = came_as then 0 else 1 end, came_as) as n
            from (select coalesce(r.new, b.symbol) as symbol, b.dt, b.symbol as came_as
                  from kept b left join renames r on r.old = b.symbol))""",
    "delta_run": """
        select symbol, dt, open, high, low, close, volume, adj_open, adj_high, adj_low, adj_close from run_result""",
    "rewrite_year": """
        select symbol, dt, open, high, low, case when year(dt) = 1998 then close / 2 else close end as close, volume
        from kept""",
    # duplicates
    "dedupe_first": "select * from kept",
    "duplicates_all": """
        select * exclude (n) from (select *, count(*) over (partition by symbol, dt) as n from bars_raw) where n > 1""",
    "skipped_rows": "select * from rejected",
    "skipped_distinct": f"select distinct {_BAR} from rejected where dt >= date '1996-01-01'",
    "append_bars": "select * exclude (n, prio, key_rows) from arrivals where n = 1",
    "append_skipped": "select * exclude (n, prio, key_rows) from arrivals where n > 1",
    "append_duplicates": "select * exclude (n, prio, key_rows) from arrivals where key_rows > 1",
    "dups_not_skipped": f"""
        select d.* from (select * exclude (n) from (
            select *, count(*) over (partition by symbol, dt) as n from bars_sparse) where n > 1) d
        where not exists (select 1 from sparse_rejected s where s.symbol = d.symbol and s.dt = d.dt
            and s.open = d.open and s.high = d.high and s.low = d.low and s.close = d.close and s.volume = d.volume)""",
    "dup_key_counts": """
        select symbol, dt, count(*) as row_count from bars_raw group by symbol, dt having count(*) > 1
        order by row_count desc, symbol, dt""",
    # repair
    "repair_scores": "select * from scores",
    "repair_scores_sparse": "select * from sparse_scores",
    "replaceable": f"select * from scores where {_BETTER} and dt >= date '1996-01-01'",
    "unverified": """
        select * exclude (price_error, volume_error, kept_price_error, kept_volume_error)
        from sparse_scores where neighbours = 0""",
    "replacements": "select * from picked",
    # symbols
    "rename_symbols": "select coalesce(r.new, b.symbol) as symbol, b.* exclude (symbol) from bars_raw b left join renames r on r.old = b.symbol",
    "resolve_map": """
        select old, arg_max(new, pos) as new from (
            with recursive walk as (
                select old, new, pos from rename_chain
                union all
                select w.old, m.new, m.pos from walk w join rename_chain m on m.old = w.new and m.pos > w.pos)
            select * from walk) group by old""",
    "build_modified": f"select {_BAR}, {_NULL_ADJUSTED} from modified where n = 1",
    "modified_losers": f"select {_BAR}, seq from modified where n > 1",
    "append_modified": f"""
        select {_BAR}, {_NULL_ADJUSTED} from (
            select *, row_number() over (partition by symbol, dt order by prio, seq, came_as) as n from (
                select * , 0 as prio, symbol as came_as from stored
                union all
                select coalesce(r.new, b.symbol) as symbol, b.* exclude (symbol, prio), b.prio, b.symbol as came_as
                from (select *, 1 as prio from picked
                      union all
                      select * exclude (n), 2 as prio from (
                          select *, row_number() over (partition by symbol, dt order by seq) as n from delivered)
                      where n = 1) b
                left join renames r on r.old = b.symbol)) where n = 1""",
    "rename_stored": f"""
        select {_BAR}, case when n > 1 then came_as end as old_symbol from (
            select *, row_number() over (
                partition by symbol, dt order by case when symbol = came_as then 0 else 1 end, came_as) as n
            from (select coalesce(r.new, b.symbol) as symbol, b.* exclude (symbol), b.symbol as came_as
                  from kept b left join renames r on r.old = b.symbol))""",
    "symbol_range": """
        select symbol, 'Dump' as source, min(dt) as start_dt, max(dt) as end_dt from bars_raw group by symbol
        union all
        select coalesce(r.new, b.symbol), 'ModDump', min(dt), max(dt)
        from bars_raw b left join renames r on r.old = b.symbol group by 1""",
    "symbol_range_merge": """
        select symbol, source, min(start_dt) as start_dt, max(end_dt) as end_dt
        from (select * from stored_ranges union all select * from new_ranges) group by symbol, source""",
    "range_delta": """
        select symbol, source, coalesce(s.start_dt, n.min_dt) as start_dt,
               case when s.end_dt is null or n.max_dt > s.end_dt then n.max_dt else s.end_dt end as end_dt,
               case when s.symbol is null then 'insert' when n.max_dt > s.end_dt then 'extend' else 'keep' end as action
        from stored_ranges s full join new_ranges n using (symbol, source)""",
    "range_anomalies": """
        select symbol, source, s.start_dt as min_dt, s.end_dt as max_dt, n.min_dt as start_dt, n.max_dt as end_dt,
               s.start_dt <= n.min_dt as starts_early, s.end_dt <= n.max_dt as ends_inside
        from stored_ranges s join new_ranges n using (symbol, source)
        where s.start_dt <= n.min_dt or s.end_dt <= n.max_dt""",
    "delta_gate": """
        select max(end_dt) as last_dt, date '2000-01-01' as delta_dt, max(end_dt) < date '2000-01-01' as ok
        from stored_ranges""",
    # corporate actions
    "multipliers_kept": "select symbol, dt, multiplier, seq from cleaned where dt >= first_dt",
    "multipliers_skipped": "select symbol, dt, multiplier, seq from cleaned where first_dt is null or dt < first_dt",
    "multipliers_append": """
        select symbol, dt, multiplier, seq from (
            select *, row_number() over (partition by symbol, dt order by prio, seq) as n from (
                select symbol, dt, multiplier, seq, 0 as prio from multipliers_raw where dt < date '2000-01-01'
                union all
                select symbol, dt, multiplier * 8, seq, 1 from multipliers_raw where dt >= date '1999-07-01'))
        where n = 1""",
    "cum_multiplier": "select * from cumulative",
    "adjust_prices": "select * from adjusted",
    "adjust_prices_window": "select * from adjusted",
    "adjust_prices_delta": f"""
        select {_BAR}, case when dt >= date '2000-01-01' then adj_open end as adj_open,
               case when dt >= date '2000-01-01' then adj_high end as adj_high,
               case when dt >= date '2000-01-01' then adj_low end as adj_low,
               case when dt >= date '2000-01-01' then adj_close end as adj_close from adjusted""",
    "replace_symbol_tail": f"""
        select {_BAR}, case when dt >= date '2000-01-01' then adj_open end as adj_open,
               case when dt >= date '2000-01-01' then adj_high end as adj_high,
               case when dt >= date '2000-01-01' then adj_low end as adj_low,
               case when dt >= date '2000-01-01' then adj_close end as adj_close from adjusted""",
    # membership
    "normalise_changes": "select index_name, seq, symbol, change_type, dt from normalised",
    "unmapped_scrips": "select distinct scrip from index_feed where scrip not in (select scrip from scrip_map)",
    "index_snapshots": "select * from snapshots",
    "change_history": "select * from snapshots where index_name = '1-URGENT'",
    "change_dates": "select dt from urgent_days",
    "snapshots_from": """
        select s.* from snapshots s join (
            select index_name, coalesce(max(dt) filter (where dt < date '1998-01-01'), min(dt)) as first_dt
            from snapshots group by index_name) f on f.index_name = s.index_name and s.dt >= f.first_dt""",
    "membership_flags": "select * from wide_flags where dt >= date '1996-01-01'",
    "current_flags": "select k.symbol, k.dt, "
    + ", ".join(
        f"""cast(exists (select 1 from index_current c where c.index_name = '{i}' and c.symbol = k.symbol) as integer) as "{i}\""""
        for i in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " from kept k where k.dt >= date '2000-01-01'",
    "check_change_dates": """
        select c.change_type, c.symbol, coalesce(g.start_dt, date '9999-01-01') as range_start,
               coalesce(g.end_dt, date '9999-01-01') as range_end,
               case when g.symbol is null then 'Not Found' else 'Found out of Range' end as found,
               c.dt as search_dt, c.index_name,
               cast(greatest(0, coalesce(g.start_dt, date '9999-01-01') - c.dt) as integer) as diff_before,
               cast(greatest(0, c.dt - coalesce(g.end_dt, date '9999-01-01')) as integer) as diff_after
        from normalised c
        left join (select symbol, min(dt) as start_dt, max(dt) as end_dt from kept group by symbol) g using (symbol)
        where not exists (select 1 from kept k where k.symbol = c.symbol and k.dt = c.dt)
          and (g.symbol is null or not (g.start_dt < c.dt and c.dt < g.end_dt))""",
    "last_change": """
        select index_name, symbol, dt, change_type from (
            select *, row_number() over (partition by index_name, symbol order by dt desc, seq desc) as n
            from index_changes) where n = 1""",
    "membership_recon": """
        with last_in as (
            select index_name, symbol from (
                select *, row_number() over (partition by index_name, symbol order by dt desc, seq desc) as n
                from index_changes) where n = 1 and change_type = 'I')
        select *, 'last include not current' as side from (select * from last_in except select * from index_current)
        union all
        select *, 'current not last include' from (
            select * from index_current where index_name in (select index_name from index_changes)
            except select * from last_in)""",
    "flags_recon": _recon(""),
    "flags_recon_until": _recon("year(dt) <= 1998"),
    # exports
    "export_raw": f"select {_BAR} from kept where dt >= date '1996-06-01'",
    "export_adjusted": """
        select concat(symbol, '.A') as symbol, dt,
               case when adj_open is null then open else adj_open end as open,
               case when adj_open is null then high else adj_high end as high,
               case when adj_open is null then low else adj_low end as low,
               case when adj_open is null then close else adj_close end as close, volume
        from adjusted where dt >= date '1996-06-01'""",
    "export_flags": """
        select concat(symbol, '.URG') as symbol, dt, 0 as open, 0 as high, 0 as low, 1 as close, "1-URGENT"
        from wide_flags where dt >= date '1996-06-01'""",
    "export_flags_delta": """
        select concat(k.symbol, '.URG') as symbol, k.dt, 0 as open, 0 as high, 0 as low, 1 as close,
               case when c.symbol is null then 0 else 1 end as "1-URGENT"
        from kept k left join (select distinct symbol from index_current where index_name = '1-URGENT') c
          on c.symbol = k.symbol where k.dt >= date '2001-08-15'""",
    # history
    "buffer_flag": """
        select symbol, dt, case when dt < date '1997-01-01' then true end as buffer
        from kept where dt between date '1996-07-01' and date '2001-06-30'""",
    "index_markers": "select * from markers",
    "index_flag": "select symbol, dt, flag as idxflag from urgent_flags",
    "index_flag_exact": """
        select b.symbol, b.dt, coalesce(
                   last_value(m.flag ignore nulls) over (
                       partition by b.symbol order by b.dt rows between unbounded preceding and current row),
                   s.flag, 0) as idxflag
        from (select symbol, dt from kept where dt between date '1996-07-01' and date '2001-06-30') b
        left join markers m on m.symbol = b.symbol and m.dt = b.dt
        left join (select symbol, arg_max(flag, dt) as flag from markers where dt < date '1996-07-01'
                   group by symbol) s on s.symbol = b.symbol""",
    "split_history": """
        select k.symbol, k.dt, coalesce(m.multiplier, 0.0) as split
        from kept k left join multipliers_raw m on m.symbol = k.symbol and m.dt = k.dt""",
    "symbol_history": "select * from served",
    "index_history": """
        select * from served where symbol in (select symbol from served where idxflag = 1)""",
    "history_by_symbol": f"""{_HISTORY} from adjusted a
        where a.dt between date '1996-07-01' and date '2001-06-30' and symbol in ('S1', 'S7', 'S50')""",
    "slice_history": f"{_HISTORY} from adjusted a where a.dt between date '1998-02-01' and date '2000-11-30'",
    # reports
    "symbol_counts": """
        select symbol, count(distinct dt) as day_count, min(dt) as min_dt, max(dt) as max_dt
        from bars_raw group by symbol""",
    "year_totals": f"""
        select cast(year(dt) as integer) as year, count(*) as row_count, {_SUMS},
               cast(sum(volume) as bigint) as volume_sum from adjusted group by 1""",
    "year_totals_diff": f"""
        select year, metric, diff from (
            unpivot (select year, r.row_count - m.row_count as row_count, r.open_sum - m.open_sum as open_sum,
                            r.high_sum - m.high_sum as high_sum, r.low_sum - m.low_sum as low_sum,
                            r.close_sum - m.close_sum as close_sum, r.volume_sum - m.volume_sum as volume_sum
                     from ({_totals('kept', 'true')}) r join ({_totals('modified', 'n = 1')}) m using (year))
            on row_count, open_sum, high_sum, low_sum, close_sum, volume_sum into name metric value diff)
        where diff <> 0""",
    "year_counts": "select cast(year(dt) as integer) as year, count(*) as row_count from kept group by 1",
    "distinct_symbols": "select distinct coalesce(r.new, b.symbol) as symbol from bars_raw b left join renames r on r.old = b.symbol",
    # dates
    "calendar": """
        select dt from (select cast(unnest(generate_series(min(dt), max(dt), interval 1 day)) as date) as dt from bars_raw)
        where isodow(dt) < 6""",
    "missing_dates": """
        select dt from (select cast(unnest(generate_series(min(dt), date '2001-12-31', interval 1 day)) as date) as dt
                        from index_changes)
        where isodow(dt) < 6 and dt not in (select dt from index_changes)""",
    "date_functions": """
        select seq, symbol, dt as d, strftime(dt, '%d%m%y') as ddmmyy, strftime(dt, '%d%m%Y') as ddmmyyyy,
               upper(strftime(dt, '%d%b%Y')) as ddmmmyyyy, strftime(dt, '%Y') as yyyy,
               cast(month(dt) as integer) as mm_int, upper(strftime(dt, '%b')) as mmm,
               cast(isodow(dt) - 1 as integer) as weekday, dayname(dt) as dayofweek,
               cast(dt + interval 9 month + interval 10 day as date) as relativedate,
               try_cast(concat('2001-', strftime(dt, '%m'), '-31') as date) as setdate,
               cast(dt - date '1996-02-29' as integer) as datediff, dt as todate,
               strftime(dt, '%Y%m%d') as iso_to_compact, strftime(dt, '%Y-%m-%d') as compact_to_iso,
               strftime(dt, '%Y/%m/%d') as us_to_ymd,
               concat(case when dayofyear(dt) % 100 > 60 then '19' else '20' end,
                      lpad(cast(dayofyear(dt) % 100 as string), 2, '0'), strftime(dt, '-%m-%d')) as pivoted,
               strftime(dt, '%Y-%m-%d') as from_ddmmmyyyy, strftime(dt, '%Y-%m-%d') as from_dd_mmm_yyyy,
               strftime(dt, '%Y-%m-%d') as from_ddmmyyyy, strftime(dt, '%Y%m%d') as from_dd_mm_yyyy,
               strftime(dt, '%m') as mm_full, case when month(dt) <> 2 then strftime(dt, '%m') end as mm_short,
               monthname(dt) as month_name,
               case when month(dt) <= 10 then upper(strftime(dt + interval 2 month, '%b')) end as month_later
        from bars_raw""",
}

_CHECKED = """
        select count(*) from index_changes c
        left join (select symbol, min(dt) as start_dt, max(dt) as end_dt from modified group by symbol) g using (symbol)
        where not exists (select 1 from modified m where m.symbol = c.symbol and m.dt = c.dt)
          and (g.symbol is null or not (g.start_dt < c.dt and c.dt < g.end_dt))"""
_REPORTS = {
    "unverified": "select count(*) from scores where neighbours = 0",
    "replaceable_selected": f"select count(*) from scores where {_BETTER}",
    "replaceable_skipped": f"select count(*) from scores where {_BETTER}",
    "replacements_refused": "select 0",
    "symbol_range": "select (select count(distinct symbol) from kept) + (select count(distinct symbol) from modified)",
    "range_anomalies": "select 0",
    "modified_losers": "select count(*) from modified where n > 1",
    "multipliers_skipped": """
        select count(*) from (
            select coalesce(r.new, m.symbol) as symbol, m.dt from multipliers_raw m left join renames r on r.old = m.symbol) c
        where coalesce(c.dt < coalesce((select min(dt) from modified g where g.symbol = c.symbol),
                                       (select min(dt) from kept k where k.symbol = c.symbol)), true)""",
    "year_totals": "select count(distinct year(dt)) from kept",
    "year_totals_modified": "select count(distinct year(dt)) from modified",
    "year_totals_diff": f"select count(*) from ({ORACLES['year_totals_diff']})",
    "index_changes": "select count(*) from index_changes",
    "change_dates_check": _CHECKED,
    "symbol_counts": "select count(distinct symbol) from kept",
}
ORACLES["reports_written"] = (
    "select report, rows as written, rows as read_back from ("
    + " union all ".join(f"select '{name}' as report, cast(({sql}) as bigint) as rows" for name, sql in _REPORTS.items())
    + """ union all select concat('flags_', cast(year(dt) as string)), count(*) from modified
          where n = 1 and year(dt) >= 1996 group by 1)"""
)


def _mentions(text, name):
    return re.search(rf"\b{name}\b", text) is not None


def oracle(name) -> str:
    """The query with the views and steps it needs, in order, in front."""
    body = ORACLES[name]
    needed, frontier = set(), body
    parts = {**{v: duckdb_view(v) for v in VIEWS}, **STEPS}
    for step in reversed(list(parts)):
        if _mentions(frontier, step):
            needed.add(step)
            frontier += "\n" + parts[step]
    ctes = ", ".join(f"{step} as ({parts[step]})" for step in parts if step in needed)
    if body.lstrip().startswith("with "):
        return f"with {ctes}, {body.lstrip()[5:]}"
    return f"with {ctes} {body}"
