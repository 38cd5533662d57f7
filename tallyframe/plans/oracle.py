"""Independent DuckDB SQL for every query key (the correctness oracle).

Written from the operator semantics, not from the Spark code.  Counts are
cast to BIGINT (DuckDB sums integers to HUGEINT), shares are exact integer
millionths (no double rounding in the comparison).
"""

from __future__ import annotations

from .. import config as C
from . import proxy as P


def _in(values) -> str:
    return "(" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in values) + ")"


def _list(values) -> str:
    return "[" + ", ".join(str(v) for v in values) + "]"


def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TARGETS = _in(P.PROXY_TARGET_CODES)

BASE = """base as (
  select cast(year(o_orderdate) as bigint) yr, cast(n_nationkey as bigint) geo, n_name geo_name,
         p_brand opt, o_orderkey station, o_custkey commune, o_orderstatus st, o_orderpriority pri,
         cast(l_quantity as bigint) q, cast(l_linenumber as bigint) ln, l_partkey partkey,
         l_suppkey suppkey, l_shipdate shipdate
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey join part on l_partkey = p_partkey)"""

TOTALS = """totals as (
  select yr, geo, geo_name, cast(sum(q) as bigint) eligible,
         cast(sum(case when st <> 'P' then q else 0 end) as bigint) cast_n,
         cast(sum(case when st = 'F' then q else 0 end) as bigint) valid
  from base group by yr, geo, geo_name)"""

RESULTS = """results as (
  select t.yr, t.geo, t.geo_name, lpad(cast(t.geo as varchar), 2, '0') dept_code, v.opt, t.eligible,
         t.cast_n, t.valid, v.votes,
         (2 * v.votes * 1000000 + t.valid) // (2 * t.valid) micro_share,
         (2 * t.cast_n * 1000000 + t.eligible) // (2 * t.eligible) micro_turnout
  from totals t join (select yr, geo, opt, cast(sum(q) as bigint) votes from base
                      where st = 'F' group by yr, geo, opt) v
  on t.yr = v.yr and t.geo = v.geo)"""

R3 = [BASE, TOTALS, RESULTS]

LINES = """lines as (
  select *, row_number() over (partition by station order by ln, partkey, suppkey) - 1 rn from base)"""
STN = """stn as (
  select station, commune, geo, geo_name, cast(sum(q) as bigint) reg,
         cast(sum(case when st <> 'P' then q else 0 end) as bigint) cst,
         cast(sum(case when st = 'F' then q else 0 end) as bigint) val, bool_or(pri = '1-URGENT') urgent
  from base group by station, commune, geo, geo_name)"""
ROWS = """srows as (
  select c.station, c.chunk, c.n_groups, s.commune, s.geo, s.geo_name, s.reg, s.cst, s.val,
         unnest(case when s.urgent then [0, 1] else [0] end) copy
  from (select station, rn // 3 chunk, count(*) n_groups from lines group by station, rn // 3) c
  join stn s on c.station = s.station)"""
GROUPS = """sgroups as (
  select l.station, l.geo, l.opt, l.ln, l.q, unnest(case when s.urgent then [0, 1] else [0] end) copy
  from lines l join stn s on l.station = s.station where l.ln % 4 <> 0)"""
STATION = [BASE, LINES, STN]

OFACTS = """ofacts as (
  select cast(year(o_orderdate) as bigint) yr, cast(n_nationkey as bigint) geo, o_orderstatus st,
         o_orderpriority pri, o_totalprice price
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""
_VAR = " ".join(f"when {_sq(k)} then {_sq(v)}" for k, v in P.VARIABLE_BY_PRIORITY.items())
IAGG = f"""iagg as (
  select geo, pri, st, pyr as yr, cast(sum(cast(price as decimal(18,2))) as decimal(18,2)) v,
         cast(geo as varchar) codgeo, case pri {_VAR} end variable,
         case st when 'F' then 'total' when 'P' then ' total ' else null end sous_champ,
         geo * 100 + cast(substr(pri, 1, 1) as int) * 10 + case st when 'F' then 0 when 'O' then 1 else 2 end ordinal
  from (select *, yr - (yr - 1) % 2 as pyr from ofacts) o
  group by geo, pri, st, pyr)"""
CELLS = """cells as (
  select r.*, 'A' || p.yr period, replace(cast(i.v as varchar), '.', ',') raw
  from (select distinct codgeo, variable, sous_champ, ordinal from iagg) r
  cross join (select distinct yr - (yr - 1) % 2 yr from ofacts) p
  left join iagg i on i.ordinal = r.ordinal and i.yr = p.yr)"""
SPECS = "specs as (select * from (values " + ", ".join(
    f"({_sq(s[0])}, {_sq(s[3])}, {_sq(s[4]) if s[4] is not None else 'NULL'}, {i})"
    for i, s in enumerate(C.INDICATOR_SPECS)) + ") t(indicator_code, svar, ssc, spec_order))"
MATCH = """(w.variable = s.svar and ((s.ssc is null and w.sous_champ is null)
            or (s.ssc is not null and trim(coalesce(w.sous_champ, '')) = s.ssc)))"""
VALS = f"""vals as (
  select indicator_code, insee_code, year, value, source_file from (
    select s.indicator_code, lpad(cast(a.geo as varchar), 2, '0') || '000' insee_code, a.yr as year, a.v value,
           {_sq(C.INDICATOR_SOURCE_LABEL + ' (variable=')} || s.svar || coalesce(',sous_champ=' || s.ssc, '') || ')' source_file,
           row_number() over (partition by s.indicator_code, a.geo, a.yr order by s.spec_order desc, a.ordinal desc) rk
    from iagg a join specs s on {MATCH.replace('w.', 'a.')}) x where rk = 1)"""
IND = [OFACTS, IAGG, SPECS, VALS]


YEARS = "(select list(distinct year(o_orderdate)) from orders)"


def aligned(targets) -> str:
    targets = targets if isinstance(targets, str) else _list(targets)
    return f"""aligned as (
  select g.indicator_code, g.insee_code, cast(g.t as bigint) as year, v.value,
         case when v.year = g.t then v.source_file
              else v.source_file || ' [aligned_from=' || cast(v.year as varchar) || ']' end source_file
  from (select indicator_code, insee_code, unnest({targets}) t
        from (select distinct indicator_code, insee_code from vals)) g
  asof join vals v on g.indicator_code = v.indicator_code and g.insee_code = v.insee_code and g.t >= v.year)"""


TURN = """turn as (
  select yr, dept_code, geo_name, opt, micro_turnout from (
    select *, row_number() over (partition by yr, geo order by geo_name, opt) rk from results) x where rk = 1)"""

PARTY = """prow as (
  select yr, geo, opt candidate_name,
         case when geo % 2 = 0 then null when yr >= 2000 then 'Q' || cast(geo % 3 as varchar)
              else 'P' || cast(geo % 3 as varchar) end party_code from results)"""

LAGP = """lagp as (
  select yr, geo, opt, votes, lag(votes) over (partition by geo, opt order by yr) prediction from results)"""

LEAD = """lead1 as (
  select yr, geo, opt from (
    select *, row_number() over (partition by yr, geo order by votes desc, opt asc) rk from results) x
  where rk = 1)"""


def with_(*ctes) -> str:
    flat = []
    for c in ctes:
        flat.extend(c if isinstance(c, list) else [c])
    seen, out = set(), []
    for c in flat:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return "with " + ",\n".join(out) + "\n"


KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
QQ = "cast(l_quantity as bigint)"

ORACLE: dict[str, str] = {}

ORACLE["leader_per_group"] = with_(R3) + """
select yr, geo, geo_name, opt, votes, micro_share, micro_turnout
from (select *, row_number() over (partition by yr, geo order by votes desc, opt asc) rn from results) x
where rn = 1"""

ORACLE["scan_union_by_year"] = """
select cast(year(o_orderdate) as bigint) yr, count(*) n_orders,
       cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(18,2)) total_price
from orders group by 1"""

ORACLE["scan_station_rows"] = with_(STATION, ROWS) + """
select lpad(cast(geo as varchar), 2, '0') dept_code, cast(commune as varchar) commune,
       cast(station as varchar) bureau, reg registered, cst votes_cast, val votes_valid,
       cast(7 + 7 * n_groups as bigint) n_tokens
from srows"""

ORACLE["explode_groups"] = with_(STATION, GROUPS) + """
select cast(station as varchar) bureau, cast(ln as varchar) panel, upper(opt) candidate_name, q votes
from sgroups"""

ORACLE["rollup_station_totals"] = with_(STATION) + """
select lpad(cast(geo as varchar), 2, '0') dept_code, geo_name dept_name, cast(sum(reg) as bigint) registered,
       cast(sum(cst) as bigint) votes_cast, cast(sum(val) as bigint) votes_valid
from stn group by geo, geo_name"""

_CAND = """cand as (select geo, upper(opt) candidate_name, cast(sum(q) as bigint) votes from sgroups group by geo, opt)"""
_DTOT = """dtot as (select geo, cast(sum(reg) as bigint) reg, cast(sum(cst) as bigint) cst,
                     cast(sum(val) as bigint) val from stn group by geo)"""

ORACLE["rollup_candidate_votes"] = with_(STATION, GROUPS, _CAND) + """
select lpad(cast(geo as varchar), 2, '0') dept_code, candidate_name, votes from cand"""

ORACLE["share_of_total"] = with_(STATION, GROUPS, _CAND, _DTOT) + """
select lpad(cast(c.geo as varchar), 2, '0') dept_code, c.candidate_name, c.votes, d.val votes_valid,
       (2 * c.votes * 1000000 + d.val) // (2 * d.val) micro_share,
       (2 * d.cst * 1000000 + d.reg) // (2 * d.reg) micro_turnout
from cand c join dtot d on c.geo = d.geo"""

ORACLE["scan_indicator_filter"] = with_(OFACTS, IAGG, CELLS) + f"""
select lpad(codgeo, 2, '0') codgeo, variable, sous_champ, period, raw
from cells where lpad(codgeo, 2, '0') in {TARGETS}"""

ORACLE["scope_filter"] = with_(R3) + f"""
select yr, dept_code, opt candidate_name, votes from results where dept_code in {TARGETS}"""

ORACLE["series_select"] = with_(OFACTS, IAGG, CELLS, SPECS) + f"""
select s.indicator_code, lpad(w.codgeo, 2, '0') codgeo, w.sous_champ, w.period, w.raw
from cells w join specs s on {MATCH}"""

ORACLE["empty_specs"] = with_(OFACTS, IAGG, SPECS) + f"""
select indicator_code, svar variable from specs where indicator_code not in (
  select s.indicator_code from iagg w join specs s on {MATCH})"""

ORACLE["unpivot_periods"] = with_(OFACTS, IAGG) + """
select codgeo, variable, sous_champ, yr as year, v as value from iagg"""

ORACLE["dedupe_indicator_values"] = with_(IND) + """
select indicator_code, insee_code, year, value, source_file from vals"""

ORACLE["asof_align"] = with_(IND, aligned(P.PROXY_CALENDAR)) + """
select indicator_code, insee_code, year, value, source_file from aligned"""

ORACLE["asof_join_tables"] = f"""
with r as (select o_custkey, o_orderdate, max(o_orderkey) ok from orders group by o_custkey, o_orderdate),
p as (select {KEYS}, l_shipdate, o_custkey from lineitem join orders on l_orderkey = o_orderkey)
select p.l_orderkey, p.l_partkey, p.l_suppkey, p.l_linenumber, r.ok prev_orderkey, r.o_orderdate prev_orderdate
from p asof left join r on p.o_custkey = r.o_custkey and p.l_shipdate >= r.o_orderdate"""

ORACLE["normalize_key"] = """
select doc_id, regexp_replace(lower(strip_accents(coalesce(text, ''))), '[^a-z0-9]+', '', 'g') norm_key
from documents"""

ORACLE["canonical_label"] = r"""
select doc_id, upper(replace(trim(regexp_replace(strip_accents(replace(regexp_replace(
         replace(text, ' ', '_') || case when doc_id % 2 = 0 then '_VOIX' else '_exp' end,
         '_(VOIX|EXP)$', '', 'i'), '_', ' ')), '\s+', ' ', 'g')), 'ß', 'ss')) label
from documents"""

ORACLE["normalize_area_code"] = f"""
select {KEYS}, case ({QQ} + l_linenumber) % 6 when 3 then null
                    when 4 then cast({QQ} as varchar) || 'A'
                    else lpad(cast({QQ} as varchar), 2, '0') end code
from lineitem"""

ORACLE["parse_localized_int"] = f"""
select {KEYS}, cast(case ({QQ} + l_linenumber) % 5 when 0 then {QQ} + {QQ} % 2 when 1 then 1000 + {QQ}
                         when 2 then {QQ} when 3 then null else {QQ} * 100 end as bigint) value
from lineitem"""

ORACLE["parse_localized_float"] = f"""
select {KEYS}, cast(case ({QQ} + l_linenumber) % 4 when 0 then {QQ} + 0.25 when 1 then 1000 + {QQ} + 0.5
                         when 2 then {QQ} else -10 * {QQ} end as double) value
from lineitem"""

ORACLE["parse_ratio"] = f"""
select {KEYS}, cast(round(cast(l_extendedprice as decimal(18,2)) * 0.01, 6) as decimal(18,6)) ratio
from lineitem"""

ORACLE["turnout_rate"] = with_(BASE, TOTALS) + """
select yr, geo, (2 * cast_n * 1000000 + eligible) // (2 * eligible) micro_turnout from totals"""

ORACLE["turnout_rate_scaled"] = with_(BASE, TOTALS) + """
select yr, geo, cast((2 * (cast(cast_n as hugeint) * 1000000 + 1) * 1000000 + (cast(eligible as hugeint) * 1000000 + 7))
       // (2 * (cast(eligible as hugeint) * 1000000 + 7)) as bigint) micro_turnout from totals"""

ORACLE["abstention_rate"] = with_(BASE, TOTALS) + """
select yr, geo, 1000000 - (2 * cast_n * 1000000 + eligible) // (2 * eligible) micro_abstention from totals"""

ORACLE["backfill_votes_share"] = with_(R3) + """
select yr, geo, opt,
       case when votes % 3 <> 0 then votes
            else cast(round_even(valid * (micro_share / 1e6), 0) as bigint) end votes,
       micro_share
from results where votes % 5 <> 0 or votes % 3 <> 0"""

ORACLE["name_fallback"] = """
select c_custkey, coalesce(nullif(trim(name), ''), n.n_name, lpad(cast(c.c_nationkey as varchar), 2, '0')) display_name
from (select c_custkey, c_nationkey,
             case when c_custkey % 7 = 0 then ' ' when c_custkey % 11 = 0 then null else c_name end name
      from customer) c
left join (select * from nation where n_name not like '%3') n on c.c_nationkey = n.n_nationkey"""

ORACLE["lookup_by_normalized_name"] = """
with x as (
  select c_custkey, case c_custkey % 4 when 0 then lower(n_name) when 1 then replace(n_name, '_', ' ')
                    when 2 then ' ' || replace(n_name, 'NATION', 'Nätion') || '!' else n_name || '_X' end mangled
  from customer join nation on c_nationkey = n_nationkey),
lk as (select regexp_replace(lower(strip_accents(n_name)), '[^a-z0-9]+', '', 'g') k,
              lpad(cast(n_nationkey as varchar), 2, '0') code from nation)
select c_custkey, mangled, lk.code
from x left join lk on regexp_replace(lower(strip_accents(mangled)), '[^a-z0-9]+', '', 'g') = lk.k"""

ORACLE["geo_key_roundtrip"] = """
select c_custkey, lpad(cast(c_nationkey as varchar), 2, '0') || '000' insee_code,
       lpad(cast(c_nationkey as varchar), 2, '0') dept_code
from customer"""

ORACLE["storage_decimal"] = with_(R3) + """
select yr, dept_code, opt candidate_name, cast(((micro_share + 5) // 10) / 1e5 as decimal(6,5)) share_5dp
from results"""

ORACLE["election_dim"] = f"""
with d as (select year(o_orderdate) y, min(cast(o_orderdate as date)) election_date from orders group by 1)
select row_number() over (order by election_date) election_id, {_sq(C.ELECTION_TYPE)} election_type,
       election_date, cast({C.ELECTION_ROUND} as smallint) round, {_sq(C.ELECTION_SCOPE)} scope
from d"""

ORACLE["unpivot_pairs"] = with_(R3) + f"""
select yr, dept_code, upper(opt) candidate_name, votes, micro_share, micro_turnout
from results"""

ORACLE["unpivot_measures"] = with_(R3) + f"""
select yr, dept_code, geo_name dept_name, upper(opt) candidate_name, valid votes_valid,
       cast(round_even(valid * (micro_share / 1e6), 0) as bigint) votes, micro_share, micro_turnout
from results"""

_AREAS_YEARS = "(select distinct geo from totals) a cross join (select distinct year(o_orderdate) yr from orders) y"
ORACLE["pivot_matrix"] = with_(BASE, TOTALS) + f"""
select lpad(cast(a.geo as varchar), 2, '0') dept_code, cast(y.yr as varchar) yr, t.valid
from {_AREAS_YEARS} left join totals t on t.geo = a.geo and t.yr = y.yr"""

ORACLE["pivot_matrix_wide"] = ORACLE["pivot_matrix"]
ORACLE["pivot_matrix_sparse"] = """select cast(year(l_shipdate) as bigint) yr, l_partkey, cast(sum(cast(l_quantity as bigint)) as bigint) q
from lineitem group by 1, 2"""

ORACLE["collapse_duplicates"] = with_(R3) + """
select yr, dept_code, opt candidate_name, eligible registered, valid votes_valid,
       case when votes % 7 <> 0 then votes end votes, micro_share
from results"""

ORACLE["sum_min_count"] = with_(R3) + """
select yr, dept_code, opt candidate_name, case when votes % 7 <> 0 then votes end votes from results"""

ORACLE["recompute_share"] = with_(R3) + """
select yr, dept_code, opt candidate_name,
       case when votes % 9 <> 0 then micro_share when votes % 2 = 0 then 500000 else micro_share end micro_share
from results"""

ORACLE["run_stats"] = with_(R3) + """
select count(*) n_rows, count(distinct geo) n_keys, min(yr) min_period, max(yr) max_period,
       count(distinct yr) n_periods from results"""

ORACLE["distinct_sorted"] = with_(R3) + "select distinct yr from results"

ORACLE["describe_by_group"] = with_(R3) + """
select dept_code, count(votes) n, cast(round(avg(votes) * 1000) as bigint) mean_milli,
       cast(round(stddev_samp(votes) * 1000) as bigint) stddev_milli, min(votes) min_votes,
       cast(round(quantile_cont(votes, 0.5) * 1000) as bigint) median_milli, max(votes) max_votes
from results group by dept_code"""

ORACLE["describe_by_area_election"] = with_(R3) + """
select dept_code, yr, count(votes) n, cast(round(avg(votes) * 1000) as bigint) mean_milli,
       cast(round(quantile_cont(votes, 0.5) * 1000) as bigint) median_milli, min(votes) min_votes, max(votes) max_votes
from results group by dept_code, yr"""

ORACLE["histogram"] = with_(R3) + """
select cast(case when votes < 0 then 0 when votes >= 500 then (case when votes = 500 then 10 else 11 end)
            else floor(votes / 50) + 1 end as bigint) bin, count(*) n
from results group by 1"""

ORACLE["indicator_correlation"] = with_(R3) + """
select upper(opt) candidate_name, count(*) n,
       cast(round(corr(micro_turnout / 1e6, micro_share / 1e6) * 1000000) as bigint) corr_micro
from results group by opt"""
ORACLE["indicator_correlation"] = ORACLE["indicator_correlation"].replace("upper(opt)", "opt")

ORACLE["dedupe_keep_last"] = f"""
select {KEYS} from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_shipdate desc, l_partkey desc, l_suppkey desc) rn
  from lineitem) x where rn = 1"""

ORACLE["dropna_subset"] = with_(R3) + """
select yr, dept_code, opt candidate_name, micro_turnout from results where votes % 4 <> 0"""

ORACLE["first_non_null_per_key"] = with_(R3) + """
select yr, dept_code, opt candidate_name, micro_turnout from (
  select *, row_number() over (partition by yr, geo order by geo_name, opt) rk
  from results where votes % 4 <> 0) x where rk = 1"""

ORACLE["lag_features"] = with_(R3) + """
select yr, geo, opt, votes, lag(votes) over w votes_lag1, votes - lag(votes) over w votes_change
from results window w as (partition by geo, opt order by yr)"""

_CAT = [s for s in C.INDICATOR_SPECS if s[0] != "poverty_rate"]
ORACLE["resolve_indicator_key"] = with_(IND) + "select c.indicator_id, v.insee_code, v.year, v.value from vals v " \
    "join (values " + ", ".join(f"({i + 1}, {_sq(s[0])})" for i, s in enumerate(_CAT)) + \
    ") c(indicator_id, code) on v.indicator_code = c.code"

ORACLE["null_safe_join"] = with_(R3, PARTY) + """
select p.yr, p.geo, p.candidate_name, p.party_code, d.candidate_id
from prow p join (
  select candidate_name, party_code,
         row_number() over (order by candidate_name, party_code nulls first) candidate_id
  from (select distinct candidate_name, party_code from prow)) d
on p.candidate_name = d.candidate_name and p.party_code is not distinct from d.party_code"""

ORACLE["assign_surrogate_keys"] = with_(R3, PARTY) + """,
cur as (select candidate_name, party_code,
               row_number() over (order by candidate_name, party_code nulls first) candidate_id
        from (select distinct candidate_name, party_code from prow where yr <= 1997)),
new as (select i.candidate_name, i.party_code
        from (select distinct candidate_name, party_code from prow where yr >= 1997) i
        where not exists (select 1 from cur c where c.candidate_name = i.candidate_name
                                                and c.party_code is not distinct from i.party_code))
select candidate_id, candidate_name, party_code from cur
union all
select (select max(candidate_id) from cur) + row_number() over (order by candidate_name, party_code nulls first),
       candidate_name, party_code from new"""
ORACLE["assign_surrogate_keys"] = ORACLE["assign_surrogate_keys"].replace("\n,\ncur as", ",\ncur as")

ORACLE["insert_ignore"] = """
select c_custkey, c_name name from customer where c_acctbal >= 0
union all
select c_custkey, lower(c_name) name from customer where c_acctbal < 0"""

ORACLE["upsert"] = """
select c_custkey, c_name name from customer
where c_acctbal >= 0 and c_mktsegment not in ('BUILDING', 'MACHINERY')
union all
select c_custkey, lower(c_name) name from customer where c_mktsegment in ('BUILDING', 'MACHINERY')"""

ORACLE["replace_slice"] = with_(R3) + f"""
select yr, dept_code, opt candidate_name, votes from results
where yr <= 1999 and not (yr >= 1998 and dept_code in {TARGETS})
union all
select yr, dept_code, opt candidate_name, votes + 1 votes from results where yr >= 1998 and dept_code in {TARGETS}"""

ORACLE["turnout_indicator"] = with_(R3, TURN) + f"""
select dept_code || '000' insee_code, yr as year, micro_turnout micro_value, {_sq(C.TURNOUT_SOURCE_FILE)} source_file
from turn
union all
select dept_code || '000' insee_code, yr - 10 as year, 0 micro_value, 'old' source_file from turn where yr <= 1997"""

ORACLE["reindex_left"] = with_(R3, IND) + f"""
select o.dept_code, v.value from (select distinct dept_code from results) o
left join (select substr(insee_code, 1, 2) dept_code, value from vals
           where indicator_code = 'unemployment_rate' and year = 2001
             and substr(insee_code, 1, 2) in {TARGETS}) v on o.dept_code = v.dept_code"""

ORACLE["fk_violations"] = with_(R3) + """
select yr, dept_code || '000' insee_code, opt candidate_name from results
where dept_code || '000' not in (
  select lpad(cast(s_nationkey as varchar), 2, '0') || '000' from supplier where s_acctbal > 5000)"""

ORACLE["pk_violations"] = """
select l_orderkey, l_linenumber, count(*) n from lineitem group by 1, 2 having count(*) > 1"""

ORACLE["unique_violations"] = with_(R3, PARTY) + """
select candidate_name, party_code, count(*) n from prow group by 1, 2 having count(*) > 1"""

ORACLE["null_violations"] = with_(R3) + """
select count(*) filter (where votes % 3 = 0) null_votes_in, count(*) filter (where votes % 5 = 0) null_share_in,
       cast(0 as bigint) null_opt from results"""

ORACLE["turnout_trend"] = with_(R3, TURN) + """
select dept_code, yr as year, micro_turnout micro_pct_turnout, dept_code || ' - ' || geo_name label from turn"""

ORACLE["leader_matrix"] = with_(R3) + f"""
select lpad(cast(a.geo as varchar), 2, '0') dept_code, cast(y.yr as varchar) yr, l.micro_share
from {_AREAS_YEARS.replace('totals', 'results')}
left join (select *, row_number() over (partition by yr, geo order by micro_share desc, opt asc) rk from results) l
on l.rk = 1 and l.geo = a.geo and l.yr = y.yr"""

ORACLE["indicator_trend"] = with_(R3, IND, aligned(YEARS)) + """
select substr(insee_code, 1, 2) dept_code, "year", value from aligned where indicator_code = 'unemployment_rate'
  and substr(insee_code, 1, 2) in (select dept_code from results)"""

ORACLE["latest_snapshot"] = with_(R3, IND) + """
select o.dept_code, v.year, v.value from (select distinct dept_code from results) o
join (select substr(insee_code, 1, 2) dept_code, year, value from vals
      where indicator_code = 'poverty_rate'
        and year = (select max(year) from vals where indicator_code = 'poverty_rate')) v
on o.dept_code = v.dept_code"""

ORACLE["quality_report"] = with_(R3) + """
select count(*) n_rows, count(*) filter (where votes % 3 = 0) null_votes_in,
       count(*) filter (where votes % 5 = 0) null_share_in,
       count(*) filter (where votes % 5 <> 0 and micro_share > 100000) out_of_bounds_share_in,
       (select cast(coalesce(sum(n), 0) as bigint) from (select count(*) n from results group by yr, geo) g
        where n > 1) dup_rows,
       (select count(*) from (select count(*) n from results group by yr, geo) g where n > 1) dup_keys
from results"""

_FLAWED = [*R3, """flawed as (select yr, geo, opt, valid, cast_n, eligible, case when votes % 11 = 0 then valid + 1 else votes end votes,
  case when votes % 5 <> 0 then micro_share end share, case when geo = 3 then ' ' when geo <> 5 then geo_name end source from results)""",
           """broken as (select 'share_present' rule, 'missing' kind, concat_ws('|', yr, geo, opt) as "key", 1 n from flawed where share is null
  union all select 'share_filled', 'completeness', concat_ws('|', yr, geo, opt), 1 from flawed where share is null
  union all select 'share_range', 'bounds', concat_ws('|', yr, geo, opt), 1 from flawed where share < 30000 or share > 50000
  union all select 'counts_ordered', 'coherence', concat_ws('|', yr, geo, opt), 1 from flawed where votes > valid or valid > cast_n or cast_n > eligible
  union all select 'has_source', 'traceability', concat_ws('|', yr, geo, opt), 1 from flawed where source is null or trim(source) = ''
  union all select 'votes_differ', 'duplicates', concat_ws('|', yr, geo, votes), count(*) from flawed group by yr, geo, votes having count(*) > 1
  union all select 'votes_add_up', 'coherence', concat_ws('|', yr, geo), count(*) from flawed group by yr, geo having sum(votes) <> max(valid))"""]
ORACLE["quality_violations"] = with_(_FLAWED) + 'select rule, kind, "key", cast(n as bigint) n from broken'
ORACLE["quality_rules"] = with_(_FLAWED) + """
select r.rule, r.kind, case when r.rule = 'votes_add_up' then (select count(*) from (select distinct yr, geo from flawed)) else (select count(*) from flawed) end n_checked,
  cast(coalesce(b.n, 0) as bigint) n_violations,
  case when r.rule = 'share_filled' then (select count(share) >= 0.85 * count(*) from flawed) else coalesce(b.n, 0) = 0 end passed
from (values ('votes_differ', 'duplicates'), ('share_present', 'missing'), ('share_range', 'bounds'), ('share_filled', 'completeness'),
  ('counts_ordered', 'coherence'), ('votes_add_up', 'coherence'), ('has_source', 'traceability')) r(rule, kind)
left join (select rule, case when rule = 'votes_add_up' then count(*) else sum(n) end n from broken group by rule) b on r.rule = b.rule"""

ORACLE["quality_bounds"] = with_(R3) + """
select yr, count(*) n_rows, count(*) filter (where micro_share > 100000) share_high,
       count(*) filter (where micro_turnout < 400000 or micro_turnout > 800000) turnout_out
from results group by yr"""

ORACLE["quality_coherence"] = with_(R3) + """
select yr, cast(count(*) as bigint) n_rows, count(*) filter (where v > valid) votes_over_valid,
       count(*) filter (where valid > cast_n) valid_over_cast_n, count(*) filter (where cast_n > eligible) cast_n_over_eligible,
       count(distinct case when s <> valid then geo end) sum_mismatch
from (select *, sum(v) over (partition by yr, geo) s
      from (select *, case when votes % 11 = 0 then valid + 1 else votes end v from results) a) b
group by yr"""

ORACLE["completeness"] = with_(R3) + """
select yr, (2 * count(*) filter (where votes % 3 <> 0) * 1000000 + count(*)) // (2 * count(*)) micro_filled_votes_in,
       (2 * count(*) filter (where votes % 5 <> 0) * 1000000 + count(*)) // (2 * count(*)) micro_filled_share_in,
       1000000::bigint micro_filled_opt
from results group by yr"""

ORACLE["traceability"] = with_(IND) + """
select indicator_code, count(*) n_rows, count(*) filter (where insee_code in ('03000', '05000')) n_untraced
from vals group by 1"""

ORACLE["coverage_gaps"] = with_(IND) + f"""
select g.indicator_code, g.insee_code, cast(g.year as bigint) as year
from (select indicator_code, insee_code, unnest({YEARS}) as year
      from (select distinct indicator_code, insee_code from vals)) g
where not exists (select 1 from vals v where v.indicator_code = g.indicator_code
                  and v.insee_code = g.insee_code and v.year = g.year)"""

_PIV = "piv as (select insee_code, year, " + ", ".join(
    f"max(case when indicator_code = {_sq(s[0])} then value end) {s[0]}" for s in C.INDICATOR_SPECS
) + " from aligned group by insee_code, year)"
ORACLE["feature_join"] = with_(R3, IND, aligned(YEARS), _PIV) + "select r.yr, r.geo, r.opt, r.micro_share, " + \
    ", ".join(f"p.{s[0]}" for s in C.INDICATOR_SPECS) + \
    " from results r left join piv p on r.dept_code || '000' = p.insee_code and r.yr = p.year"

_CODES = [s[0] for s in C.INDICATOR_SPECS]
ORACLE["training_set"] = with_(R3, IND, aligned(YEARS), _PIV) + f"""
select r.yr, r.geo, r.opt, r.micro_share, r.l1 micro_share_lag1, r.l2 micro_share_lag2, r.micro_share - r.l1 micro_share_change,
       {", ".join(f"p.{c}" for c in _CODES)}
from (select *, lag(micro_share) over w l1, lag(micro_share, 2) over w l2 from results
      window w as (partition by geo, opt order by yr)) r
left join piv p on r.dept_code || '000' = p.insee_code and r.yr = p.year"""

ORACLE["indicator_correlations"] = with_(R3, IND, aligned(YEARS)) + """
select opt, indicator_code, count(*) n,
       cast(round(case when isfinite(c) then c end * 10000) as bigint) corr_e4
from (select opt, indicator_code, count(*) n0, corr(cast(value as double), micro_share / 1e6) c, unnest(range(count(*))) u
      from results r join aligned a on r.dept_code || '000' = a.insee_code and r.yr = a.year group by 1, 2) x
group by opt, indicator_code, c"""

ORACLE["fit_lag_regressor"] = with_(R3, LAGP) + """
select yr, geo, opt, votes, prediction lag_votes,
       cast(round((select regr_intercept(votes, prediction) + 0 from fit) * 100
                  + (select regr_slope(votes, prediction) from fit) * prediction * 100) as bigint) prediction_centi
from lagp where prediction is not null and yr = (select max(year(o_orderdate)) from orders)"""
ORACLE["fit_lag_regressor"] = ORACLE["fit_lag_regressor"].replace("\nselect yr, geo, opt, votes, prediction", """,
fit as (select votes, prediction from lagp where prediction is not null and yr < (select max(year(o_orderdate)) from orders))
select yr, geo, opt, votes, prediction""", 1)


# ---- least squares from normal equations, written out: gram -> centred products -> Gauss-Jordan, one CTE a step
_FEATURES = ["l1", *_CODES]
_K = len(_FEATURES)
_PAIRS = [(i, j) for i in range(_K + 1) for j in range(i, _K + 1)]
_MASKS = {"history": [0], "indicators": list(range(1, _K)), "full": list(range(_K))}


def _trows(where: str = "l1 is not null") -> str:
    cols = ", ".join(f"cast({c} as decimal(18,2)) v{i}" for i, c in enumerate(["l1", *[f"p.{c}" for c in _CODES], "micro_share"]))
    return f"""trows as (select r.yr, r.geo, r.opt, r.micro_share, {cols}
  from (select *, lag(micro_share) over (partition by geo, opt order by yr) l1 from results) r
  left join piv p on r.dept_code || '000' = p.insee_code and r.yr = p.year where {where})"""


TRAIN = [*R3, *IND, aligned(YEARS), _PIV]
_LAST = "(select max(year(o_orderdate)) from orders)"


def least_squares(src: str, by: str, masks: dict[str, list[int]] | None = None) -> list[str]:
    """CTEs from `src` (by, v0..vk; vk is the label) to `fit` (by, model, n, c0.., m0.., icpt, rss, ncoef)."""
    masks = masks or {"linear": list(range(_K))}
    g = f"{by}, " if by else ""
    group = f" group by {by}" if by else ""
    sums = ", ".join(
        f"count(case when v{i} is not null and v{j} is not null then 1 end) n{i}_{j}, "
        f"coalesce(cast(sum(case when v{j} is not null then v{i} end) as double), 0) x{i}_{j}, "
        f"coalesce(cast(sum(case when v{i} is not null then v{j} end) as double), 0) y{i}_{j}, "
        f"coalesce(cast(sum(v{i} * v{j}) as double), 0) q{i}_{j}" for i, j in _PAIRS)
    out = [f"gsum as (select {g}{sums} from {src}{group})",
           f"gmean as (select *, " + ", ".join(f"case when n{i}_{i} > 0 then x{i}_{i} / n{i}_{i} else 0 end m{i}" for i in range(_K + 1))
           + f" from gsum where n{_K}_{_K} > 0)"]
    centred = {(i, j): f"(q{i}_{j} - m{j} * x{i}_{j} - m{i} * y{i}_{j} + n{i}_{j} * m{i} * m{j})" for i, j in _PAIRS}
    out.append(f"gprod as (select *, " + ", ".join(
        (f"case when {centred[i, j]} > 1e-12 * q{i}_{j} then {centred[i, j]} else 0 end" if i == j else centred[i, j]) + f" p{i}_{j}"
        for i, j in _PAIRS) + " from gmean)")
    masked = ", ".join("(" + _sq(name) + ", " + ", ".join(str(int(i in used)) for i in range(_K)) + ")" for name, used in masks.items())

    def start(i, j):
        a, b = min(i, j), max(i, j)
        scale = f"sqrt(p{i}_{i})" + ("" if j == _K else f" * sqrt(p{j}_{j})")
        use = f"u{i}" + ("" if j == _K else f" * u{j}")
        return f"case when p{i}_{i} > 0" + ("" if j == _K else f" and p{j}_{j} > 0") + f" then {use} * p{a}_{b} / ({scale}) else 0 end a{i}_{j}"

    out.append("t0 as (select *, " + ", ".join(start(i, j) for i in range(_K) for j in range(_K + 1))
               + f" from gprod cross join (values {masked}) k(model, " + ", ".join(f"u{i}" for i in range(_K)) + "))")
    for k in range(_K):
        cells = []
        for i in range(_K):
            for j in range(_K + 1):
                swept = f"a{k}_{j} / a{k}_{k}" if i == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k}"
                gone = "0" if i == k or j == k else f"a{i}_{j}"
                cells.append(f"case when a{k}_{k} < 1e-8 then {gone} else {swept} end as a{i}_{j}")
        out.append(f"t{k + 1} as (select * replace ({', '.join(cells)}) from t{k})")
    coefs = ", ".join(f"case when p{i}_{i} > 0 then a{i}_{_K} / sqrt(p{i}_{i}) else 0 end c{i}" for i in range(_K))
    ncoef = " + ".join(f"case when a{i}_{i} > 0.5 then 1 else 0 end" for i in range(_K))
    out.append(f"tc as (select *, {coefs}, {ncoef} ncoef from t{_K})")
    shift = " - ".join(f"c{i} * m{i}" for i in range(_K))
    explained = " - ".join(f"c{i} * p{i}_{_K}" for i in range(_K))
    out.append(f"fit as (select {g}model, n{_K}_{_K} n, " + ", ".join(f"c{i}, m{i}" for i in range(_K))
               + f", m{_K} - {shift} icpt, greatest(p{_K}_{_K} - {explained}, 0) rss, ncoef from tc)")
    return out


_PREDICT = "icpt + " + " + ".join(f"c{i} * coalesce(cast(v{i} as double), m{i})" for i in range(_K))
_SPLIT = [*TRAIN, _trows(), f"train as (select * from trows where yr < {_LAST})"]
ORACLE["fit_regressors"] = with_(_SPLIT, least_squares("train", "")) + f"""
select yr, geo, opt, micro_share, cast(round(({_PREDICT}) * 1000) as bigint) prediction_milli
from trows, fit where yr = {_LAST}"""
ORACLE["fit_regressors_by_area"] = with_(_SPLIT, least_squares("train", "geo")) + f"""
select yr, t.geo, opt, micro_share, cast(round(({_PREDICT}) * 1000) as bigint) prediction_milli
from trows t join fit f on t.geo = f.geo where yr = {_LAST}"""

_VARS = ["micro_share", "micro_share_lag1", *_CODES]
_PLACE = [f"v{_K}", *[f"v{i}" for i in range(_K)]]
ORACLE["correlation_matrix"] = with_(TRAIN, _trows("true")) + " union all ".join(
    f"""select geo, {_sq(_VARS[i])} x, {_sq(_VARS[j])} y, count(case when {_PLACE[i]} is not null and {_PLACE[j]} is not null then 1 end) n,
       cast(round(case when isfinite(corr(cast({_PLACE[i]} as double), cast({_PLACE[j]} as double)))
                       then corr(cast({_PLACE[i]} as double), cast({_PLACE[j]} as double)) end * 10000) as bigint) corr_e4
from trows group by geo""" for i in range(len(_VARS)) for j in range(i + 1, len(_VARS)))

# every window's training rows are joined anew: all rows of the years before
_WINDOWS = [*TRAIN, _trows(), """periods as (select yr w from (select distinct yr from trows)
  where (select count(distinct yr) from trows t where t.yr < periods0.yr) >= 2)""".replace(
    "(select distinct yr from trows)", "(select distinct yr from trows) periods0"),
    "train as (select p.w, t.* from trows t join periods p on t.yr < p.w)"]
_WPRED = [*_WINDOWS, *least_squares("train", "w", _MASKS),
          f"wpred as (select model, yr, geo, opt, micro_share, {_PREDICT} pred from trows t join fit f on t.yr = f.w)"]
_METRICS = [*_WPRED, """wall as (select * from wpred union all
  select 'persistence', yr, geo, opt, micro_share, cast(v0 as double) from trows where yr in (select w from periods))""",
            """metrics as (select model, yr period, count(*) n, avg(abs(micro_share - pred)) mae, sqrt(avg((micro_share - pred) * (micro_share - pred))) rmse,
  1 - sum((micro_share - pred) * (micro_share - pred)) / (sum(cast(micro_share as double) * micro_share) - sum(cast(micro_share as double)) * sum(cast(micro_share as double)) / count(*)) r2
  from wall group by 1, 2)"""]
ORACLE["compare_models"] = with_(_METRICS) + """
select model, period, n, cast(round(mae * 1000) as bigint) mae_milli, cast(round(rmse * 1000) as bigint) rmse_milli,
       cast(round(r2 * 1000) as bigint) r2_milli from metrics"""
ORACLE["choose_model"] = with_(_METRICS, """scores as (select model, count(*) n_windows, cast(round(avg(rmse) * 1000) as bigint) mean_rmse_milli,
  cast(round(stddev_pop(rmse) * 1000) as bigint) spread_rmse_milli, cast(round(max(rmse) * 1000) as bigint) worst_rmse_milli from metrics group by 1)""",
    """placed as (select s.*, mean_rmse_milli + spread_rmse_milli score_milli, i from scores s
  join (values ('persistence', 0), ('history', 1), ('indicators', 2), ('full', 3)) o(name, i) on s.model = o.name)""",
    "near as (select *, score_milli <= (select min(score_milli) from placed) * 1.05 close from placed)",
    "ranked as (select *, row_number() over (order by close desc, case when close then i end nulls first, score_milli, i) rk from near)") + """
select model, n_windows, mean_rmse_milli, spread_rmse_milli, worst_rmse_milli, score_milli, rk as rank, rk = 1 chosen from ranked"""

_QPRED = [*_WPRED, "qp as (select yr, geo, opt, micro_share, cast(round(pred * 1000) as bigint) predicted from wpred where model = 'full')"]


def _winners(src: str, option: str) -> str:
    return (f"select yr, geo, arg_max({option}, (micro_share, -ro)) actual, arg_max({option}, (predicted, -ro)) predicted "
            f"from (select *, rank() over (partition by yr, geo order by {option}) ro from {src}) group by yr, geo")


ORACLE["winner_accuracy"] = with_(_QPRED) + f"""
select yr, count(*) n, count(*) filter (where actual = predicted) n_correct from ({_winners("qp", "opt")}) group by yr"""


def _class(c: str) -> str:
    return f"case when {c} < 40000 then 'low' when {c} < 60000 then 'medium' else 'high' end"


ORACLE["confusion_matrix"] = with_(_QPRED, """blocs as (select yr, geo, left(opt, length(opt) - 1) bloc, cast(sum(micro_share) as bigint) micro_share,
  cast(sum(predicted) as bigint) predicted from qp group by 1, 2, 3)""", f"""pairs as (
  select 'winner' kind, actual, predicted from ({_winners("qp", "opt")})
  union all select 'bloc', actual, predicted from ({_winners("blocs", "bloc")})
  union all select 'class', {_class("micro_share")}, {_class("predicted / 1000.0")} from qp)""",
    "cells as (select kind, actual, predicted, count(*) n from pairs group by 1, 2, 3)",
    """per as (select *, cast(sum(n) over (partition by kind, actual) as bigint) n_actual,
  cast(sum(case when actual = predicted then n else 0 end) over (partition by kind, actual) as bigint) hit from cells)""") + """
select kind, actual, predicted, n, n_actual, (2 * hit * 1000000 + n_actual) // (2 * n_actual) micro_recall from per"""

_EFFECT = " + ".join(f"c{i}" + f" * (coalesce((select t.at0 + t.slope * (l.yr + h) from trends t where t.insee_code = l.insee_code and t.code = {_sq(c)}), m{i}))"
                     for i, c in enumerate(_FEATURES) if i)
ORACLE["scenario_shares"] = with_(TRAIN, _trows(), least_squares("trows", ""), """trends as (
  select insee_code, indicator_code code,
         case when count(distinct year) > 1 then regr_slope(cast(value as double), cast(year as double)) else 0 end slope,
         case when count(distinct year) > 1 then regr_intercept(cast(value as double), cast(year as double))
              else avg(cast(value as double)) end at0 from vals group by 1, 2)""",
    f"""last as (select yr, geo, opt, micro_share, dept_code || '000' insee_code from results where yr = {_LAST})""",
    "areas as (select distinct yr, insee_code from last)",
    *[f"u{h} as (select insee_code, icpt + {_EFFECT.replace('(l.yr + h)', f'(l.yr + {h})')} u from areas l, fit)" for h in (1, 2, 3)],
    """s1 as (select l.*, u + c0 * micro_share s from last l join u1 using (insee_code), fit)""",
    """s2 as (select s1.* replace (u + c0 * s as s) from s1 join u2 using (insee_code), fit)""",
    """s3 as (select s2.* replace (u + c0 * s as s) from s2 join u3 using (insee_code), fit)""",
    "path as (select 1 h, * from s1 union all select 2, * from s2 union all select 3, * from s3)",
    """width as (select h, 1.2816 * sqrt(rss / greatest(1, n - ncoef - 1) * (case h when 1 then 1 when 2 then 1 + c0 * c0 else 1 + c0 * c0 + c0 * c0 * c0 * c0 end)) w
  from fit, (values (1), (2), (3)) t(h))""") + """
select geo, opt, cast(path.h as bigint) horizon, yr + path.h period, band, cast(round(greatest(0, least(1000000, s + sign * w))) as bigint) micro_share
from path join width on path.h = width.h, (values ('low', -1), ('central', 0), ('high', 1)) b(band, sign)"""

ORACLE["temporal_split"] = with_(R3) + """
select yr, geo, opt, case when yr < (select max(year(o_orderdate)) from orders) then 'train' else 'test' end split
from results"""

ORACLE["regression_metrics"] = with_(R3, LAGP) + """
select yr, count(*) n, cast(round(avg(abs(e)) * 1000) as bigint) mae_milli,
       cast(round(sqrt(avg(e * e)) * 1000) as bigint) rmse_milli,
       cast(round((1 - sum(e * e) / (sum(y * y) - sum(y) * sum(y) / count(*))) * 1000) as bigint) r2_milli
from (select yr, cast(votes as double) y, cast(votes as double) - cast(prediction as double) e
      from lagp where prediction is not null) x
group by yr"""

ORACLE["class_accuracy"] = with_(R3, LEAD) + """
select yr, count(*) n, count(*) filter (where opt = predicted) n_correct
from (select yr, opt, lag(opt) over (partition by geo order by yr) predicted from lead1) x
where predicted is not null group by yr"""

ORACLE["score_classes"] = with_(R3) + """
select yr, case when micro_share < 40000 then 'low' when micro_share < 60000 then 'medium' else 'high' end cls,
       count(*) n from results group by 1, 2"""

ORACLE["scenario_projection"] = with_(IND) + """
select indicator_code, insee_code, cast(h as bigint) horizon, cast(last_period + h as bigint) period,
       cast(round(intercept + slope * (last_period + h)) as bigint) projection
from (select indicator_code, insee_code, regr_slope(cast(value as double), cast(year as double)) slope,
             regr_intercept(cast(value as double), cast(year as double)) intercept, max(year) last_period,
             unnest([1, 2, 3]) h
      from vals group by indicator_code, insee_code) x"""

ORACLE["incremental_load"] = """
select cast(year(o_orderdate) as bigint) yr, cast(c_nationkey as bigint) geo, p_brand opt,
       cast(sum(cast(l_quantity as bigint)) as bigint) eligible,
       cast(sum(case when o_orderstatus <> 'P' then cast(l_quantity as bigint) else 0 end) as bigint) cast_n,
       cast(sum(case when o_orderstatus = 'F' then cast(l_quantity as bigint) else 0 end) as bigint) votes
from orders join customer on o_custkey = c_custkey join lineitem on o_orderkey = l_orderkey
join part on l_partkey = p_partkey group by 1, 2, 3"""

ORACLE["incremental_corrections"] = """
with o as (select o_orderkey, o_custkey, case when o_orderkey % 5 = 0 then 'F' else o_orderstatus end o_orderstatus,
                  case when o_orderkey % 5 = 0 then o_orderdate + interval 1 month else o_orderdate end o_orderdate from orders)
select cast(year(o_orderdate) as bigint) yr, cast(c_nationkey as bigint) geo, p_brand opt,
       cast(sum(cast(l_quantity as bigint)) as bigint) eligible,
       cast(sum(case when o_orderstatus <> 'P' then cast(l_quantity as bigint) else 0 end) as bigint) cast_n,
       cast(sum(case when o_orderstatus = 'F' then cast(l_quantity as bigint) else 0 end) as bigint) votes
from o join customer on o_custkey = c_custkey join lineitem on o_orderkey = l_orderkey
join part on l_partkey = p_partkey group by 1, 2, 3"""
