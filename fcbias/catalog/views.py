"""SQL of the stand-in views for the checks, in dependency order; ``FIXTURES.md`` explains them."""

from __future__ import annotations

from .. import params as P

VIEWS: dict[str, str] = {}

VIEWS["stations"] = """
select cast(s_suppkey as int) as sid,
 cast(54 + ((s_suppkey*977)%1750)/100e0 as double) as obs_lat,
 cast(4 + ((s_suppkey*1499)%2800)/100e0 as double) as obs_lon,
 cast((s_suppkey*29)%400 as double) as obs_elevation,
 cast((s_suppkey*31)%400 as double) as model_elevation,
 cast((s_suppkey*7)%31 as int) as day_off, cast((s_suppkey*5)%24 as int) as hour_off
from supplier
"""
VIEWS["fc_cell"] = """
select s.sid, s.obs_lat as lat, s.obs_lon as lon, s.model_elevation,
 date_trunc('quarter', l.l_shipdate) + interval '1' day * s.day_off + interval '1' hour * s.hour_off as fcdate,
 date_trunc('quarter', l.l_shipdate) + interval '1' day * s.day_off + interval '1' hour * (s.hour_off + l.l_linenumber - 1) as validdate,
 l.l_linenumber - 1 as leadtime, l.l_quantity as q, l.l_discount as d, l.l_tax as x, l.l_partkey as p
from lineitem l join stations s on cast(l.l_suppkey as int) = s.sid
"""
_VALUES = {
    "T2m": "243.15e0 + q",
    "S10m": "d*150e0",
    "D10m": "cast(p%360 as double)",
    "RH2m": "2e0*q",
    "Pmsl": "980e0 + x*500e0",
    "Q2m": "x/10e0",
    "CClow": "cast(p%9 as double)",
    "Gmax": "d*150e0 + x*100e0",
}
VIEWS["fc_narrow"] = "\nunion all\n".join(
    f"select sid, lat, lon, model_elevation, fcdate, validdate, leadtime, '{n}' as parameter, {v} as value from fc_cell"
    for n, v in _VALUES.items()
)
VIEWS["obs_raw"] = """
select s.sid, case when o.o_orderkey%3=0 then 'foreign' else 'national' end as producer,
 s.obs_lat, s.obs_lon, s.obs_elevation,
 date_trunc('quarter', o.o_orderdate) + interval '1' day * s.day_off + interval '1' hour * (s.hour_off + cast(o.o_orderkey%7 as int)) as validdate,
 case when o.o_orderkey%11=0 or o.o_orderstatus='P' then null else o.o_totalprice/10000e0 - 25e0 end as ta,
 case when o.o_orderkey%11=0 then null else 30e0 + cast(o.o_custkey%70 as double) end as rh,
 case when o.o_orderkey%11=0 or o.o_orderkey%3=0 then null else o.o_totalprice/50000e0 end as wsp,
 case when o.o_orderkey%11=0 or o.o_orderkey%3<>0 then null else o.o_totalprice/50000e0 end as ws,
 case when o.o_orderkey%11=0 or o.o_orderstatus='O' then null else o.o_totalprice/9000e0 end as wg
from orders o join stations s on cast(o.o_custkey % (select count(*) from supplier) as int) = s.sid
"""
VIEWS["obs"] = """
select sid, validdate, max(obs_elevation) as obs_elevation, max(obs_lat) as obs_lat, max(obs_lon) as obs_lon,
 avg(rh) as rh_pt1m_avg, avg(ta) as ta_pt1m_avg, avg(coalesce(wsp,ws)) as ws_pt10m_avg, max(wg) as wg_pt1h_max
from obs_raw group by sid, validdate
"""
VIEWS["obs_crowd"] = """
select cast(c_custkey as int) as station_id,
 cast(54 + ((c_custkey*71)%175)/10e0 as double) as latitude, cast(4 + ((c_custkey*91)%280)/10e0 as double) as longitude,
 c_acctbal/400e0 - 10e0 as ta_pt1m_avg, c_custkey as arrival from customer
"""
VIEWS["obs_qc"] = """
select event_id, cast(user_id as int) as sid,
 cast('2024-01-01 00:00:00' as timestamp) + interval '1' month * cast(user_id%12 as int) + interval '1' hour * cast(6*(event_id%4) as int) as validdate,
 case when event_id%53=0 then null when event_type in ('click','view') then 20e0 - value/10e0 else 20e0 + value/20e0 end as ta
from events
"""
VIEWS["grid"] = """
select cast(p_partkey as int) as cell, cast(floor(p_partkey/50) as int) as j, cast(p_partkey%50 as int) as i,
 cast(54 + 17.5e0*floor(p_partkey/50)/(select ceil(count(*)/50e0) from part) as double) as lat,
 cast(4 + 0.56e0*(p_partkey%50) as double) as lon,
 cast((p_partkey*17)%400 as double) as topo, case when p_size > 25 then 1e0 else 0e0 end as lc from part
"""
VIEWS["leads"] = """
select cast(l_linenumber-1 as int) as leadtime from lineitem group by l_linenumber
"""
VIEWS["grid_fc"] = """
select g.cell, g.j, g.i, t.leadtime,
 243.15e0 + ((g.cell*13 + t.leadtime*7)%500)/10e0 as t2, ((g.cell*11 + t.leadtime*5)%200)/10e0 as ws,
 ((g.cell*19 + t.leadtime*3)%300)/10e0 as wg, ((g.cell*7 + t.leadtime)%101)/100e0 as rh,
 cast((g.cell*23 + t.leadtime)%360 as double) as wd, ((g.cell*3 + t.leadtime)%17)/16e0 as nl,
 98000e0 + ((g.cell*29 + t.leadtime)%6000) as ppa, ((g.cell*5 + t.leadtime)%100)/10000e0 as q2
from grid g cross join leads t
"""
VIEWS["dem"] = """
select cast(p_partkey%50 as int) as ix, cast(floor(p_partkey/50) as int) as iy, cast((p_partkey*41)%600 as double) as z from part
"""
VIEWS["crowd_first"] = """
select * from (select *, row_number() over (partition by latitude, longitude order by arrival) as rn from obs_crowd) t where rn = 1
"""
VIEWS["oi_points"] = """
select sid, obs_lat as lat, obs_lon as lon, obs_elevation as elev, 0e0 + (sid%21) - 10e0 as bias from stations
union all
select 1000000 + station_id, latitude, longitude, cast((station_id*41)%400 as double), ta_pt1m_avg from crowd_first
"""
VIEWS["crowd_events"] = """
select event_id, ts, cast(54 + ((user_id*71)%175)/10e0 as double) as latitude, cast(4 + ((user_id*91)%280)/10e0 as double) as longitude, value from events
"""

# --- training tables -------------------------------------------------------------------------------------

VIEWS["fc_wide"] = (
    "select leadtime, sid, lat, lon, model_elevation, validdate, fcdate, "
    + ", ".join(f"avg(case when parameter = '{n}' then value end) as {w}" for n, w in P.NARROW_TO_WIDE.items())
    + ", count(*) as rows_n from fc_narrow where parameter in ("
    + ", ".join(f"'{n}'" for n in P.NARROW_TO_WIDE)
    + ") group by leadtime, sid, lat, lon, model_elevation, validdate, fcdate"
)
VIEWS["fc_err"] = """
select w.leadtime, w.sid, w.lat, w.lon, w.model_elevation, w.validdate, w.fcdate, w.d10m, w.t2m - 273.15e0 as t2m,
 w.s10m, w.rh2m, w.pmsl, w.q2m, w.cclow, w.gmax, o.obs_lat, o.obs_lon, o.obs_elevation,
 o.rh_pt1m_avg, o.ta_pt1m_avg, o.ws_pt10m_avg, o.wg_pt1h_max,
 w.t2m - 273.15e0 - o.ta_pt1m_avg as tero, w.rh2m - o.rh_pt1m_avg as rhero,
 w.s10m - o.ws_pt10m_avg as wsero, w.gmax - o.wg_pt1h_max as wgero, w.model_elevation - o.obs_elevation as elevd
from fc_wide w left join obs o on w.sid = o.sid and w.validdate = o.validdate
"""
VIEWS["training"] = """
select e.*, a.tero as t0bias, a.rhero as rh0bias, a.wsero as ws0bias, a.wgero as wg0bias,
 b.tero as t1bias, b.rhero as rh1bias, b.wsero as ws1bias, b.wgero as wg1bias
from fc_err e
left join (select * from fc_err where leadtime = 0) a on e.sid = a.sid and e.fcdate = a.fcdate
left join (select * from fc_err where leadtime = 1) b on e.sid = b.sid and e.fcdate = b.fcdate
where coalesce(e.rh_pt1m_avg, e.ta_pt1m_avg, e.ws_pt10m_avg, e.wg_pt1h_max) is not null
"""

VIEWS["obs_repeated"] = """
select sid, validdate, obs_elevation, obs_lat, obs_lon, rh as rh_pt1m_avg, ta as ta_pt1m_avg,
 coalesce(wsp, ws) as ws_pt10m_avg, wg as wg_pt1h_max from obs_raw
"""
VIEWS["err_repeated"] = VIEWS["fc_err"].replace("join obs o", "join obs_repeated o")
VIEWS["training_repeated"] = VIEWS["training"].replace("fc_err", "err_repeated")

_TIME = {
    "month_sin": "sin(2*pi()*month({t})/12)",
    "month_cos": "cos(2*pi()*month({t})/12)",
    "hour_sin": "sin(2*pi()*hour({t})/24)",
    "hour_cos": "cos(2*pi()*hour({t})/24)",
}


def time_sql(time: str) -> dict[str, str]:
    return {n: e.format(t=time) for n, e in _TIME.items()}


def training_sql(model: str, float32: bool, source: str = "training", keep=()) -> str:
    """Training columns of one parameter; with ``float32`` complete rows only, as 32-bit floats."""
    times = time_sql("validdate")
    keys = {"leadtime", "sid", "validdate", *keep}
    columns = [*P.training_columns(model), *keep]

    def column(c: str) -> str:
        e = times.get(c, c)
        return e + f" as {c}" if c in keys or not float32 else f"cast({e} as float) as {c}"

    text = f"select {', '.join(column(c) for c in columns)} from {source}"
    if float32:
        p = P.parameter(model)
        where = [f"{c} is not null" for c in columns if c not in times]
        if p.upper_limit is not None:
            where.append(f"{p.obs} < {p.upper_limit}e0")
        text += " where " + " and ".join(where)
    return text


def training_doubles(model: str) -> str:
    return " ".join(c for c in P.training_columns(model) if c not in ("leadtime", "sid", "validdate"))


for _model in P.FEATURES:
    VIEWS[f"features_{_model.lower()}"] = training_sql(_model, True, keep=["fcdate"])
    VIEWS[f"rows_{_model.lower()}"] = f"select * from features_{_model.lower()} where leadtime not in (0, 1)"

# --- geometry ---------------------------------------------------------------------------------------------

R = P.EARTH_RADIUS


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"(2e0 * {R} * asin(sqrt(least(1e0, power(sin((radians({lat2}) - radians({lat1}))/2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon2}) - radians({lon1}))/2), 2)))))"
    )


def nearest_sql(points: str) -> str:
    """Nearest node by brute force."""
    distance = haversine_sql("p.lat", "p.lon", "g.lat", "g.lon")
    return f"""
select sid, cell, cm / 1e2 as distance, lc, topo from (
 select sid, cell, cm, lc, topo, row_number() over (partition by sid order by cm, cell) as rn from (
  select p.sid, g.cell, floor({distance} * 100 + 0.5) as cm, g.lc, g.topo from ({points}) p cross join grid g
 ) x1
) x2 where rn = 1
"""


VIEWS["near_stations"] = nearest_sql("select sid, obs_lat as lat, obs_lon as lon from stations")
VIEWS["near_points"] = nearest_sql("select sid, lat, lon from oi_points")
VIEWS["points_land"] = """
select p.*, n.lc as land from oi_points p join near_points n on p.sid = n.sid
"""


def barnes_sql(distance: str, dz: str, dland: str) -> str:
    return f"exp(-0.5e0*power({distance}/3e4,2)) * exp(-0.5e0*power(({dz})/2e2,2)) * exp(-0.5e0*power(({dland})/0.5e0,2))"


RADIUS_SQL = "3e4 * sqrt(-2e0 * ln(0.0013e0))"
VIEWS["near_pairs"] = f"""
select * from (
 select g.cell, g.topo, g.lc, p.sid, p.lat, p.lon, p.elev, p.land, p.bias,
  {haversine_sql("p.lat", "p.lon", "g.lat", "g.lon")} as distance
 from grid g cross join points_land p
) x1 where distance <= {RADIUS_SQL}
"""
VIEWS["near_weighted"] = f"""
select cell, sid, lat, lon, elev, land, bias, distance, {barnes_sql("distance", "topo - elev", "lc - land")} as rho from near_pairs
"""
VIEWS["near_ranked"] = """
select *, row_number() over (partition by cell order by floor(rho*1e9 + 0.5) desc, sid) as rank from near_weighted where rho > 0
"""
VIEWS["diff1"] = """
select cell, rho*bias/1.1e0 as diff from near_ranked where rank = 1
"""

# --- serving ------------------------------------------------------------------------------------------------

VIEWS["fc_fields"] = """
select cell, j, i, leadtime, timestamp '2024-07-01 00:00:00' + interval '1' hour * leadtime as forecasttime,
 t2 - 273.15e0 as t2m, ws as s10m, wg as gmax, rh*100e0 as rh2m, wd as d10m, round_even(nl/0.125e0, 0) as cclow,
 ppa/100e0 as pmsl, q2 as q2m
from grid_fc
"""
