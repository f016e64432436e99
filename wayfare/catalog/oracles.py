"""SQL twins of the catalogue queries, written against the raw test tables.

They share no code with the DataFrame side except constants of the grid: each
states the expected result on its own, mostly in the plain form (joins and
ranking windows) that the Spark side avoids.
"""

from __future__ import annotations

from wayfare.catalog import views as v
from wayfare.functions.hexgrid import Grid
from wayfare.sources.schema import ORDER_LINE
from wayfare.streaming.lines import HEADER_TOKEN

SECOND = "'%Y-%m-%d %H:%M:%S'"
MICRO = "'%Y-%m-%d %H:%M:%S.%f'"


def dbl(value: float) -> str:
    """A literal both parsers read as the same double."""
    text = repr(value)
    return text if "e" in text else f"{text}e0"


def sec(column: str) -> str:
    return f"strftime({column}, {SECOND})"


def mic(column: str) -> str:
    return f"strftime({column}, {MICRO})"


CTE = {}
CTE["fx_order"] = """
select concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar),
                 cast(l_suppkey as varchar), cast(cast(l_shipdate as date) as varchar)) as id,
       l_shipdate as create_time, l_extendedprice as pay_all, l_quantity as charge_mileage,
       1101e-1 + cast((l_partkey * 7919) % 10000 as double) / 1e4 * 6e-1 as open_lng,
       196e-1 + cast((l_orderkey * 104729) % 10000 as double) / 1e4 * 5e-1 as open_lat,
       concat(cast(4600 + s_nationkey as varchar), lpad(cast(l_partkey % 20 as varchar), 2, '0')) as begin_address_code,
       n_name as city_name, concat('V', cast(l_partkey as varchar)) as vehicle_license,
       cast(l_suppkey as varchar) as driver_id, s_name as driver_name,
       case when l_returnflag = 'R' then 1 else 0 end as cancel
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey"""
CTE["fx_renter"] = """
select cast(user_id as varchar) as id,
       min(case when event_type = 'signup' then ts end) as create_time,
       max(case when event_type = 'purchase' then ts end) as last_logon_time,
       concat(cast(4600 + user_id % 25 as varchar), '00') as last_login_city
from events group by user_id"""
CTE["fx_driver"] = """
select cast(c_custkey as varchar) as id, min(o_orderdate) as create_time,
       concat(cast(4600 + c_nationkey as varchar), '00') as register_city, c_name as driver_name
from customer join orders on o_custkey = c_custkey group by c_custkey, c_nationkey, c_name"""
CTE["fx_gps"] = """
select cast(user_id as varchar) as driver_id,
       concat(cast(user_id as varchar), '_', cast(cast(ts as date) as varchar)) as order_id, ts,
       cast(floor(epoch(ts)) as bigint) as epoch_s,
       104e0 + value / 1e3 as lng, 306e-1 + cast(event_id % 1000 as double) / 1e4 as lat,
       event_type = 'purchase' as is_end
from events"""
CTE["gps_row"] = f"""
select concat(order_id, '_', cast(epoch_s as varchar)) as rowkey, '075' as citycode, driver_id as driverid,
       order_id as orderid, epoch_s as "timestamp",
       strftime(make_timestamp(epoch_s * 1000000), {SECOND}) as "time", lng, lat
from fx_gps where not is_end"""
CTE["fx_gps_s"] = """
select order_id, driver_id, lng, lat, is_end,
       case when is_end then ts else make_timestamp(epoch_s * 1000000) end as ts
from fx_gps"""
CTE["trip"] = """
select order_id, min(ts) as start_time, max(ts) as end_time,
       arg_min(lng, {'t': ts, 'x': lng, 'y': lat}) as get_on_lng, arg_min(lat, {'t': ts, 'x': lng, 'y': lat}) as get_on_lat,
       arg_max(lng, {'t': ts, 'x': lng, 'y': lat}) as get_off_lng, arg_max(lat, {'t': ts, 'x': lng, 'y': lat}) as get_off_lat
from fx_gps where not is_end group by order_id"""
CTE["trip_s"] = CTE["trip"].replace("from fx_gps", "from fx_gps_s")
CTE["fx_line"] = """
select concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar),
                 cast(l_suppkey as varchar), cast(cast(l_shipdate as date) as varchar)) as order_id,
       cast(l_partkey as varchar) as product_id, '125' as city_id, '0898' as district,
       cast(l_linenumber as varchar) as county, l_returnflag as type, '0' as combo_type, '0' as traffic_type,
       cast(cast(l_quantity as int) % 4 + 1 as varchar) as passenger_count, cast(l_suppkey as varchar) as driver_product_id,
       cast(cast(l_quantity as int) * 100 as varchar) as start_dest_distance,
       concat(cast(cast(l_shipdate as date) as varchar), ' 08:30:00') as arrive_time,
       concat(cast(cast(l_shipdate as date) as varchar), ' 08:00:00') as departure_time,
       cast(cast(l_extendedprice as decimal(18,2)) as varchar) as pre_total_fee,
       cast(cast(l_quantity as int) + 5 as varchar) as normal_time,
       md5(concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar), cast(l_partkey as varchar),
                     cast(l_suppkey as varchar), cast(cast(l_shipdate as date) as varchar))) as bubble_trace_id,
       l_linestatus as product_1level, '110.33' as dest_lng, '20.02' as dest_lat,
       cast(1101e-1 + cast((l_partkey * 7919) % 10000 as double) / 1e4 * 6e-1 as varchar) as starting_lng,
       cast(196e-1 + cast((l_orderkey * 104729) % 10000 as double) / 1e4 * 5e-1 as varchar) as starting_lat,
       strftime(l_shipdate, '%Y') as year, strftime(l_shipdate, '%m') as month, strftime(l_shipdate, '%d') as day
from lineitem"""


def grid_ctes(res: int, source: str = "fx_order", name: str = "gridded") -> None:
    """Cell ids by cube rounding, step by step."""
    g = Grid(res)
    xq, yq, yr = g.factors
    CTE[f"{name}_f"] = f"""
select *, (open_lng - {dbl(g.lng0)}) * {dbl(g.metres_per_lng)} as gx, (open_lat - {dbl(g.lat0)}) * {dbl(g.metres_per_lat)} as gy
from {source}"""
    CTE[f"{name}_q"] = f"select *, gx * {dbl(xq)} - gy * {dbl(yq)} as qf, gy * {dbl(yr)} as rf from {name}_f"
    CTE[f"{name}_r"] = f"""
select *, cast(floor(qf + 5e-1) as bigint) as q0, cast(floor(rf + 5e-1) as bigint) as r0,
       cast(floor(-qf - rf + 5e-1) as bigint) as s0, -qf - rf as sf from {name}_q"""
    CTE[f"{name}_a"] = f"""
select *, case when abs(q0 - qf) > abs(r0 - rf) and abs(q0 - qf) > abs(s0 - sf) then -r0 - s0 else q0 end as aq,
       case when not (abs(q0 - qf) > abs(r0 - rf) and abs(q0 - qf) > abs(s0 - sf)) and abs(r0 - rf) > abs(s0 - sf)
            then -q0 - s0 else r0 end as ar from {name}_r"""
    CTE[name] = f"""
select *, cast({res << 56} + (aq + {1 << 27}) * {1 << 28} + (ar + {1 << 27}) as bigint) as cell from {name}_a"""


for _res, _name in ((7, "gridded"), (9, "grid9"), (12, "grid12")):
    grid_ctes(_res, name=_name)


def center(res: int, cell: str = "cell") -> tuple[str, str]:
    g = Grid(res)
    q = f"((({cell} >> 28) & 268435455) - {1 << 27})"
    r = f"(({cell} & 268435455) - {1 << 27})"
    lng = f"({dbl(g.lng0)} + ({q} + {r} * 5e-1) * {dbl(g.edge * 3 ** 0.5 / g.metres_per_lng)})"
    lat = f"({dbl(g.lat0)} + {r} * {dbl(g.edge * 1.5 / g.metres_per_lat)})"
    return lng, lat


def deg_text(expression: str) -> str:
    return f"cast(round({expression}, 6) as varchar)"


_LNG7, _LAT7 = center(7)
LAT_LNG7 = f"concat({deg_text(_LAT7)}, ',', {deg_text(_LNG7)})"
LNG_LAT7 = f"concat({deg_text(_LNG7)}, ',', {deg_text(_LAT7)})"

# district polygons, corner by corner, in ten-thousandths of a degree
_corners = [(0, i, dx, dy) for i, (dx, dy) in enumerate(v.OUTER)] + [(1, i, dx, dy) for i, (dx, dy) in enumerate(v.HOLE)]
CTE["poly_corner"] = "select * from (values " + ", ".join(str(c) for c in _corners) + ") t(part, vertex, dx, dy)"
CTE["poly_vertex"] = """
select n_nationkey, n_name, part, vertex, 1101600 + (n_nationkey % 5) * 1200 + dx as ix,
       196500 + (n_nationkey // 5) * 1000 + dy as iy
from nation join poly_corner on part = 0 or n_nationkey % 2 = 0"""
CTE["poly_edge"] = """
select a.n_nationkey, a.n_name, a.ix / 1e4 as x1, a.iy / 1e4 as y1, b.ix / 1e4 as x2, b.iy / 1e4 as y2
from poly_vertex a join poly_vertex b on a.n_nationkey = b.n_nationkey and a.part = b.part and b.vertex = (a.vertex + 1) % 4"""
CTE["poly_box"] = """
select n_nationkey, n_name, min(x1) as w, max(x1) as e, min(y1) as s, max(y1) as n from poly_edge group by all"""


def match_cte(points: str, key: str, lng: str, lat: str) -> str:
    turn = f"((x2 - x1) * ({lat} - y1) - (y2 - y1) * ({lng} - x1))"
    return f"""
select p.{key}, g.n_nationkey, g.n_name
from {points} p join poly_box on {lng} between w and e and {lat} between s and n join poly_edge g on g.n_nationkey = poly_box.n_nationkey
group by p.{key}, g.n_nationkey, g.n_name
having count(*) filter (where (y1 > {lat}) <> (y2 > {lat}) and ((y2 > y1) = ({turn} > 0e0))) % 2 = 1
   and count(*) filter (where {turn} = 0e0 and {lng} between least(x1, x2) and greatest(x1, x2)
                        and {lat} between least(y1, y2) and greatest(y1, y2)) = 0"""


CTE["station12"] = """
select id as order_id, substr(begin_address_code, 1, 4) as city_id, open_lng as starting_lng, open_lat as starting_lat, cell
from grid12 qualify row_number() over (partition by cell order by open_lng, open_lat, id) = 1"""
CTE["station9"] = CTE["station12"].replace("grid12", "grid9")
CTE["station7"] = CTE["station12"].replace("grid12", "gridded")
CTE["match12"] = match_cte("station12", "order_id", "starting_lng", "starting_lat")
CTE["match9"] = match_cte("station9", "order_id", "starting_lng", "starting_lat")
CTE["match_all"] = match_cte("fx_order", "id", "open_lng", "open_lat")
CTE["placed"] = """
select s.order_id, city_id, starting_lng as lng, starting_lat as lat, 1 as count, n_name as district_name
from station12 s join match12 m on s.order_id = m.order_id"""
CTE["queue"] = """
select order_id, ts, is_end,
       case when is_end then 'end' else concat(cast(lng as varchar), ',', cast(lat as varchar)) end as entry from fx_gps"""
CTE["queue_s"] = CTE["queue"].replace("from fx_gps", "from fx_gps_s")
CTE["hourly"] = """
select date_trunc('hour', first_ts) as hour, count(*) as order_count
from (select order_id, min(ts) as first_ts from fx_gps where not is_end group by order_id) group by 1"""
CTE["gauge"] = """
select cast(epoch(date_trunc('hour', ts)) as bigint) * 1000 as snapshot_ms,
       count(*) filter (where event_type = 'error') as failed_stages,
       count(*) filter (where event_type = 'click') as running_stages,
       count(*) filter (where event_type = 'view') as waiting_stages,
       count(*) filter (where event_type = 'signup') as running_batches,
       count(*) filter (where event_type = 'error') as waiting_batches,
       count(*) filter (where event_type = 'purchase') as completed_batches,
       count(*) filter (where event_type = 'click') as mem_used_mb,
       count(*) filter (where event_type = 'purchase') as remaining_mem_mb,
       count(*) filter (where event_type = 'view') as max_mem_mb
from events group by 1"""
CTE["newest_order"] = """
select *, case o_orderstatus when 'F' then 'delete' when 'P' then 'update' else 'insert' end as op from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1"""


def sql(body: str, *names: str) -> str:
    """The body with the named views (and those they need) as CTEs."""
    wanted: list[str] = []

    def need(name: str) -> None:
        if name in wanted:
            return
        words = set(CTE[name].replace(",", " ").replace("(", " ").replace(")", " ").split())
        for other in CTE:
            if other != name and other in words:
                need(other)
        wanted.append(name)

    for name in names:
        need(name)
    if not wanted:
        return body.strip()
    return "with " + ",\n".join(f"{n} as ({CTE[n]})" for n in wanted) + "\n" + body.strip()


def year(ts: str, day: str) -> str:
    return f"year({ts}) = year(date '{day}')"


def quarter(ts: str, day: str) -> str:
    return f"({year(ts, day)} and quarter({ts}) = quarter(date '{day}'))"


def month(ts: str, day: str) -> str:
    return f"strftime({ts}, '%Y-%m') = '{day[:7]}'"


def week(ts: str, day: str) -> str:
    return f"weekofyear({ts}) = weekofyear(date '{day}')"


def iso_week(ts: str, day: str) -> str:
    return f"(weekofyear({ts}) = weekofyear(date '{day}') and isoyear({ts}) = isoyear(date '{day}'))"


def on_day(ts: str, day: str) -> str:
    return f"cast({ts} as date) = date '{day}'"


PERIOD = {"year": year, "quarter": quarter, "month": month, "week": week, "day": on_day}
O, D, R = v.ORDERS_AS_OF, v.DRIVERS_AS_OF, v.RENTERS_AS_OF


def pct(part: str, whole: str) -> str:
    return f"case when {part} = 0 then '0.0%' else concat(cast(round({part} * 100 / {whole}, 2) as varchar), '%') end"


def pct_decimal(part: str, whole: str) -> str:
    return f"concat(cast(cast(round({part} * 100e0 / nullif({whole}, 0), 2) as decimal(20,2)) as varchar), '%')"


def pct_raw(part: str, whole: str) -> str:
    return f"concat(cast({part} * 100 / nullif({whole}, 0) as varchar), '%')"


def completion(key: str, iso: bool = False) -> str:
    """Period counts per key, then text rates; keys with an effective order this year."""
    counts, rates = [], []
    for name, test in PERIOD.items():
        if iso and name == "week":
            test = iso_week
        where = test("create_time", O)
        counts.append(f"count(*) filter (where {where} and cancel = 0) as e_{name}")
        counts.append(f"count(*) filter (where {where}) as t_{name}")
        rates.append(f"{pct('e_' + name, 't_' + name)} as _{name}_comple_rate")
    shown = "'1' as rk, city_name" if key == "city_name" else "driver_id as rk, driver_id, driver_name"
    extra = "" if key == "city_name" else ", max(driver_name) as driver_name"
    return f"""
select {shown}, {', '.join(rates)}
from (select {key}{extra}, {', '.join(counts)} from fx_order group by {key}) where e_year > 0"""


HASH = (
    "list_reduce(list_prepend(cast(0 as bigint), list_transform(string_split({0}, ''), "
    "lambda c: cast(unicode(c) as bigint))), lambda h, c: (h * 31 + c) & 4294967295)"
)


def salted(text: str) -> str:
    return (
        f"concat(lpad(cast((({HASH.format(text)}) & 2147483647) % 8 as varchar), 4, '0'), substr(md5({text}), 1, 12))"
    )


ORACLES: dict[str, str] = {}
A = ORACLES

# ---- sources ----
A["scan_entity"] = sql(f"""
select id, {sec('create_time')} as create_time, pay_all, open_lng, open_lat, begin_address_code, charge_mileage, city_name,
       vehicle_license, driver_id, driver_name, cancel, cast(null as varchar) as close_gps_time from fx_order""", "fx_order")
A["scan_family_columns"] = """
select cast(c_custkey as varchar) as id, c_name as name, c_mktsegment as segment, '' as absent from customer"""
A["null_as_empty"] = sql(f"""
select id, coalesce({sec('create_time')}, '') as create_time, coalesce({sec('last_logon_time')}, '') as last_logon_time,
       last_login_city from fx_renter""", "fx_renter")
A["scan_key_range"] = f"""
select cast(substr(rowkey, 1, 4) as int) as key_range, count(*) as n_rows, min(rowkey) as first_key, max(rowkey) as last_key
from (select {salted('c_name')} as rowkey from customer) where substr(rowkey, 1, 4) between '0002' and '0005' group by 1"""
A["scan_key_range_source"] = A["scan_key_range"]
A["scan_station_orders"] = sql("""
select id as order_id, substr(begin_address_code, 1, 4) as city_id, open_lng as starting_lng, open_lat as starting_lat
from fx_order""", "fx_order")
A["source_counts"] = sql("""
select 'order' as source, count(*) as n_rows from fx_order union all select 'renter', count(*) from fx_renter
union all select 'driver', count(*) from fx_driver""", "fx_order", "fx_renter", "fx_driver")
_POLYGON = """
string_agg(ring, '|' order by part) from (
  select n_nationkey, n_name, part,
         string_agg(concat(cast(ix // 10000 as varchar), '.', lpad(cast(ix % 10000 as varchar), 4, '0'), ',',
                           cast(iy // 10000 as varchar), '.', lpad(cast(iy % 10000 as varchar), 4, '0')), ';' order by vertex) as ring
  from poly_vertex group by n_nationkey, n_name, part) group by n_nationkey, n_name"""
A["district_flatten"] = sql(
    f"select cast(4600 + n_nationkey as varchar) as citycode, n_name as name, {_POLYGON.replace(' from (', ' as polygon from (', 1)}",
    "poly_vertex",
)
A["district_geojson"] = sql("""
select n_name as name, cast(count(*) as int) as n_edges, min(x1) as west, max(y1) as north from poly_edge group by n_name""", "poly_edge")

# ---- sinks and merges ----
A["report_write"] = sql(completion("city_name"), "fx_order")
A["upsert_latest"] = """
select id, version, seq, amount from (
  select c_custkey as id, '1900-01-01' as version, cast(-1 as bigint) as seq, c_acctbal as amount from customer
  union all select o_custkey, cast(cast(o_orderdate as date) as varchar), o_orderkey, o_totalprice from orders)
qualify row_number() over (partition by id order by version desc, seq desc) = 1"""
A["upsert_partial"] = """
select user_id as id, max(event_id) as version,
       arg_max(value, event_id) filter (where event_type = 'click') as click,
       arg_max(value, event_id) filter (where event_type = 'purchase') as purchase,
       arg_max(value, event_id) filter (where event_type = 'signup') as signup
from events where event_type <> 'error' group by user_id"""

_REGION_ORDERS = f"""
select concat(region, '00') as rk, count(distinct vehicle_license) filter (where {month('create_time', O)}) as "monthVehicleCount",
       count(distinct vehicle_license) filter (where {on_day('create_time', O)}) as "dayVehicleCount",
       concat(region, '00') as o_begin_address_code,
       count(*) filter (where {month('create_time', O)}) as "monthOrderCount",
       count(*) filter (where {week('create_time', O)}) as "weekOrderCount",
       count(*) filter (where {on_day('create_time', O)}) as "dayOrderCount"
from (select *, substr(begin_address_code, 1, 4) as region from fx_order) group by region
having count(*) filter (where {month('create_time', O)}) > 0"""


def as_text(select: str, columns: list[str]) -> str:
    shown = ", ".join(f'cast("{c}" as varchar) as "{c}"' for c in columns)
    return f"select {shown} from ({select})"


A["stringify_report"] = sql(as_text(_REGION_ORDERS, [
    "rk", "monthVehicleCount", "dayVehicleCount", "o_begin_address_code", "monthOrderCount", "weekOrderCount", "dayOrderCount",
]), "fx_order")

# ---- filters ----
for _key, _test in {
    "filter_day": on_day("create_time", O), "filter_week_any_year": week("create_time", O),
    "filter_week_iso_year": iso_week("create_time", O), "filter_month": month("create_time", O),
    "filter_quarter": quarter("create_time", O), "filter_year": year("create_time", O),
    "filter_since": "create_time >= timestamp '1999-06-01'",
}.items():
    A[_key] = sql(f"select id, {sec('create_time')} as create_time from fx_order where {_test}", "fx_order")
A["filter_effective"] = sql("select id, cancel from fx_order where cancel = 0", "fx_order")
A["cells_min_orders"] = sql("select cell, count(*) as total from gridded group by cell having count(*) >= 10", "gridded")
A["null_default"] = sql(f"""
select id, coalesce({sec('create_time')}, 'never') as create_time, coalesce({sec('last_logon_time')}, 'none') as last_logon_time
from fx_renter""", "fx_renter")
A["region_rollup"] = sql("""
select substr(begin_address_code, 1, 4) as region, concat(substr(begin_address_code, 1, 4), '00') as code, count(*) as n_orders
from fx_order group by 1, 2""", "fx_order")

CTE["gps_text"] = """
select case when is_end then concat('end,', order_id) else concat_ws(',', driver_id, order_id, cast(epoch_s as varchar),
            cast(lng as varchar), cast(lat as varchar)) end as value, is_end from fx_gps"""
CTE["order_text"] = "select concat_ws(chr(9), " + ", ".join(ORDER_LINE) + ") as value from fx_line"
CTE["header_text"] = (
    "select concat_ws(chr(9), " + ", ".join(f"'{HEADER_TOKEN}.{c}'" for c in ORDER_LINE[:-1]) + ", n_name) as value from nation"
)
CTE["short_text"] = "select concat(cast(s_suppkey as varchar), chr(9), s_name) as value from supplier"
CTE["odd_text"] = """
select concat_ws(',', cast(o_custkey as varchar), cast(o_orderkey as varchar), o_orderpriority, '104.1', '30.1') as value from orders"""
A["route_lines"] = sql("""
select value, 'gps' as kind from gps_text where not is_end union all select value, 'gps' from odd_text
union all select value, 'order' from order_text union all select value, 'order' from header_text
union all select value, 'order' from short_text""", "gps_text", "order_text", "header_text", "short_text", "odd_text")
A["quarantine"] = sql("""
select c_name as value, 'unroutable' as reason from customer union all select value, 'bad_number' from odd_text
union all select value, 'header' from header_text union all select value, 'field_count' from short_text""",
                      "header_text", "short_text", "odd_text")
A["gps_query"] = sql("""
select rowkey, driverid, orderid, "timestamp", "time", lng, lat from gps_row
where "time" >= '2024-01-05 00:00:00' and "time" <= '2024-01-20 23:59:59' and citycode = '075'""", "gps_row")
A["gps_query_narrow"] = sql('select "time", lng, lat from gps_row', "gps_row")
_TRACK = f"""
select g.order_id, g.driver_id, {mic('g.ts')} as ts, g.lng, g.lat from fx_gps g join trip t on g.order_id = t.order_id
where not g.is_end and g.ts @ t.start_time and g.ts <= t.end_time"""
A["track_history"] = sql(_TRACK.replace("@", ">"), "trip")
A["join_track_trip"] = sql(_TRACK.replace("@", ">="), "trip")

# ---- joins ----
_DONE_YEAR = f"{year('create_time', O)} and cancel = 0"
A["join_left_city"] = sql(f"""
select e.city_name, effective, total
from (select city_name, count(*) as effective from fx_order where {_DONE_YEAR} group by 1) e
left join (select city_name, count(*) as total from fx_order where {year('create_time', O)} group by 1) t
  on e.city_name = t.city_name""", "fx_order")
A["join_left_chain"] = sql("select y.register_city, year, " + ", ".join(
    f"coalesce({n}, 0) as {n}" for n in ("quarter", "month", "week", "day")
) + " from " + " left join ".join(
    f"(select register_city, count(*) as {n} from fx_driver where {t('create_time', D)} group by 1) {n[0]}"
    + ("" if n == "year" else f" on y.register_city = {n[0]}.register_city")
    for n, t in PERIOD.items()
), "fx_driver")
A["join_left_driver"] = sql(f"""
select e.driver_id, driver_name, effective, total
from (select driver_id, driver_name, count(*) as effective from fx_order where {_DONE_YEAR} group by 1, 2) e
left join (select driver_id, count(*) as total from fx_order where {year('create_time', O)} group by 1) t
  on e.driver_id = t.driver_id""", "fx_order")
A["join_full_region"] = sql(f"""
select coalesce(a.region, b.region) as region, coalesce(vehicles, 0) as vehicles, coalesce(n_orders, 0) as n_orders
from (select substr(begin_address_code, 1, 4) as region, count(distinct vehicle_license) as vehicles
      from fx_order where {on_day('create_time', O)} group by 1) a
full join (select substr(begin_address_code, 1, 4) as region, count(*) as n_orders
      from fx_order where {month('create_time', O)} group by 1) b on a.region = b.region""", "fx_order")
A["join_full_users"] = sql(f"""
select coalesce(a.region, b.region) as region, coalesce(new_users, 0) as new_users, coalesce(active_users, 0) as active_users
from (select substr(last_login_city, 1, 4) as region, count(*) as new_users
      from fx_renter where {on_day('create_time', '2024-01-01')} group by 1) a
full join (select substr(last_login_city, 1, 4) as region, count(distinct id) as active_users
      from fx_renter where {on_day('last_logon_time', R)} group by 1) b on a.region = b.region""", "fx_renter")


def day_cells(day: str, name: str) -> str:
    return f"""(select cell, begin_address_code as {name} from gridded where {on_day('create_time', day)}
      qualify row_number() over (partition by cell order by create_time desc, id desc) = 1)"""


_BEFORE = "1998-07-14"
A["join_full_cells"] = sql(f"""
select coalesce(t.cell, y.cell) as cell, today_code, before_code
from {day_cells(O, 'today_code')} t full join {day_cells(_BEFORE, 'before_code')} y on t.cell = y.cell""", "gridded")
A["join_inner_scalar"] = sql(f"""
select a.myid, total_orders, month_orders, income
from (select 1 as myid, count(*) as total_orders from fx_order) a
join (select 1 as myid, count(*) as month_orders from fx_order where {month('create_time', O)}) b on a.myid = b.myid
join (select 1 as myid, round(sum(pay_all), 2) as income from fx_order) c on a.myid = c.myid""", "fx_order")
A["join_left_retention"] = sql(f"""
select a.id, b.id is not null as retained from (select id from fx_renter where {on_day('create_time', '2024-01-01')}) a
left join (select id from fx_renter where {on_day('last_logon_time', R)}) b on a.id = b.id""", "fx_renter")
A["join_self_cell"] = sql("""
select id, a.cell, total from gridded a
join (select cell, count(*) as total from gridded group by cell having count(*) >= 10) b on a.cell = b.cell""", "gridded")
A["join_point_in_polygon"] = sql("""
select s.order_id, cell, n_name as district_name, cast(4600 + n_nationkey as varchar) as district_citycode
from station9 s join match9 m on s.order_id = m.order_id""", "match9", "station9")
A["join_hot_split"] = """
select l_suppkey, l_orderkey, l_linenumber, s_name from lineitem join supplier on l_suppkey = s_suppkey"""

# ---- aggregations ----
A["agg_count_group"] = sql("select city_name, count(*) as n_orders from fx_order group by city_name", "fx_order")
A["agg_count_global"] = sql("select count(*) as n_users from fx_renter", "fx_renter")
A["agg_count_distinct"] = sql("""
select substr(begin_address_code, 1, 4) as region, count(distinct vehicle_license) as n_vehicles from fx_order group by 1""", "fx_order")
A["agg_active_users"] = f"""
select count(distinct user_id) filter (where {on_day('ts', R)}) as "DAU",
       count(distinct user_id) filter (where {iso_week('ts', R)}) as "WAU",
       count(distinct user_id) filter (where {month('ts', R)}) as "MAU" from events"""
A["agg_sum"] = sql("""
select city_name, sum(charge_mileage) as charge_mileage, round(sum(pay_all), 2) as pay_all from fx_order group by 1""", "fx_order")
A["agg_conditional"] = sql("""
select city_name, count(*) filter (where cancel = 0) as effective, count(*) filter (where cancel <> 0) as cancelled
from fx_order group by 1""", "fx_order")
A["agg_date_span"] = sql(f"""
select city_name, {sec('min(create_time)')} as first_time, {sec('max(create_time)')} as last_time,
       cast(date_diff('day', cast(min(create_time) as date), cast(max(create_time) as date)) + 1 as int) as n_days
from fx_order group by 1""", "fx_order")
A["agg_rate"] = sql("""
select city_name, round(count(*) filter (where cancel = 0) * 100 / count(*), 2) as rate from fx_order group by 1""", "fx_order")
A["agg_collect_detail"] = sql(f"""
select begin_address_code as city_code, count(*) over (partition by begin_address_code) as city_num,
       {LAT_LNG7} as coordinate, 1200 as radius, 1 as count
from (select * from gridded qualify row_number() over (partition by cell order by create_time desc, id desc) = 1)""", "gridded")
A["agg_station_district"] = sql("select n_name as district_name, count(*) as count from match9 group by 1", "match9")
A["agg_hour_to_day"] = sql("""
select cast(cast(hour as date) as varchar) as day, cast(sum(order_count) as bigint) as order_count from hourly group by 1""", "hourly")
A["agg_geo_centroid"] = sql("""
select city_name, round(degrees(atan2(z, sqrt(x * x + y * y))), 6) as center_lat, round(degrees(atan2(y, x)), 6) as center_lng
from (select city_name, avg(cos(radians(open_lat)) * cos(radians(open_lng))) as x,
             avg(cos(radians(open_lat)) * sin(radians(open_lng))) as y, avg(sin(radians(open_lat))) as z
      from fx_order group by 1)""", "fx_order")

# ---- one per group ----
A["win_latest_per_cell"] = sql(f"""
select cell, id, {sec('create_time')} as create_time, begin_address_code from gridded
qualify row_number() over (partition by cell order by create_time desc, id desc) = 1""", "gridded")
A["win_station_per_cell"] = sql("""
select order_id, city_id, starting_lng, starting_lat, 1 as rn, cell from station7""", "station7")
A["topk_recent"] = sql("select * from gauge order by snapshot_ms desc limit 5", "gauge")
A["last_position"] = sql(f"""
select order_id, {mic('ts')} as ts, lng, lat from fx_gps where not is_end
qualify row_number() over (partition by order_id order by ts desc, lng desc, lat desc) = 1""", "fx_gps")
A["first_position"] = sql(f"""
select order_id, {mic('ts')} as ts, lng, lat from fx_gps where not is_end
qualify row_number() over (partition by order_id order by ts, lng, lat) = 1""", "fx_gps")


def active(source: str) -> str:
    return f"""
select concat('075_', order_id) as order_key, n_points
from (select order_id, is_end, count(*) filter (where not is_end) over (partition by order_id) as n_points from {source}
      qualify row_number() over (partition by order_id order by ts desc, is_end desc) = 1)
where not is_end"""


A["active_orders"] = sql(active("fx_gps"), "fx_gps")

# ---- scalar functions ----
A["fn_date"] = """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day, strftime(o_orderdate, '%Y-%m') as month,
       strftime(o_orderdate, '%Y') as year, cast(weekofyear(o_orderdate) as int) as week, cast(quarter(o_orderdate) as int) as quarter,
       cast(date_diff('day', cast(o_orderdate as date), date '2000-01-01') as int) as days_to_2000,
       cast(cast(o_orderdate as date) - 1 as varchar) as day_before, strftime(o_orderdate, '%Y%m') as suffix from orders"""
A["fn_epoch"] = f"""
select event_id, {sec('ts')} as text, cast(hour(ts) as int) as hour, {sec('ts')} as from_millis from events"""
A["fn_any_time"] = f"""
select event_id, case when event_type in ('click', 'view') then {sec('ts')} end as text from events"""
A["fn_compact_time"] = """
select event_id, case when event_type not in ('error', 'view') then strftime(ts, '%Y%m%d%H%M%S') end as compact,
       case when event_type <> 'error' then strftime(ts, '%Y%m%d') end as compact_day from events"""
A["fn_minus_15d"] = "select event_id, strftime(ts - interval 15 days, '%Y%m%d%H%M') as before from events"
A["fn_string"] = """
select c_custkey, cast(4600 + c_nationkey as varchar) as region, concat(cast(4600 + c_nationkey as varchar), '00') as city_code,
       case when c_mktsegment = 'BUILDING' then 'none' else c_mktsegment end as segment,
       cast(round(c_acctbal) as bigint) as balance from customer"""
A["fn_percent"] = sql(f"""
select driver_id, {pct('part', 'whole')} as rounded, {pct_decimal('part', 'whole')} as two_digits, {pct_raw('part', 'whole')} as raw
from (select driver_id, count(*) filter (where cancel = 0 and driver_id <> '7') as part, count(*) as whole
      from fx_order group by driver_id)""", "fx_order")
A["fn_rowkey_salted"] = f"select c_name, {salted('c_name')} as rowkey from customer"
_BOTH = "concat(c_name, c_mktsegment)"
A["fn_rowkey_hash"] = f"""
select c_custkey, concat(lpad(hex(({HASH.format(_BOTH)}) & 32767), 4, '0'), hex({_BOTH})) as rowkey from customer"""
_JOINED = "concat(c_name, '_', c_mktsegment)"
A["fn_rowkey_md5"] = "select c_custkey, " + ", ".join(
    f"concat(substr(md5({_JOINED}), 1, {n}), '_', {_JOINED}) as md5_{k}" for k, n in ((4, 8), (16, 16), (40, 32))
) + " from customer"
A["fn_rowkey_plain"] = f"select c_custkey, {_BOTH} as rowkey, {_JOINED} as joined from customer"
A["parse_gps"] = sql("""
select case when not is_end then driver_id end as driver_id, order_id, case when not is_end then epoch_s end as epoch,
       case when not is_end then lng end as lng, case when not is_end then lat end as lat, is_end from fx_gps""", "fx_gps")
A["parse_order_line"] = sql("select * from fx_line", "fx_line")
A["parse_json_default"] = """
select event_id, json_extract_string(props, '$.k') as k, 'insert' as type, '' as absent from events"""
A["record_to_map"] = """
select s_suppkey, concat('s_suppkey=', s_suppkey, ';s_name=', s_name, ';s_nationkey=', s_nationkey, ';s_acctbal=', s_acctbal) as cells,
       concat('{"s_suppkey":', s_suppkey, ',"s_name":"', s_name, '"}') as json from supplier"""
A["fn_order_key"] = """
select c_custkey, case when c_mktsegment = 'BUILDING' then c_name else concat('075_', md5(c_name)) end as order_key,
       case when c_mktsegment = 'BUILDING' then c_name else md5(c_name) end as bare_id from customer"""
# the patterns in RE2's own words, removed in this order
_MARKUP = (
    r"(?is)<\s*script\b[^>]*>.*?<\s*/\s*script\s*>", r"(?is)<\s*style\b[^>]*>.*?<\s*/\s*style\s*>",
    r"(?is)<\s*iframe\b[^>]*>.*?<\s*/\s*iframe\s*>", r"(?is)<\s*frameset\b[^>]*>.*?<\s*/\s*frameset\s*>",
    r"(?is)<\s*object\b[^>]*>.*?<\s*/\s*object\s*>", r"(?i)<\s*link\b[^>]*>", r"(?i)<\s*embed\b[^>]*>", r"(?i)<\s*base\b[^>]*>",
    r"""(?i)\son[a-z]+\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s>]*)""",
    r"""(?i)\s(?:href|src|action)\s*=\s*(?:"\s*javascript:[^"]*"|''\s*javascript:[^'']*''|javascript:[^\s>]*)""",
)
_html = """concat(html, case page_id % 8
  when 0 then concat('<a onclick="go(1)" href="', url, '">x</a>')
  when 1 then concat('<IFRAME src=''', url, '''>', chr(10), 'frame</ iframe >tail')
  when 2 then concat('<link rel=x href="', url, '"><linked>kept</linked>')
  when 3 then concat('<meta content="on=1" name=contents> one=2 ', url)
  when 4 then concat('<a class=b HREF = " javascript:run()">', url, '</a><a href=javascript:x()>y</a>')
  when 5 then concat('<object data=''', url, '''><embed src=a></object><img onerror = bad() src=b>')
  when 6 then concat('<frameset><frame></frameset><base target=_top>', url)
  else url end)"""
for _pattern in _MARKUP:
    _html = f"regexp_replace({_html}, '{_pattern}', '', 'g')"
A["html_filter"] = f"select page_id, {_html} as html from pages"

# ---- grid and polygons ----
CTE["two_cells"] = "select id, gridded.cell as cell, grid12.cell as fine_cell from gridded join grid12 using (id)"
A["cell_id"] = sql("select id, cell, fine_cell from two_cells", "two_cells")
A["sql_cell_functions"] = sql(f"select id, cell, fine_cell, {LAT_LNG7} as center from two_cells", "two_cells")
A["cell_center"] = sql(f"""
select cell, cast(cell >> 56 as int) as res, {LAT_LNG7} as center from (select distinct cell from gridded)""", "gridded")
_boundary = ", ';', ".join(
    f"{deg_text(f'{_LNG7} + {dbl(dx)}')}, ',', {deg_text(f'{_LAT7} + {dbl(dy)}')}" for dx, dy in Grid(7).corners
)
A["cell_boundary"] = sql(f"""
select cell, concat({_boundary}) as boundary, round({_LNG7}, 4) as center_lng, round({_LAT7}, 4) as center_lat
from (select distinct cell from gridded)""", "gridded")
A["virtual_stations"] = sql("select order_id, city_id, starting_lng, starting_lat, 1 as rn from station12", "station12")
A["polygon_parse"] = sql("""
select n_name as name, cast(part as int) as part, cast(vertex as int) as vertex, ix / 1e4 as lng, iy / 1e4 as lat from poly_vertex""", "poly_vertex")
A["point_in_polygon"] = sql("select id as order_id, n_name as district_name from match_all", "match_all")

# ---- streams ----
A["stream_source"] = sql("""
select 'gps' as topic, count(*) as n_lines, cast(sum(length(value)) as bigint) as n_chars from gps_text
union all select 'orders', count(*), cast(sum(length(value)) as bigint) from order_text""", "gps_text", "order_text")
A["stream_fanout"] = sql("""
select 'gps' as source, count(*) as n_rows from gps_row union all select 'orders', count(*) from fx_line""", "gps_row", "fx_line")
A["stream_gps_ingest"] = sql("select * from gps_row", "gps_row")
A["stream_order_ingest"] = sql("""
select concat(order_id, '_', replace(departure_time, '-', ''), replace(arrive_time, ':', '')) as rowkey, * from fx_line""", "fx_line")
A["stream_active_orders"] = sql(active("fx_gps_s"), "fx_gps_s")
_TRIP = f"""
select '075' as city_code, order_id, {sec('start_time')} as start_time, {sec('end_time')} as end_time,
       get_on_lng, get_on_lat, get_off_lng, get_off_lat from """
A["stream_trip_state"] = sql(_TRIP + "trip_s", "trip_s")
A["trip_state"] = sql(_TRIP + "trip", "trip")
A["hourly_order_count"] = sql(f"select {sec('hour')} as hour, order_count from hourly", "hourly")
A["stream_hourly_orders"] = A["hourly_order_count"]
A["position_queue"] = sql(f"""
select order_id, {mic('ts')} as ts, entry,
       row_number() over (partition by order_id order by ts desc, is_end desc, entry desc) - 1 as queue_index from queue""", "queue")

A["stream_closed_trips"] = sql(f"""
select order_id, {sec('start_time')} as start_time, {sec('end_time')} as end_time, get_on_lng, get_on_lat, get_off_lng, get_off_lat, has_end, n_points
from (
  select order_id, min(ts) filter (not is_end) as start_time, max(ts) filter (not is_end) as end_time,
         arg_min(lng, {{'t': ts, 'x': lng, 'y': lat}}) filter (not is_end) as get_on_lng, arg_min(lat, {{'t': ts, 'x': lng, 'y': lat}}) filter (not is_end) as get_on_lat,
         arg_max(lng, {{'t': ts, 'x': lng, 'y': lat}}) filter (not is_end) as get_off_lng, arg_max(lat, {{'t': ts, 'x': lng, 'y': lat}}) filter (not is_end) as get_off_lat,
         bool_or(is_end) as has_end, count(*) filter (not is_end) as n_points, max(until) as closed_at
  from (
    select *, sum(case when reach is null or ts > reach then 1 else 0 end) over (partition by order_id order by ts, until rows unbounded preceding) as trip
    from (
      select *, max(until) over (partition by order_id order by ts, until rows between unbounded preceding and 1 preceding) as reach
      from (select *, ts + case when is_end then interval 1 second else interval 6 hour end as until from fx_gps_s)))
  group by order_id, trip)
where closed_at <= (select max(ts) from fx_gps_s) - interval 1 hour""", "fx_gps_s")
A["stream_position_queue"] = sql(A["position_queue"][A["position_queue"].rindex("select order_id, "):].replace("from queue", "from queue_s"), "queue_s")
A["stream_position_heads"] = f"select * from ({A['stream_position_queue']}) where queue_index < 3"

# ---- change data ----
_IMAGE = f"""{sec('o_orderdate')} as create_time, cast(cast(o_totalprice as decimal(18,2)) as varchar) as pay_all,
       '' as city_name, o_orderstatus as state, o_orderpriority as order_type"""
_ID = "cast(o_custkey as varchar)"
A["cdc_apply"] = sql(f"""
select {salted(_ID)} as rowkey, {_ID} as id, op as operator_type, {_IMAGE}, '' as driver_id from newest_order""", "newest_order")
A["stream_cdc_apply"] = sql(f"select {salted(_ID)} as rowkey, {_ID} as id, op, {_IMAGE} from newest_order", "newest_order")
A["stream_cdc_compact"] = A["stream_cdc_apply"]
A["cdc_quarantine"] = """
select 'none' as reason, (select count(*) from orders) + (select count(*) from events) + (select count(*) from customer)
       + (select count(*) from supplier) as n_messages
union all select 'unknown_table', count(*) from part
union all select 'not_json', (select count(*) from nation) + (select count(*) from region)
union all select 'no_table', count(*) from nation
union all select 'no_id', (select count(*) from nation) + (select count(*) from region)
union all select 'no_data', count(*) from region"""
A["cdc_apply_renter"] = f"""
select {salted('cast(user_id as varchar)')} as rowkey, cast(user_id as varchar) as id, 'update' as operator_type, '' as create_time,
       '' as last_login_city, {sec('ts')} as last_logon_time, event_type as city_name from events
qualify row_number() over (partition by user_id order by date_trunc('second', ts) desc, event_id desc) = 1"""
A["cdc_apply_driver"] = f"""
select {salted('cast(c_custkey as varchar)')} as rowkey, cast(c_custkey as varchar) as id, 'insert' as operator_type,
       concat(cast(4600 + c_nationkey as varchar), '00') as register_city, c_name as driver_name, c_mktsegment as driver_type,
       '' as mobile from customer"""
A["cdc_apply_alliance"] = """
select cast(s_suppkey as varchar) as id, s_name as alliance_name, unnest([cast(s_nationkey as varchar), 'owner']) as role from supplier"""
A["cdc_route"] = """
select 'order_info' as entity, concat('order_info_', strftime(o_orderdate, '%Y')) as source_table,
       case o_orderstatus when 'F' then 'delete' when 'P' then 'update' else 'insert' end as op, count(*) as n_changes
from orders group by all
union all select 'renter_info', 'renter_info', 'update', count(*) from events
union all select 'driver_info', 'driver_info', 'insert', count(*) from customer
union all select 'opt_alliance_business', 'opt_alliance_business', 'insert', count(*) from supplier"""
_PAY = "cast(cast(o_totalprice as decimal(18,2)) as varchar) as pay_all"
A["cdc_delete_modes"] = sql(f"""
select 'keep' as mode, {_ID} as id, op, {_PAY} from newest_order
union all select 'drop', {_ID}, op, {_PAY} from newest_order where op <> 'delete'
union all select * from (
  select 'ignore', {_ID}, case o_orderstatus when 'P' then 'update' else 'insert' end, {_PAY} from orders where o_orderstatus <> 'F'
  qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)""", "newest_order")

# ---- reports ----
REPORT_SQL: dict[str, tuple[str, tuple[str, ...]]] = {}
REPORT_SQL["completion_city"] = completion("city_name"), ("fx_order",)
REPORT_SQL["completion_driver"] = completion("driver_id"), ("fx_order",)
REPORT_SQL["driver_registrations"] = "select register_city as rk, register_city, " + ", ".join(
    f"count(distinct id) filter (where {t('create_time', D)}) as _register_{n}_num" for n, t in PERIOD.items()
) + f" from fx_driver group by register_city having count(*) filter (where {year('create_time', D)}) > 0", ("fx_driver",)
REPORT_SQL["region_orders"] = _REGION_ORDERS, ("fx_order",)
REPORT_SQL["platform_totals"] = f"""
select '1' as rk, count(*) as "totalOrderNum", count(*) filter (where {month('create_time', O)}) as "monthOrderNum",
       round(count(*) / (date_diff('day', cast(min(create_time) as date), cast(max(create_time) as date)) + 1), 2) as "avgOrderNum",
       sum(charge_mileage) as charge_mileage from fx_order""", ("fx_order",)
REPORT_SQL["income"] = """
select '1' as myid, (select count(*) from fx_order) as "totalCount", (select count(*) from fx_renter) as "registerTotalCount",
       (select round(sum(pay_all), 2) from fx_order) as pay_all""", ("fx_order", "fx_renter")
CTE["both_days"] = f"""
select coalesce(t.code, y.code) as code, t.cell is not null as is_today, y.cell is not null as is_before,
       coalesce(t.cell, y.cell) as cell
from {day_cells(O, 'code')} t full join {day_cells(_BEFORE, 'code')} y on t.cell = y.cell"""
REPORT_SQL["hot_cells"] = """
select code as rk, code as _city_code, count(*) filter (where is_today) as _day_order_num,
       cast(sum(cast(is_today as int) - cast(is_before as int)) as bigint) as _new_orders_num
from both_days group by code having count(*) filter (where is_today) > 0""", ("both_days",)
REPORT_SQL["hot_points"] = f"""
select cell as rk, begin_address_code, {LNG_LAT7} as "centerPoint", 1 as count from gridded
where create_time >= timestamp '2000-01-01'
qualify row_number() over (partition by cell order by create_time desc, id desc) = 1""", ("gridded",)
REPORT_SQL["region_users"] = f"""
select concat(region, '00') as rk, concat(region, '00') as _city_code,
       count(*) filter (where {on_day('create_time', R)}) as _day_new_user,
       count(distinct id) filter (where {on_day('last_logon_time', R)}) as "DAU"
from (select *, substr(last_login_city, 1, 4) as region from fx_renter where last_login_city <> '') group by region
having "DAU" > 0 or _day_new_user > 0""", ("fx_renter",)
REPORT_SQL["new_users"] = "select '1' as myid, " + ", ".join(
    f"""count(*) filter (where {PERIOD[n]('create_time', '2024-01-01')}) as "{n}NewUserCount" """ for n in ("month", "week", "day")
) + " from fx_renter", ("fx_renter",)
REPORT_SQL["active_users"] = "select '1' as rk, " + ", ".join(
    f"""count(distinct id) filter (where {PERIOD[n]('last_logon_time', R)}) as "{k}" """
    for k, n in (("DAU", "day"), ("WAU", "week"), ("MAU", "month"))
) + " from fx_renter", ("fx_renter",)


def kept(day: str, fmt, name: str) -> str:
    return f"""(select {fmt('count(b.id)', 'count(a.id)')} as {name}
  from (select id from fx_renter where {on_day('create_time', day)}) a
  left join (select id from fx_renter where {on_day('last_logon_time', R)}) b on a.id = b.id)"""


REPORT_SQL["retention"] = f"""
select '1' as myid, coalesce(m, '0.0%') as "monthStateRate", coalesce(w, '0.0%') as "weekStateRate",
       coalesce(nullif(d, '%'), '0.0%') as "dayStateRate"
from (select nullif({kept('2024-01-01', pct_raw, 'x')}, '%') as m, nullif({kept('2024-01-23', pct_raw, 'x')}, '%') as w,
             {kept('2024-01-29', pct_decimal, 'x')} as d)""", ("fx_renter",)

from wayfare.plans.serving import SERVED  # noqa: E402

for _name, (_body, _views) in REPORT_SQL.items():
    A[f"report_{_name}"] = sql(_body, *_views)
    A[f"serve_{_name}"] = sql(as_text(_body, list(SERVED[_name])), *_views)

# Spark writes a double of ten million or more with an exponent
_cents = "cast(cast(pay_all as decimal(18,2)) as varchar)"
_digits = f"rtrim(replace({_cents}, '.', ''), '0')"
_pay_text = f"""
case when pay_all < 1e7 then cast(pay_all as varchar)
     else concat(substr({_digits}, 1, 1), '.', case when length({_digits}) = 1 then '0' else substr({_digits}, 2) end,
                 'E', strpos({_cents}, '.') - 2) end"""
A["serve_income"] = A["serve_income"].replace('cast("pay_all" as varchar)', _pay_text)

A["report_hot_change"] = sql(f"""
select code as city_code, {LAT_LNG7} as coordinate, cell, 1200 as radius, cast(is_today as int) - cast(is_before as int) as count
from both_days""", "both_days")
A["report_completion_city_iso_week"] = sql(completion("city_name", iso=True), "fx_order")
A["report_virtual_stations"] = sql("select * from placed", "placed")
A["report_station_counts"] = sql("select district_name, count(*) as count from placed group by 1", "placed")
A["stations_query"] = sql("select city_id, district_name, lng, lat from placed where city_id = '4603'", "placed")
A["stations_count"] = sql("select district_name, count(*) as count from placed where city_id = '4603' group by 1", "placed")
A["day_overview"] = sql("""
select cast(coalesce(a.day, b.day) as varchar) as day, coalesce(order_count, 0) as order_count, coalesce(passenger_count, 0) as passenger_count
from (select cast(hour as date) as day, cast(sum(order_count) as bigint) as order_count from hourly group by 1) a
full join (select cast(l_shipdate as date) as day, cast(sum(cast(l_quantity as int) % 4 + 1) as bigint) as passenger_count
           from lineitem group by 1) b on a.day = b.day""", "hourly")

# ---- metrics ----
A["progress_flags"] = """
select batch_id, num_input_rows, gc_ms, cents // 2 + num_input_rows + 7 as total_duration_ms, cents // 2 > 30000 as is_blocked,
       round(gc_ms * 100e0 / greatest(cents // 2, 1), 2) as gc_percent,
       round(gc_ms * 100e0 / greatest(cents // 2, 1), 2) > 30e0 as gc_warning
from (select cast(epoch(date_trunc('hour', ts)) as bigint) as batch_id, count(*) as num_input_rows,
             cast(sum(cast(round(value * 100) as bigint)) as bigint) as cents,
             cast(sum(case when event_type = 'error' then cast(round(value * 100) as bigint) else 0 end) as bigint) as gc_ms
      from events group by 1)"""
A["task_metrics"] = """
select cast(l_linenumber as bigint) as stage_id, count(*) as n_tasks, count(*) filter (where l_returnflag = 'R') as n_failed,
       cast(max(l_quantity) * 12 as bigint) as longest_ms, cast(sum(l_quantity) * 10 as bigint) as run_ms,
       cast(sum(l_quantity) as bigint) as gc_ms, cast(0 as bigint) as memory_spilled, cast(sum(l_quantity) * 3 as bigint) as disk_spilled,
       cast(sum(l_quantity) * 7 as bigint) as shuffle_bytes_written, cast(sum(l_quantity) * 5 as bigint) as shuffle_records_read,
       cast(sum(l_quantity) * 11 as bigint) as input_bytes, cast(sum(l_partkey) as bigint) as input_records
from lineitem group by l_linenumber"""


def ratio(part: str, whole: str) -> str:
    return f"coalesce(cast(round_even({part} * 100e0 / nullif({whole}, 0), 2) as double), 0e0) as {part}_percent"


_STAGE, _BATCH = "(failed_stages + running_stages + waiting_stages)", "(running_batches + waiting_batches + completed_batches)"
_MEM = "(mem_used_mb + remaining_mem_mb)"
A["metrics_ratios"] = sql("select snapshot_ms, " + ", ".join(
    [ratio(p, _STAGE) for p in ("failed_stages", "running_stages", "waiting_stages")]
    + [ratio(p, _BATCH) for p in ("running_batches", "waiting_batches", "completed_batches")]
    + [ratio(p, _MEM) for p in ("mem_used_mb", "remaining_mem_mb", "max_mem_mb")]
) + " from gauge", "gauge")

# ---- entries that write and read back, and streams ----
A["scan_driver"] = sql(f"""
select id, {sec('create_time')} as create_time, register_city, driver_name, cast(null as varchar) as mobile,
       cast(null as varchar) as driver_type, cast(null as integer) as cancel_count, cast(null as varchar) as driver_management_id
from fx_driver""", "fx_driver")
A["scan_renter"] = sql(f"""
select id, {sec('create_time')} as create_time, last_login_city, {sec('last_logon_time')} as last_logon_time,
       cast(null as varchar) as city_name from fx_renter""", "fx_renter")
A["track_history_order"] = sql(f"select * from ({_TRACK.replace('@', '>=')}) where order_id = '0_2024-01-01'", "trip")
A["stream_hourly_first"] = A["stream_hourly_orders"]
A["stream_offsets"] = sql("""
select cast(event_id % 4 as int) as partition, count(*) as n_records, count(*) as n_offsets, 0::bigint as first_offset, count(*) - 1 as last_offset,
       sum(length(case when event_type = 'purchase' then concat('end,', user_id, '_', cast(ts as date))
                       else concat_ws(',', user_id, concat(user_id, '_', cast(ts as date)), cast(floor(epoch(ts)) as bigint),
                                      cast(104e0 + value / 1e3 as varchar), cast(306e-1 + cast(event_id % 1000 as double) / 1e4 as varchar)) end)) as n_chars,
       max(event_id) as last_event
from events group by 1""")
A["stream_trigger"] = sql("select count(*) as n_rows, count(distinct orderid) as n_orders from gps_row", "gps_row")
A["stream_query_events"] = """
select event, 1::bigint as n_events, (select count(*) from events) as n_rows from (values ('started'), ('terminated')) as kinds(event)"""
A["stream_cdc_deletes"] = A["cdc_delete_modes"]
A["stream_routed_ingest"] = A["stream_fanout"] + " union all select 'quarantine', 0"
A["stream_progress"] = """
select 'progress' as query_name, count(*) as n_rows, count(*) as n_source_rows, 1 as n_batches from events"""
A["write_stations"] = A["report_virtual_stations"]
A["report_upsert"] = sql("""
select driver_id, n_orders, day from (
  select driver_id, cast(cast(create_time as date) as varchar) as day, count(*) as n_orders from fx_order
  where cast(create_time as date) in (date '1998-07-14', date '1998-07-15') group by 1, 2)
qualify row_number() over (partition by driver_id order by day desc) = 1""", "fx_order")

# rows of every report of the batch, whose date is that of the orders
_BATCH_ROWS = {name: A[f"report_{name}"] for name in (
    "completion_city", "completion_driver", "region_orders", "platform_totals", "income", "hot_cells", "new_users", "active_users",
    "retention", "virtual_stations",
)}
_BATCH_ROWS["driver_registrations"] = sql(
    f"select register_city from fx_driver group by 1 having count(*) filter (where {year('create_time', O)}) > 0", "fx_driver")
_BATCH_ROWS["hot_points"] = A["report_hot_points"].replace("2000-01-01", O)
_BATCH_ROWS["region_users"] = A["report_region_users"].replace(R, O)
A["batch_run_all"] = " union all ".join(
    f"select '{name}' as source, count(*) as n_rows from ({body})" for name, body in _BATCH_ROWS.items()
)

_BATCH_KEYS = {name: "rk" for name in ("region_orders", "platform_totals", "hot_points", "region_users", "active_users")}
_BATCH_KEYS |= {name: "myid" for name in ("income", "new_users", "retention")} | {
    "completion_city": "city_name", "completion_driver": "driver_id", "driver_registrations": "register_city", "hot_cells": "_city_code",
    "virtual_stations": "order_id",
}
A["batch_upsert"] = " union all ".join(
    f"select '{name}' as source, count(distinct {_BATCH_KEYS[name]}) as n_rows from ({body})" for name, body in _BATCH_ROWS.items()
)
for _name in ("completion_city", "completion_driver", "driver_registrations", "region_orders", "platform_totals"):
    A[f"report_{_name}_incremental"] = A[f"report_{_name}"]
A["rolling_active_users"] = f"""
with logon as (select distinct user_id as u, cast(ts as date) as d from events where event_type = 'purchase'),
days as (select cast(unnest(generate_series(date '{R}' - interval 59 day, date '{R}', interval 1 day)) as date) as day)
select day, count(distinct u) filter (where d = day) as "DAU",
       count(distinct u) filter (where d > day - interval 7 day) as "WAU", count(distinct u) as "MAU"
from days left join logon on d <= day and d > day - interval 30 day group by day"""
A["rolling_retention"] = f"""
with created as (select distinct user_id as u, cast(ts as date) as day from events where event_type = 'signup'),
logged as (select distinct user_id as u, cast(ts as date) as d from events where event_type = 'purchase')
select day, days_after, count(*) as cohort, count(l.u) as retained
from created c cross join (values (1), (7), (30)) as after(days_after)
left join logged l on l.u = c.u and l.d = cast(day + to_days(days_after) as date)
where day between date '2023-12-02' and date '{R}' group by day, days_after"""
