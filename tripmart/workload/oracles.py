"""The same queries as SQL for DuckDB.

They follow the order in which the results are defined (join, filter, then dedupe), not
the order in which the Spark plans compute them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from tripmart.functions import globe
from tripmart.functions.cells import (
    AXIS_OFFSET,
    AXIS_SPAN,
    METRES_PER_LAT,
    METRES_PER_LON,
    SQRT3_THIRD,
    TWO_THIRDS,
    edge_metres,
)
from tripmart.functions.codes import OTHER_PAYMENT, PAYMENT_LABELS
from tripmart.plans import audit
from tripmart.plans.gold import FACT_COLUMNS, FACT_NAMES
from tripmart.plans.silver import TIE_BREAKERS
from tripmart.schemas import BRONZE_COLUMNS, SILVER_COLUMNS, TIME_COLUMNS, TRIP_COLUMNS, TRIP_SCHEMA
from tripmart.sources.trips import NATURAL_KEY
from tripmart.workload.adapter import (
    BATCHES_SQL,
    GLOBE_SQL,
    PLACES_SQL,
    RAW_FILE_SQL,
    RESOLUTIONS,
    TEXT_SQL,
    TIES,
    TRIPS_SQL,
    ZONES_SQL,
)

_SQL_TYPES = {"integer": "int", "double": "double", "string": "varchar"}

_TABLES = {
    name: name for name in ("lineitem", "orders", "customer", "supplier", "nation", "region")
}


def _cells(res: int, source: str) -> str:
    edge = f"{edge_metres(res)!r}e0"
    return f"""
select LocationID, zone_name, borough, lat, lon,
  case when lat <> 0 and lon <> 0 then lpad(lower(to_hex(
    {res} * {AXIS_SPAN}::bigint * {AXIS_SPAN}::bigint
    + (q + {AXIS_OFFSET}) * {AXIS_SPAN}::bigint + (r + {AXIS_OFFSET}))), 15, '0') end as cell
from (
  select *,
    cast(case when dx > dy and dx > dz then -ry - rz else rx end as bigint) as q,
    cast(case when dx > dy and dx > dz then rz when dy > dz then rz
              else -rx - ry end as bigint) as r
  from (
    select *, abs(rx - x) as dx, abs(ry - y) as dy, abs(rz - z) as dz
    from (
      select *, floor(x + 0.5e0) as rx, floor(y + 0.5e0) as ry, floor(z + 0.5e0) as rz
      from (
        select *, -x - z as y
        from (
          select LocationID, Zone as zone_name, Borough as borough, lat, lon,
            ({SQRT3_THIRD}e0 * (lon * {METRES_PER_LON}e0) - (lat * {METRES_PER_LAT}e0) / 3.0e0)
              / {edge} as x,
            ({TWO_THIRDS}e0 * (lat * {METRES_PER_LAT}e0)) / {edge} as z
          from {source}
        )
      )
    )
  )
)
"""


def _measured(source: str) -> str:
    return f"""
select *,
  date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0e0
    as trip_duration_minutes,
  case when trip_distance > 0 then fare_amount / trip_distance end as fare_per_mile
from {source}
"""


def _enriched(source: str) -> str:
    return f"""
select m.*,
  p.zone_name as pickup_zone, p.borough as pickup_borough, p.lat as pu_lat, p.lon as pu_lon,
  d.zone_name as dropoff_zone, d.borough as dropoff_borough, d.lat as do_lat, d.lon as do_lon,
  p.cell as pickup_h3, d.cell as dropoff_h3
from {source} m
left join cells p on m.PULocationID = p.LocationID
left join cells d on m.DOLocationID = d.LocationID
"""


def _numbers(values) -> str:
    return "[" + ", ".join(f"{v!r}e0" if "e" not in repr(v) else f"cast('{v!r}' as double)" for v in values) + "]"


def _hexagons(source: str, kept: str) -> str:
    """Face and axial coordinates (q, r) of the points (x, y, z) of ``source``, at their ``res``."""
    planes = globe.faces()
    dots = ", ".join(f"x * {c[0]!r}e0 + y * {c[1]!r}e0 + z * {c[2]!r}e0" for c, _, _ in planes)

    def axis(k: int) -> str:
        return " + ".join(f"{v} * {_numbers([p[k][i] for p in planes])}[face + 1]" for i, v in enumerate("xyz"))

    inverse = [1 / b for b in globe.bases()]
    real, imag = _numbers([i.real for i in inverse]), _numbers([i.imag for i in inverse])
    root = math.sqrt(3)
    return f"""
select {kept}, res, face,
  cast(case when da > db and da > dc then -rb - rc else ra end as bigint) as q,
  cast(case when da > db and da > dc then rb when db > dc then -ra - rc else rb end as bigint) as r
from (
  select *, abs(ra - a) as da, abs(rb - b) as db, abs(rc - c) as dc from (
    select *, floor(a + 0.5e0) as ra, floor(b + 0.5e0) as rb, floor(c + 0.5e0) as rc from (
      select *, -a - b as c from (
        select *, across + up / {root!r}e0 as a, up * {-2 / root!r}e0 as b from (
          select *, u * {real}[res + 1] - v * {imag}[res + 1] as across,
            u * {imag}[res + 1] + v * {real}[res + 1] as up
          from (
            select *, sqrt(2.0e0 / (1.0e0 + top)) * ({axis(1)}) as u, sqrt(2.0e0 / (1.0e0 + top)) * ({axis(2)}) as v
            from (
              select *, cast(list_position(dots, list_max(dots)) - 1 as int) as face, list_max(dots) as top
              from (select *, [{dots}] as dots from {source})
            )
          )
        )
      )
    )
  )
)
"""


def _globe_id(res: str, face: str, q: str, r: str) -> str:
    bits, offset = globe.AXIS_BITS, globe.AXIS_OFFSET
    return (
        f"lpad(lower(to_hex(cast({res} as bigint) * {1 << (globe.FACE_BITS + 2 * bits)} + cast({face} as bigint) * {1 << (2 * bits)}"
        f" + ({q} + {offset}) * {1 << bits} + ({r} + {offset}))), 15, '0')"
    )


def _globe_cells() -> str:
    planes, steps = globe.faces(), globe.bases()
    real, imag = _numbers([s.real for s in steps]), _numbers([s.imag for s in steps])

    def lifted(i: int) -> str:
        c, e, n = (_numbers([p[k][i] for p in planes]) for k in range(3))
        return f"d * {c}[face + 1] + shrink * (u * {e}[face + 1] + v * {n}[face + 1])"

    up_rounded = """
      cast(case when da > db and da > dc then -rb - rc else ra end as bigint) as pq,
      cast(case when da > db and da > dc then rb when db > dc then -ra - rc else rb end as bigint) as pr"""
    return f"""
with places as ({GLOBE_SQL.format(customer="customer")}),
located as (
  select LocationID, res, cos(radians(lat)) * cos(radians(lon)) as x, cos(radians(lat)) * sin(radians(lon)) as y,
    sin(radians(lat)) as z
  from places cross join (values (4), (9)) t(res) where lat <> 0 and lon <> 0
), cells as ({_hexagons("located", "LocationID")}
), parents as (
  select LocationID, res, {_globe_id("res - 1", "face", "pq", "pr")} as parent from (
    select *, {up_rounded} from (
      select *, abs(ra - a) as da, abs(rb - b) as db, abs(rc - c) as dc from (
        select *, floor(a + 0.5e0) as ra, floor(b + 0.5e0) as rb, floor(c + 0.5e0) as rc from (
          select *, -a - b as c from (
            select *, case when res % 2 = 1 then 2.0e0 * q - r else 3.0e0 * q + r end / 7 as a,
              -(case when res % 2 = 1 then -3.0e0 * r - q else q - 2.0e0 * r end / 7) as b
            from cells
          )
        )
      )
    )
  )
), around as (
  select LocationID, res, face, q + dq as q, r + dr as r
  from cells cross join (values (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)) t(dq, dr)
), steps as (
  select LocationID, res, {lifted(0)} as x, {lifted(1)} as y, {lifted(2)} as z from (
    select *, 1.0e0 - (u * u + v * v) / 2 as d, sqrt(1.0e0 - (u * u + v * v) / 4) as shrink from (
      select *, across * {real}[res + 1] - up * {imag}[res + 1] as u, across * {imag}[res + 1] + up * {real}[res + 1] as v
      from (select *, q + r / 2.0e0 as across, -r * {math.sqrt(3) / 2!r}e0 as up from around)
    )
  )
), beside as ({_hexagons("steps", "LocationID")}
), named as (
  select LocationID, res, {_globe_id("res", "face", "q", "r")} as cell from cells
), listed as (
  select b.LocationID, b.res, string_agg(distinct b.near, ',' order by b.near) as neighbours
  from (select LocationID, res, {_globe_id("res", "face", "q", "r")} as near from beside) b
  join named n on n.LocationID = b.LocationID and n.res = b.res and n.cell <> b.near
  group by b.LocationID, b.res
)
select p.LocationID, t.res, n.cell, a.parent, l.neighbours
from places p cross join (values (4), (9)) t(res)
left join named n on n.LocationID = p.LocationID and n.res = t.res
left join parents a on a.LocationID = p.LocationID and a.res = t.res
left join listed l on l.LocationID = p.LocationID and l.res = t.res
"""


_CTES = {
    "trips": TRIPS_SQL.format(**_TABLES),
    "zone_file": ZONES_SQL.format(**_TABLES),
    "places": PLACES_SQL.format(**_TABLES),
    "raw_file": RAW_FILE_SQL.format(trips="trips"),
    "text_trips": TEXT_SQL.format(trips="trips"),
    "cells": _cells(9, "zone_file"),
    "measured": _measured("trips"),
    "enriched": _enriched("measured"),
    "arrived": "\nunion all\n".join(text.format(trips="trips") for text in BATCHES_SQL.values()),
    "arrived_measured": _measured("arrived"),
    "arrived_enriched": _enriched("arrived_measured"),
}


def _latest(
    source: str, columns: str = "* exclude (rn)", where: str = "true", ties: Sequence[str] = TIES
) -> str:
    order = ", ".join(f"{name} desc nulls last" for name in ["_ingest_ts", *ties])
    return f"""
select {columns} from (
  select *, row_number() over (
    partition by trip_id, tpep_pickup_datetime
    order by {order}) as rn
  from {source} where {where}
) where rn = 1
"""


_VALID = "fare_amount >= 0 and trip_duration_minutes >= 0"
_CTES["silver"] = _latest("enriched", ", ".join(SILVER_COLUMNS), _VALID)
_CTES["early_silver"] = _latest(
    "enriched",
    ", ".join(SILVER_COLUMNS),
    f"{_VALID} and _ingest_ts <= timestamp '2024-01-01 00:15:00'",
)
_CTES["arrived_silver"] = _latest(
    "arrived_enriched", ", ".join(SILVER_COLUMNS), _VALID, TIE_BREAKERS
)

_LABEL = (
    "case payment_type "
    + " ".join(f"when {code} then '{text}'" for code, text in PAYMENT_LABELS.items())
    + f" else '{OTHER_PAYMENT}' end"
)
_FACT = ", ".join(
    f"{name} as {FACT_NAMES[name]}" if name in FACT_NAMES else name for name in FACT_COLUMNS
)
_CTES["fact"] = f"select {_FACT} from silver"
_CTES["early_fact"] = f"select {_FACT} from early_silver"
_CTES["payments"] = f"select distinct payment_type, {_LABEL} as payment_description from silver"
_CTES["zone_rows"] = """
select PULocationID as location_id, pickup_zone as zone_name, pickup_borough as borough,
  pickup_h3 as zone_h3 from silver
union
select DOLocationID, dropoff_zone, dropoff_borough, dropoff_h3 from silver
"""

# What each statement is built on, in the order the definitions need.
_NEEDS = {
    "raw_file": ["trips"],
    "text_trips": ["trips"],
    "cells": ["zone_file"],
    "measured": ["trips"],
    "enriched": ["measured", "cells"],
    "silver": ["enriched"],
    "early_silver": ["enriched"],
    "arrived": ["trips"],
    "arrived_measured": ["arrived"],
    "arrived_enriched": ["arrived_measured", "cells"],
    "arrived_silver": ["arrived_enriched"],
    "fact": ["silver"],
    "early_fact": ["early_silver"],
    "payments": ["silver"],
    "zone_rows": ["silver"],
}


def _with(final: str, *bases: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for base in bases:
        add(base)
    parts = ",\n".join(f"{name} as ({_CTES[name]})" for name in ordered)
    return f"with {parts}\n{final}"


def _total(column: str) -> str:
    res = f"{RESOLUTIONS[column]}.0e0"
    return f"cast(sum(cast(floor({column} * {res} + 0.5e0) as bigint)) as double) / {res}"


def _mean(column: str) -> str:
    return f"{_total(column)} / count({column})"


def _raw_field(name: str) -> str:
    source = {"vendor_id": "VendorID", "airport_fee": "Airport_fee"}.get(name, name)
    optional = {"passenger_count", "RatecodeID", "congestion_surcharge", "airport_fee"}
    integers = {
        "vendor_id",
        "passenger_count",
        "RatecodeID",
        "PULocationID",
        "DOLocationID",
        "payment_type",
    }
    if name in TIME_COLUMNS or name == "store_and_fwd_flag":
        return f"cast({source} as varchar) as {name}"
    value = f"try_cast({source} as {'int' if name in integers else 'double'})"
    return f"{value} as {name}" if name in optional else f"coalesce({value}, 0) as {name}"


_NORMALIZED = "select " + ", ".join(
    _raw_field(name) for name in TRIP_COLUMNS if name != "trip_id"
)
_DIGEST = "concat_ws('|', " + ", ".join(
    f"coalesce(cast({name} as varchar), '\\N')" for name in NATURAL_KEY
) + ")"

# The raw file as it is in bronze: the digest is over what the file holds, the columns beyond
# the trip record behind the others.
_FILE = (
    "select * exclude (VendorID, Airport_fee, fare_amount), VendorID as vendor_id, "
    "Airport_fee as airport_fee, "
    "case when payment_type = 6 then 'n/a' else cast(fare_amount as varchar) end as fare_amount, "
    "'c' || cast(VendorID as varchar) as cab_colour from raw_file"
)
_FILE_DIGEST = "concat_ws('|', " + ", ".join(
    f"coalesce(cast({name} as varchar), '\\N')" for name in [*NATURAL_KEY, "cab_colour"]
) + ")"
_SEEDED = (
    f"select concat('trip_', sha256({_FILE_DIGEST})) as trip_id, "
    + ", ".join(
        f"cast({f.name} as {_SQL_TYPES[f.dataType.typeName()]}) as {f.name}"
        if f.name != "fare_amount"
        else "try_cast(fare_amount as double) as fare_amount"
        for f in TRIP_SCHEMA
        if f.name != "trip_id"
    )
    + ", timestamp '2024-02-01' as _ingest_ts, 'historical_parquet' as record_source, "
    + f"cab_colour from ({_FILE})"
)

_TEXT_TRIPS = ", ".join(
    f"cast({name} as varchar) as {name}" if name in TIME_COLUMNS else name
    for name in TRIP_COLUMNS
)
_TYPED = """
select trip_id,
  try_cast(vendor_id as int) as vendor_id,
  try_cast(tpep_pickup_datetime as timestamp) as tpep_pickup_datetime,
  try_cast(tpep_dropoff_datetime as timestamp) as tpep_dropoff_datetime,
  try_cast(passenger_count as int) as passenger_count,
  try_cast(trip_distance as double) as trip_distance,
  try_cast(RatecodeID as int) as RatecodeID,
  try_cast(PULocationID as int) as PULocationID,
  try_cast(DOLocationID as int) as DOLocationID,
  try_cast(payment_type as int) as payment_type,
  try_cast(fare_amount as double) as fare_amount,
  try_cast(tip_amount as double) as tip_amount,
  try_cast(total_amount as double) as total_amount
from text_trips
"""


def _hourly(source: str) -> str:
    return f"""
select strftime(tpep_pickup_datetime, '%Y-%m-%d %H:00:00') as pickup_hour,
  pickup_h3, pickup_zone, count(trip_id) as trip_count,
  {_mean('fare_amount')} as avg_fare,
  {_mean('trip_duration_minutes')} as avg_trip_duration_minutes
from {source} group by 1, 2, 3
"""


def _daily(source: str) -> str:
    return f"""
select strftime(tpep_pickup_datetime, '%Y-%m-%d') as trip_date, vendor_id,
  count(trip_id) as total_trips, {_total('total_amount')} as total_revenue,
  {_mean('fare_amount')} as avg_fare, {_mean('trip_distance')} as avg_distance
from {source} group by 1, 2
"""


def _heatmap(source: str) -> str:
    return f"""
select pickup_h3, count(trip_id) as trip_count, {_mean('fare_amount')} as avg_fare,
  {_mean('trip_duration_minutes')} as avg_trip_duration_minutes
from {source} group by 1
"""


_HOURLY = _hourly("silver")

_STAR = f"""
select p.borough as pickup_borough, d.borough as dropoff_borough, payment_description,
  count(trip_id) as total_trips, {_total('total_amount')} as total_revenue
from fact
left join payments using (payment_type)
left join (select location_id, any_value(borough) as borough from zone_rows group by 1) p
  on pickup_location_id = p.location_id
left join (select location_id, any_value(borough) as borough from zone_rows group by 1) d
  on dropoff_location_id = d.location_id
group by 1, 2, 3
"""

_INCREMENT = """
, increment as (
  select * exclude (rn) from (
    select *, row_number() over (partition by trip_id
      order by _ingest_ts desc, tpep_pickup_datetime desc) as rn
    from fact
    where _ingest_ts > (select coalesce(max(_ingest_ts), timestamp '1900-01-01') from early_fact)
  ) where rn = 1
), upserted as (
  select * from early_fact where trip_id not in (select trip_id from increment)
  union all
  select * from increment
)
"""
_INCREMENTAL = f"{_INCREMENT} select * from upserted"

# Three aggregates in the columns of all of them.
_INCREMENTAL_AGGREGATES = f"""{_INCREMENT}
select 'agg_daily_revenue' as aggregate, *, null as pickup_hour, null as pickup_h3, null as pickup_zone,
  null as trip_count, null as avg_trip_duration_minutes from ({_daily("upserted")})
union all by name
select 'agg_hourly_demand' as aggregate, * from ({_hourly("upserted")})
union all by name
select 'agg_demand_heatmap' as aggregate, * from ({_heatmap("upserted")})
"""

# A folder of files with three schemas: numbers become wider, a name changes its case, a column
# comes and one goes.
_DRIFTED = """
select cast(trip_id as varchar) as trip_id, cast(passenger_count as varchar) as passenger_count,
  cast(PULocationID as bigint) as PULocationID, fare_amount, airport_fee as Airport_fee,
  cast(null as varchar) as cab_colour, store_and_fwd_flag
from trips where vendor_id = 1 and payment_type < 4
union all
select trip_id, cast(passenger_count as varchar), cast(PULocationID as bigint),
  cast(floor(fare_amount) as double), airport_fee, concat('c', vendor_id), null
from trips where vendor_id = 2
union all
select trip_id, case when passenger_count = 3 then 'n/a' else cast(passenger_count as varchar) end,
  cast(PULocationID as bigint), fare_amount, null, null, store_and_fwd_flag
from trips where vendor_id = 1 and payment_type >= 4
"""



def _message_fields(**changed: str) -> str:
    fields = {name: name for name in TRIP_COLUMNS} | {
        name: f"cast({name} as varchar)" for name in TIME_COLUMNS
    }
    return ", ".join(f"{text} as {name}" for name, text in (fields | changed).items())


# CRC-32 of a key, which tells what becomes of its message: the polynomial, lowest bit first.
_CRC_STEPS = """
crc_steps as (
  select list(step order by b) as steps from (
    select b, list_reduce(list_prepend(b, range(0, 8)),
      lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as step
    from range(256) t(b)
  )
)"""
_CRC = (
    "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(trip_id, ''), lambda x: cast(ord(x) as bigint))),"
    " lambda c, x: xor(steps[xor(c & 255, x) + 1], c >> 8)), 4294967295)"
)

# Which writer a trip's message has, its number, and the fields as the reader gets them.
_MESSAGES = f"""
, {_CRC_STEPS}, numbered as (select trips.*, {_CRC} as number from trips cross join crc_steps
), messages as (
  select {_message_fields()}, cast(11 as bigint) as frame_schema_id, number from numbered where vendor_id = 1 and payment_type < 4
  union all
  select {_message_fields(passenger_count="null", trip_distance="cast(cast(trip_distance as bigint) as double)", store_and_fwd_flag="null", extra="0.0e0", tolls_amount="0.0e0", airport_fee="null")},
    12, number from numbered where vendor_id = 2
  union all
  select {_message_fields()}, 13, number from numbered where vendor_id = 1 and payment_type >= 4
)
"""
_LANDED = f"{_MESSAGES} select * exclude (number) from messages where number % 11 > 3"
_SIDES = f"""{_MESSAGES}
select side, reason, frame_schema_id, count(*) as messages, count(distinct number) as offsets,
  cast(sum(number) as bigint) as offset_sum
from (
  select case when number % 11 > 3 then 'landed' else 'quarantine' end as side, number,
    case number % 11 when 0 then 'unknown schema id' when 1 then 'malformed record'
      when 2 then 'no frame' when 3 then 'no value for trip_id' end as reason,
    case number % 11 when 0 then 99 when 2 then null else frame_schema_id end as frame_schema_id
  from messages
)
group by all
"""


def _report(source: str, rows: list[tuple[str, str, str, str, str]]) -> str:
    """Report rows (check, column, unexpected, observed, success) over one source."""
    return "\nunion all\n".join(
        f"select '{check}' as check_name, '{column}' as column_name, "
        f"count(*) as element_count, cast({unexpected} as bigint) as unexpected_count, "
        f"cast({observed} as double) as observed_value, {success} as success from {source}"
        for check, column, unexpected, observed, success in rows
    )


def _rows_check(kind: str, column: str, bad: str) -> tuple[str, str, str, str, str]:
    count = f"coalesce(sum(case when {bad} then 1 else 0 end), 0)"
    return kind, column, count, "null", f"{count} = 0"


def _between(column: str, limits: tuple[int, int]) -> tuple[str, str, str, str, str]:
    return _rows_check("between", column, f"{column} not between {limits[0]} and {limits[1]}")


def _repeats(source: str, keys: str, count: str) -> str:
    return (
        f"(select coalesce(sum({count}), 0) from "
        f"(select count(*) as n from {source} group by {keys} having count(*) > 1))"
    )


def _keyed(kind: str, source: str, keys: str, count: str) -> tuple[str, str, str, str, str]:
    bad = _repeats(source, keys, count)
    return kind, keys, bad, "null", f"{bad} = 0"


_PAIR = "trip_id,tpep_pickup_datetime"
_SILVER_SUITE = _report(
    "silver",
    [
        ("row_count", "", "null", "count(*)", "count(*) > 0"),
        ("exists", "trip_id", "0", "null", "true"),
        ("exists", "vendor_id", "0", "null", "true"),
        _rows_check("not_null", "tpep_pickup_datetime", "tpep_pickup_datetime is null"),
        _rows_check("not_null", "pickup_h3", "pickup_h3 is null"),
        _between("passenger_count", audit.PASSENGER_RANGE),
        _between("fare_amount", audit.FARE_RANGE),
        _between("trip_duration_minutes", audit.DURATION_RANGE),
        _rows_check("regex", "pickup_h3", f"not regexp_matches(pickup_h3, '{audit.CELL_PATTERN}')"),
        _keyed("unique", "silver", _PAIR, "n"),
    ],
)
_METRIC_SUITE = _report(
    "silver",
    [
        ("row_count", "", "null", "count(*)", "count(*) > 0"),
        _rows_check("not_null", "trip_id", "trip_id is null"),
        _keyed("duplicates", "silver", "trip_id", "1"),
        ("minimum", "fare_amount", "null", "min(fare_amount)", "min(fare_amount) >= 0"),
        (
            "maximum",
            "fare_amount",
            "null",
            "max(fare_amount)",
            f"max(fare_amount) < {audit.FARE_CEILING}",
        ),
    ],
)

_SPARK_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "timestamp": "TIMESTAMP"}
_SCHEMA_SUITE = _report(
    "silver",
    [
        (
            "type",
            name,
            f"case when any_value(typeof({name})) = '{_SPARK_TYPES[spark_type]}' "
            "then 0 else count(*) end",
            "null",
            f"any_value(typeof({name})) = '{_SPARK_TYPES[spark_type]}'",
        )
        for name, spark_type in audit.DECLARED_TYPES.items()
    ],
)


def _verdict(name: str, report: str) -> str:
    return (
        "select count(*) as checks, count(*) filter (where not success) as failed, "
        f"bool_and(success) as success, '{name}' as suite from ({report})"
    )


def _orphans(relation: str, column: str, known: str) -> str:
    return (
        f"select count(distinct {column}) as orphan_keys, count(*) as orphan_rows, "
        f"'{relation}' as relation from trips where {column} not in ({known})"
    )


_DQ_ORPHANS = "\nunion all\n".join(
    [
        _orphans("payment", "payment_type", "select payment_type from payments"),
        _orphans("pickup", "PULocationID", "select LocationID from zone_file"),
        _orphans("dropoff", "DOLocationID", "select LocationID from zone_file"),
    ]
)


def oracle_sql() -> dict[str, str]:
    all_cells = "\nunion all\n".join(
        f"select *, {res} as res from ({_cells(res, 'places')})" for res in (7, 9, 12)
    )
    decoded = f"select {_TEXT_TRIPS}"
    bronze = ", ".join(name for name in BRONZE_COLUMNS if name not in TRIP_COLUMNS)
    return {
        "scan_history": "select cast(l_orderkey as varchar) as trip_id, * exclude (l_orderkey) from lineitem",
        "named_source": _with(
            "select payment_type, count(*) as trips, max(fare_amount) as max_fare "
            "from trips group by payment_type",
            "trips",
        ),
        "seeded_bronze": _with(_SEEDED, "raw_file"),
        "bronze_rerun": _with(
            f"select 'kafka_live' as record_source, 12.0e0 as fare_amount, "
            f"count(distinct trip_id) as trips from ({_SEEDED})",
            "raw_file",
        ),
        "gated_rejection": _with(
            "select 'rejected' as run, 'silver' as layer, cast(0 as bigint) as trips "
            "union all select 'rejected', 'fact', 0 "
            "union all select 'published', 'silver', count(*) from silver "
            "union all select 'published', 'fact', count(distinct trip_id) from silver",
            "silver",
        ),
        "zone_lookup": _with(
            "select try_cast(LocationID as int) as LocationID, Zone as zone_name, "
            "Borough as borough, lat, lon from places",
            "places",
        ),
        "normalize_trips": _with(f"{_NORMALIZED} from raw_file", "raw_file"),
        "first_trips": _with(
            "select trip_id, tpep_pickup_datetime, total_amount from trips "
            "order by tpep_pickup_datetime, trip_id, _ingest_ts, _tie1, _tie2 limit 10000",
            "trips",
        ),
        "surrogate_trip_id": _with(
            f"select concat('trip_', sha256({_DIGEST})) as trip_id, * "
            f"from ({_NORMALIZED} from raw_file)",
            "raw_file",
        ),
        "typed_trips": _with(_TYPED, "text_trips"),
        "trip_metrics": _with(
            "select trip_id, _tie1, _tie2, trip_duration_minutes, fare_per_mile from measured",
            "measured",
        ),
        "valid_trips": _with(
            f"select * exclude (trip_duration_minutes, fare_per_mile) from measured where {_VALID}",
            "measured",
        ),
        "zone_cells": _with(all_cells, "places"),
        "globe_cells": _globe_cells(),
        "enrich_zones": _with(
            "select trip_id, tpep_pickup_datetime, PULocationID, DOLocationID, _tie1, _tie2, "
            "pickup_zone, pickup_borough, pu_lat, pu_lon, pickup_h3, "
            "dropoff_zone, dropoff_borough, do_lat, do_lon, dropoff_h3 from enriched",
            "enriched",
        ),
        "latest_per_key": _with(_latest("trips"), "trips"),
        "silver_trips": _with("select * from silver", "silver"),
        "fact_trips_raw": _with(f"select {', '.join(FACT_COLUMNS)} from silver", "silver"),
        "fact_trips": _with("select * from fact", "fact"),
        "fact_by_file": _with(_INCREMENTAL, "fact", "early_fact"),
        "fact_incremental": _with(_INCREMENTAL, "fact", "early_fact"),
        "daily_revenue": _with(_daily("silver"), "silver"),
        "hourly_demand": _with(_HOURLY, "silver"),
        "demand_heatmap": _with(_heatmap("silver"), "silver"),
        "drifting_history": _with(_DRIFTED, "trips"),
        "incremental_aggregates": _with(_INCREMENTAL_AGGREGATES, "fact", "early_fact"),
        "incremental_silver": _with("select * from arrived_silver", "arrived_silver"),
        "incremental_demand": _with(_hourly("arrived_silver"), "arrived_silver"),
        "dim_payment": _with("select * from payments", "payments"),
        "dim_zone": _with(
            "select location_id, any_value(zone_name) as zone_name, any_value(borough) as borough, "
            "any_value(zone_h3) as zone_h3 from zone_rows group by 1",
            "zone_rows",
        ),
        "zone_tuples": _with("select * from zone_rows", "zone_rows"),
        "star_revenue": _with(_STAR, "fact", "payments", "zone_rows"),
        "bronze_union": _with(
            f"select {', '.join(TRIP_COLUMNS)}, {bronze} from trips", "trips"
        ),
        "append_merge": _with(f"{decoded}, {bronze} from trips", "trips"),
        "compact_roundtrip": _with("select * from silver", "silver"),
        "published_demand": _with(_HOURLY, "silver"),
        "stream_decode": _with(
            f"{decoded}, timestamp '2024-01-01' as kafka_ts, 0 as frame_magic, "
            "cast(7 as bigint) as frame_schema_id from trips",
            "trips",
        ),
        "stream_land": _with(f"{decoded}, 'kafka_live' as record_source from trips", "trips"),
        "stream_restart": _with(f"{decoded}, 'kafka_live' as record_source from trips", "trips"),
        "stream_dedupe": "select * from events",
        "stream_schemas": _with(_LANDED, "trips"),
        "stream_quarantine": _with(_SIDES, "trips"),
        "stream_newest": "select * exclude (rn) from (select *, row_number() over (partition by user_id "
        "order by ts desc nulls last, event_id desc nulls last) as rn from events) where rn = 1",
        "dq_report": _with(_SILVER_SUITE, "silver"),
        "dq_incremental": _with(
            (_SILVER_SUITE + "\nunion all\n" + _report("silver", [_keyed("duplicates", "silver", "trip_id", "1")]))
            .replace("from silver", "from arrived_silver"),
            "arrived_silver",
        ),
        "dq_verdict": _with(
            f"{_verdict('silver', _SILVER_SUITE)} union all {_verdict('table', _METRIC_SUITE)}",
            "silver",
        ),
        "dq_unique": _with(
            _report(
                "trips",
                [
                    _keyed("unique", "trips", _PAIR, "n"),
                    _keyed("duplicates", "trips", "trip_id", "1"),
                ],
            ),
            "trips",
        ),
        "dq_table_metrics": _with(_METRIC_SUITE, "silver"),
        "dq_schema": _with(_SCHEMA_SUITE, "silver"),
        "dq_orphans": _with(_DQ_ORPHANS, "trips", "zone_file", "payments"),
    }
