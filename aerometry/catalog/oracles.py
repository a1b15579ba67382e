"""The SQL counterpart of every registered query, over the same tables."""

from __future__ import annotations

from aerometry.catalog.queries import DELAY, EVENT_YEAR, TEMPERATURE_YEAR
from aerometry.operators.rollup import LOW_TEMPERATURE, TEMPERATURE_CHANGE
from aerometry.schemas import CITIES, READING_VALUES, SENSORS, TIME

ORACLES: dict[str, str] = {}

# Combined table and its counts

_KEYED = """keyed as (
  select cast(user_id as varchar) as "deviceId", time_bucket(interval '6 hours', ts) as "timestamp",
         event_id % 8 as k, event_id, user_id, event_type, value
  from events)"""

_SENSOR_COLUMNS = {
    "airQuality": "case when user_id % 10 = 0 then 'BAD' "
    "else cast(cast(value as decimal(12,2)) as varchar) end",
    "name": "event_type",
    "lon": "cast(-value as float)",
}


def _sensor_sql(index: int, values: tuple[str, ...]) -> str:
    columns = [f'{_SENSOR_COLUMNS.get(v, "cast(value as float)")} as "{v}"' for v in values]
    return (
        f'(select "deviceId", "timestamp", {", ".join(columns)} from keyed where k = {index}) '
        f"t{index}"
    )


_JOINED = f"""with {_KEYED}, combined as (
  select * from {_sensor_sql(0, SENSORS["air_quality"].values)}
  {" ".join(
      f'full outer join {_sensor_sql(i, spec.values)} using ("deviceId", "timestamp")'
      for i, spec in enumerate(SENSORS.values()) if i > 0)}
  where "deviceId" is not null and "timestamp" is not null)
"""

_TOTAL = _JOINED + 'select "deviceId", count(*) as total_measurements from combined group by 1'
ORACLES["total_measurements"] = _TOTAL
ORACLES["total_measurements_fast"] = _TOTAL
ORACLES["total_measurements_joined"] = _TOTAL
ORACLES["hourly_measurements"] = (
    _JOINED
    + 'select "deviceId", cast(hour("timestamp") as integer) as hour, count(*) as num_measurements '
    "from combined group by 1, 2"
)
_WIDE = _JOINED + "select * from combined"
ORACLES["combined_wide"] = _WIDE
ORACLES["combined_wide_bucketed"] = _WIDE

# Two-day instants from the epoch on; zeros of both signs and NaN, each with its text.
_SPECIAL = {0: "-0.0", 1: "0.0", 2: "NaN"}
_SPECIAL_VALUE = " ".join(
    f"when event_id // 8 % 4 = {k} then cast('{text}' as double)" for k, text in _SPECIAL.items()
)
_FLOATS = [v for spec in SENSORS.values() for v in spec.values if v not in ("airQuality", "name")]
_SPLIT = (
    _JOINED.replace(
        "time_bucket(interval '6 hours', ts)",
        "time_bucket(interval '48 hours', ts, timestamp '1970-01-01')",
    )
    .replace("cast(value as float)", f"cast(case {_SPECIAL_VALUE} else value end as float)")
    + "select *, "
    + ", ".join(
        f"""case when isnan("{v}") then 'NaN' when "{v}" = 0 """
        f"""then case when cast("{v}" as varchar) like '-%' then '-0.0' else '0.0' end """
        f"""end as "{v}_text\""""
        for v in _FLOATS
    )
    + " from combined"
)
ORACLES["combined_wide_split"] = _SPLIT

# Statistics per device

_TEMPERATURES = """temperatures as (
  select cast(o_custkey as varchar) as "deviceId", o_orderdate as ts,
         cast(o_totalprice / 1000 - 200 as float) as x
  from orders)"""
_PRESSURE = """pressure as (
  select cast(l_suppkey as varchar) as "deviceId", cast(l_quantity as float) as x
  from lineitem)"""

ORACLES["max_per_device"] = (
    f'with {_TEMPERATURES} select "deviceId", max(x) as max_temperature '
    "from temperatures group by 1"
)
ORACLES["min_per_device"] = (
    f'with {_PRESSURE} select "deviceId", min(x) as min_atmospheric_pressure '
    "from pressure group by 1"
)
ORACLES["avg_per_device"] = (
    f'with {_PRESSURE} select "deviceId", round(avg(x), 6) as avg_atmospheric_pressure '
    "from pressure group by 1"
)
ORACLES["min_avg_per_device"] = (
    f'with {_PRESSURE} select "deviceId", min(x) as min_atmospheric_pressure, '
    "round(avg(x), 6) as avg_atmospheric_pressure from pressure group by 1"
)
ORACLES["stddev_per_device"] = (
    f'with {_TEMPERATURES} select "deviceId", '
    "cast(stddev_samp(cast(x as double)) as float) as stddev_temperature "
    "from temperatures group by 1"
)
ORACLES["min_positive"] = (
    f'with {_TEMPERATURES} select "deviceId", min(x) as min_temperature '
    "from temperatures group by 1 having min(x) > 0"
)
ORACLES["stddev_positive"] = (
    ORACLES["stddev_per_device"] + " having stddev_samp(cast(x as double)) > 0"
)

# Statistics per month

ORACLES["monthly_temperature"] = (
    f"with {_TEMPERATURES} select cast(month(ts) as integer) as month, "
    "round(avg(x), 6) as avg_temperature, min(x) as min_temperature, max(x) as max_temperature "
    f"from temperatures where year(ts) = {TEMPERATURE_YEAR} and x > -100 and x < 100 "
    "group by 1 order by 1"
)
ORACLES["monthly_temperature_pruned"] = ORACLES["monthly_temperature"]

_MONTH = "cast(year(l_shipdate) as integer) as year, cast(month(l_shipdate) as integer) as month"
_AIR = """air as (
  select l_shipdate,
         case when l_returnflag = 'R' then 'BAD'
              else cast(cast(l_quantity as integer) as varchar) end as x
  from lineitem)"""
ORACLES["monthly_air_quality"] = (
    f"with {_AIR} select {_MONTH}, round(avg(try_cast(x as double)), 6) as avg_air_quality, "
    "min(x) as min_air_quality, max(x) as max_air_quality from air group by 1, 2"
)
ORACLES["monthly_air_quality_numeric"] = (
    f"with {_AIR} select {_MONTH}, round(avg(try_cast(x as double)), 6) as avg_air_quality, "
    "round(min(try_cast(x as double)), 6) as min_air_quality, "
    "round(max(try_cast(x as double)), 6) as max_air_quality from air group by 1, 2"
)
for _name, _value in {
    "pressure": "l_quantity",
    "humidity": "l_extendedprice",
    "pm1": "l_discount",
    "pm10": "l_tax",
    "pm25": "l_quantity * l_discount",
}.items():
    ORACLES[f"monthly_{_name}"] = (
        f"select {_MONTH}, round(avg(cast({_value} as float)), 6) as avg_{_name}, "
        f"min(cast({_value} as float)) as min_{_name}, "
        f"max(cast({_value} as float)) as max_{_name} from lineitem group by 1, 2"
    )

# Rollups and alarms

_VALUES = {
    "pm1": "value / 4",
    "pm2": "value / 2",
    "pm10": "value * 2",
    "pressure": "value + 1000",
    "humidity": "100 - value",
    "temperature": "value",
}
_CITY = f"list_extract([{', '.join(repr(c) for c in CITIES)}], cast(user_id % 6 + 1 as integer))"
_WINDOW = "interval '30 seconds'"


def _unless_garbage(expression: str) -> str:
    return f"case when user_id % 50 <> 0 then {expression} end"


_READINGS = f"""readings as (
  select ts, {_unless_garbage("date_trunc('second', ts)")} as time,
         {_unless_garbage(_CITY)} as city,
         {", ".join(
             _unless_garbage(f"cast({_VALUES[v]} as float)") + f" as {v}" for v in READING_VALUES)}
  from events)"""

_AGGREGATES = ", ".join(
    [f"round(avg({v}), 6) as avg_{v}" for v in READING_VALUES]
    + [f"max({v}) as max_{v}" for v in READING_VALUES]
    + [f"min({v}) as min_{v}" for v in READING_VALUES]
)


def _window(time: str) -> str:
    start = f"time_bucket({_WINDOW}, {time})"
    return f"{start} as window_start, {start} + {_WINDOW} as window_end"


def _averages(time: str) -> str:
    return (
        f"averages as (select {_window(time)}, city, avg(temperature) as a from readings "
        f"where {time} is not null group by 1, 2, 3)"
    )


_BY_WINDOW = f"with {_READINGS}, {_averages('ts')} "
_AVERAGE = "window_start, window_end, city, round(a, 6) as avg_temperature"
_LOW = f"a < {LOW_TEMPERATURE}"
_CLOSED = f"window_end <= (select max(time) from readings) - interval '{DELAY}'"

ORACLES["window_rollup"] = (
    f"with {_READINGS} select {_window('ts')}, {_AGGREGATES} from readings group by 1, 2"
)
ORACLES["city_temperature"] = _BY_WINDOW + f"select {_AVERAGE} from averages"
ORACLES["city_temperature_valid"] = (
    f"with {_READINGS}, good as (select * from readings where time is not null), "
    f"{_averages('ts').replace('from readings', 'from good')} select {_AVERAGE} from averages"
)
ORACLES["low_temp_alarm"] = _BY_WINDOW + f"select {_AVERAGE} from averages where {_LOW}"
ORACLES["alarm_cities"] = _BY_WINDOW + f"select distinct city from averages where {_LOW}"
ORACLES["alarm_notice"] = (
    _BY_WINDOW + "select distinct concat('Low temperature: the mean in ', city, ' is below 20') "
    f"as message from averages where {_LOW}"
)

_CHANGES = (
    f"with {_READINGS}, {_averages('time')}, "
    "changes as (select *, abs(a - lag(a) over (partition by city order by window_start)) as c "
    "from averages) "
)
_CHANGE = (
    f"select {_AVERAGE}, round(c, 6) as temperature_change from changes "
    f"where c >= {TEMPERATURE_CHANGE}"
)
ORACLES["temp_change_alarm"] = _CHANGES + _CHANGE

# Change filter

_CHANGED = f"""with ordered as (
  select cast(user_id as varchar) as "deviceId", ts as "{TIME}", event_id, event_type,
         lag(event_type) over (partition by user_id order by ts, event_id) as previous
  from events)
select "deviceId", "{TIME}", event_id, event_type from ordered
where previous is null or previous <> event_type"""
ORACLES["change_filter"] = _CHANGED
ORACLES["change_filter_split"] = _CHANGED

# Decoding

_NUMBERS = ", ".join(f"cast({_VALUES[v]} as float) as {v}" for v in READING_VALUES)
_DOUBLES = ", ".join(f"round({_VALUES[v]}, 6) as {v}" for v in READING_VALUES)

ORACLES["json_decode"] = (
    "select cast(json_extract(props, '$.k') as integer) as k, count(*) as n from events group by 1"
)
ORACLES["json_encode"] = (
    f"""select event_id, cast(user_id as varchar) as "deviceId", """
    f"date_trunc('second', ts) as time, {_CITY} as city, {_NUMBERS} from events"
)

_CLOCK = "cast(epoch(date_trunc('day', ts)) as bigint)"
ORACLES["parse_payload"] = (
    f"""select event_id as seq, cast(user_id as varchar) as "deviceId", """
    f"cast({_CLOCK} as varchar) as reading_key, {_CLOCK} as time, {_DOUBLES} "
    "from events where user_id % 30 not in (6, 7, 8, 9)"
)
ORACLES["payload_rejects"] = """select cast(user_id as varchar) as "deviceId",
       case user_id % 30 when 6 then 'no value line' when 7 then 'bad pm10'
            when 8 then 'missing pm10' else 'no separator in value line' end as reject_reason,
       count(*) as n
from events where user_id % 30 in (6, 7, 8, 9) group by 1, 2"""
ORACLES["device_directory"] = """with lines as (
  select case when c_custkey % 7 = 0 then cast(c_custkey as varchar)
              else concat(c_custkey, '|', c_name) end as line
  from customer)
select split_part(line, '|', 1) as "deviceId" from lines where contains(line, '|')"""
ORACLES["assign_city"] = f"select {_CITY} as city, count(*) as n from events group by 1"

# Sources and sinks

ORACLES["fan_in"] = """select event_id, event_type, value from events where event_type = 'click'
union all select event_id, event_type, null as value from events where event_type = 'view'
union all select event_id, event_type, value from events
  where coalesce(event_type, '') not in ('click', 'view')"""
ORACLES["preview"] = (
    "select event_id, ts, value from events order by ts, event_id limit 20"
)
_NAMES = "[" + ", ".join(f"'{name}'" for name in SENSORS) + "]"
ORACLES["csv_roundtrip"] = f"""with {_KEYED}
select list_extract({_NAMES}, cast(k + 1 as integer)) as sensor, "deviceId", "timestamp",
       case k when 0 then {_SENSOR_COLUMNS["airQuality"]} when 3 then event_type end as label,
       case when k <> 0 then cast(value as float) end as reading
from keyed"""

_INDEX = {name: i for i, name in enumerate(SENSORS)}


def _of(sensor: str, value: str = "cast(value as float) as x") -> str:
    return (
        f"""(select "deviceId", year("timestamp") as year, month("timestamp") as month, {value} """
        f"from keyed where k = {_INDEX[sensor]})"
    )


def _per_device(sensor: str, aggregate: str) -> str:
    return f"""select "deviceId", {aggregate} from {_of(sensor)} group by 1"""


def _per_month(sensor: str, label: str) -> str:
    return (
        f"select cast(year as double) as year, cast(month as double) as month, "
        f"round(avg(x), 6) as avg_{label}, min(x) as min_{label}, max(x) as max_{label} "
        f"from {_of(sensor)} group by 1, 2"
    )


_STDDEV = "cast(stddev_samp(cast(x as double)) as float) as stddev_humidity"
_AIR = _of("air_quality", f"{_SENSOR_COLUMNS['airQuality']} as x")
_RESULT_SQL = {
    "total_measurements": """select "deviceId", cast(count(*) as double) as total_measurements
        from combined group by 1""",
    "hourly_measurements": """select "deviceId", cast(hour("timestamp") as double) as hour,
        cast(count(*) as double) as num_measurements from combined group by 1, 2""",
    "max_temperature": _per_device("temperature", "max(x) as max_temperature"),
    "min_atmospheric_pressure": _per_device(
        "atmospheric_pressure", "min(x) as min_atmospheric_pressure"
    ),
    "avg_pressure_by_device": _per_device(
        "atmospheric_pressure", "round(avg(x), 6) as avg_atmospheric_pressure"
    ),
    "stddev_humidity": _per_device("humidity", _STDDEV),
    "monthly_temperature": f"""select cast(month as double) as month,
        round(avg(x), 6) as avg_temperature, min(x) as min_temperature, max(x) as max_temperature
        from {_of("temperature")} where year = {EVENT_YEAR} and x > -100 and x < 100 group by 1""",
    "monthly_air_quality": f"""select cast(year as double) as year, cast(month as double) as month,
        round(avg(try_cast(x as double)), 6) as avg_air_quality, min(x) as min_air_quality,
        max(x) as max_air_quality from {_AIR} group by 1, 2""",
    "monthly_pressure": _per_month("atmospheric_pressure", "atmospheric_pressure"),
    "monthly_humidity": _per_month("humidity", "humidity"),
    "monthly_pm1": _per_month("pm_1", "pm1"),
    "monthly_pm10": _per_month("pm_10", "pm10"),
    "monthly_pm25": _per_month("pm_2_5", "pm25"),
}


def _together(label: str, tables: dict[str, str]) -> str:
    return " union all by name ".join(
        f"(select '{name}' as {label}, * from ({sql}))" for name, sql in tables.items()
    )


ORACLES["batch_pipeline"] = _JOINED + _together("result", _RESULT_SQL)

# Streams

ORACLES["stream_rollup"] = ORACLES["window_rollup"]
ORACLES["stream_low_temp_alarm"] = ORACLES["low_temp_alarm"]
ORACLES["stream_rollup_merged"] = ORACLES["window_rollup"]
ORACLES["stream_low_temp_alarm_merged"] = ORACLES["low_temp_alarm"]
ORACLES["stream_rollup_append"] = (
    f"with {_READINGS}, windows as (select {_window('time')}, {_AGGREGATES} from readings "
    f"where time is not null group by 1, 2) select * from windows where {_CLOSED}"
)
ORACLES["stream_change_alarm"] = _CHANGES + _CHANGE + f" and {_CLOSED}"
ORACLES["stream_change_filter"] = _CHANGED
ORACLES["stream_ingest"] = f"""with ordered as (
  select *, {_CLOCK} as clock,
         lag({_CLOCK}) over (partition by user_id order by ts, event_id) as previous
  from events where user_id % 30 not in (6, 7, 8, 9))
select cast(user_id as varchar) as "deviceId", date_trunc('day', ts) + interval '0 seconds' as time,
       {_NUMBERS}, {_CITY} as city
from ordered where previous is null or previous <> clock"""
ORACLES["stream_low_temp_alarm_closed"] = (
    f"with {_READINGS}, {_averages('time')} select {_AVERAGE} from averages where {_LOW} and {_CLOSED}"
)
ORACLES["stream_replay"] = (
    f"with {_READINGS}, averages as (select {_window('time')}, city, avg(temperature) as a, "
    f"count(temperature) as n_temperature from readings where time is not null group by 1, 2, 3) "
    f"select {_AVERAGE}, n_temperature from averages where {_CLOSED}"
)
ORACLES["change_notice"] = (
    _CHANGES + "select concat('Temperature change: the mean in ', coalesce(city, 'unknown city'), "
    "' moved by # since the window before') as message, round(c, 6) as moved from changes "
    f"where c >= {TEMPERATURE_CHANGE} and {_CLOSED}"
)
ORACLES["stream_all"] = _together(
    "sink",
    {
        "aggs": ORACLES["window_rollup"],
        "alarms": ORACLES["low_temp_alarm"],
        "alarmdiffs": ORACLES["stream_change_alarm"],
    },
)
ORACLES["stream_all_closed"] = _together(
    "sink",
    {
        "aggs": ORACLES["stream_rollup_append"],
        "alarms": ORACLES["stream_low_temp_alarm_closed"],
        "alarmdiffs": ORACLES["stream_change_alarm"],
    },
)
