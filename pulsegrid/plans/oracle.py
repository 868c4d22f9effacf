"""The registered queries as SQL on the given tables, for comparison in another engine."""

from __future__ import annotations

from pulsegrid.functions import geo

POLLUTANTS = ["CO2", "CO", "HC", "NOx", "PMx", "noise"]

EMISSIONS = """emissions as (
  select event_id, 'veh' || user_id as vehicle_id, event_type as eclass, ts, user_id,
    case when event_id % 4 = 0 then 'truck_truck' else 'veh_passenger' end as vehicle_type,
    40.40::double + (event_id % 7) * 0.001::double + 0.0002::double as lat,
    (-3.70)::double - (user_id % 5) * 0.001::double - 0.0002::double as lon,
    value / 10 + 0.000317::double as speed,
    value * 10 + 0.0000137::double as CO2, value / 5 + 0.0000137::double as CO,
    value / 100 + 0.0000137::double as HC, value / 80 + 0.0000137::double as NOx,
    value / 90 + 0.0000137::double as PMx, 40 + value / 10 + 0.0000137::double as noise,
    epoch_us(ts) // 1000 as event_time_ms
  from events)"""

VITALS = """vitals as (
  select concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) as row_key,
    printf('vsd_case%02d_fulldata_%02d.csv', l_suppkey % 128 + 1, l_suppkey // 128 + 1) as case_name,
    printf('%02d:%02d:%02d', l_orderkey % 24, l_partkey % 60, l_suppkey % 60) as Time,
    l_orderkey * 10 + l_linenumber as RelativeTimeMilliseconds,
    h.HR, case when l_quantity = 50 then 101.0::double else 90 + l_discount * 100 end as SpO2,
    h.HR + 0.5::double * (l_linenumber - 3) as Pulse, l_extendedprice / 100000 as Perf,
    100 + l_tax * 500 as NBP_Sys, case when l_linenumber <> 3 then 60 + l_tax * 200 end as NBP_Dia,
    case when l_linenumber <> 5 then 30 + l_discount * 80 end as etCO2,
    36 + l_tax * 10 as Temp,
    10 + l_quantity % 9 as RR,
    case when l_linenumber <> 4 then case when l_returnflag = 'R' then 1 else 0 end end as Num_Patient_Alarms
  from lineitem, lateral (select case when l_linenumber = 7 then null when l_quantity = 49 then 0::double
    else 50 + l_quantity * 1.5::double end as HR) h)"""

LABELLED = VITALS + """, labelled as (
  select *, NBP_Sys - NBP_Dia as pulse_pressure_nbp, case when SpO2 < 95 then 1 else 0 end as label_classification,
    HR as label_regression
  from vitals where SpO2 between 0 and 100 and HR > 0 and HR < 300)"""

TIMED = LABELLED + """, bounds as (
  select min(RelativeTimeMilliseconds)::double as lo, max(RelativeTimeMilliseconds)::double as hi from labelled),
timed as (select l.*, (RelativeTimeMilliseconds::double - lo) / coalesce(nullif(hi - lo, 0), 1) as time_norm
  from labelled l, bounds)"""

_CLASS_MODELS = """
  select 'rule_pressure' as model, *, (NBP_Sys - 100) / 80 + (100 - SpO2) / 20 as probability from {rows}
  union all
  select 'rule_perfusion', *, Perf / 2 + (100 - SpO2) / 20 from {rows}"""
_VALUE_MODELS = """
  select 'rule_pulse' as model, *, Pulse * 0.97::double + 1.25::double as prediction from {rows}
  union all
  select 'rule_breath', *, 70 + RR * 1.5::double + Perf * 10 from {rows}"""


def class_predictions(rows: str) -> str:
    return f"class_predictions as (select *, case when probability > 0.5 then 1 else 0 end as prediction from ({_CLASS_MODELS.format(rows=rows)}))"


def value_predictions(rows: str) -> str:
    return f"value_predictions as ({_VALUE_MODELS.format(rows=rows)})"


def segments(source: str, closed: bool = False) -> str:
    last = "<=" if closed else "<"
    return f"""segmented as (
  select * from (select p.*, unnest(['full_test',
    case when time_norm >= 0 and time_norm < 0.33 then 'temporal_early' end,
    case when time_norm >= 0.33 and time_norm < 0.67 then 'temporal_mid' end,
    case when time_norm >= 0.67 and time_norm {last} 1.0 then 'temporal_late' end,
    case when Num_Patient_Alarms > 0 then 'alarms_active' end,
    case when Num_Patient_Alarms = 0 then 'no_alarms' end]) as segment from {source} p) where segment is not null)"""


def class_metrics(source: str, by: str) -> str:
    """CTE with the classification metrics of ``source``."""
    return f"""scores as (
  select {by}, probability, count(*) filter (label_classification = 1) as pos,
    count(*) filter (label_classification = 0) as neg from {source} group by {by}, probability),
ranks as (select *, coalesce(sum(neg) over (partition by {by} order by probability
    rows between unbounded preceding and 1 preceding), 0) as below from scores),
areas as (select {by}, sum(pos * (below + neg / 2.0::double)) / (sum(pos)::double * sum(neg)::double) as auc
  from ranks group by {by}),
cells as (select {by}, count(*)::double as n,
    (count(*) filter (label_classification = 1 and prediction = 1))::double as tp,
    (count(*) filter (label_classification = 0 and prediction = 1))::double as fp,
    (count(*) filter (label_classification = 0 and prediction = 0))::double as tn,
    (count(*) filter (label_classification = 1 and prediction = 0))::double as fn from {source} group by {by}),
class_metrics as (select {by}, n::bigint as n_rows, round(auc, 4) as auc, round((tp + tn) / n, 4) as accuracy,
    round((coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) * (tp + fn)
      + coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0) * (fp + tn)) / n, 4) as f1,
    round((coalesce(tp / nullif(tp + fp, 0), 0) * (tp + fn)
      + coalesce(tn / nullif(tn + fn, 0), 0) * (fp + tn)) / n, 4) as precision,
    round((tp + tn) / n, 4) as recall
  from cells join areas using ({by}))"""


def value_metrics(source: str, by: str) -> str:
    return f"""value_metrics as (
  select {by}, count(*) as n_rows, round(sqrt(avg((prediction - label_regression) ** 2)), 4) as rmse,
    round(avg(abs(prediction - label_regression)), 4) as mae,
    round(1 - avg((prediction - label_regression) ** 2) / var_pop(label_regression), 4) as r2
  from {source} group by {by})"""


SEGMENT_CLASS = ", ".join([
    TIMED, class_predictions("timed"), segments("class_predictions"), class_metrics("segmented", "model, segment")])
SEGMENT_VALUE = ", ".join([
    TIMED, value_predictions("timed"), segments("value_predictions"), value_metrics("segmented", "model, segment")])
KNOWN_VALUES = f"{LABELLED}, {value_predictions('labelled')}"


def windows(size: str, slide: str | None = None, count: int = 1, where: str = "true") -> str:
    """CTE ``windowed``: every emission with the start ``ws`` and end ``we`` of each of its windows."""
    if slide is None:
        return f"""windowed as (select *, time_bucket(interval '{size}', ts) as ws,
    time_bucket(interval '{size}', ts) + interval '{size}' as we from emissions where {where})"""
    return f"""windowed as (select *, ws0 as ws, ws0 + interval '{size}' as we from (
    select e.*, time_bucket(interval '{slide}', ts) - k * interval '{slide}' as ws0
    from emissions e, range({count}) t(k) where {where}) where ts >= ws0 and ts < ws0 + interval '{size}')"""


def pollution(kind: str, size: str, pollutants: list[str], vehicle: str = "all", fmt: str = "text",
              engine: str | None = None) -> str:
    """CTE ``pollution`` with flat result records."""
    bound = {"text": "strftime({}, '%Y-%m-%d %H:%M:%S')", "ms": "(epoch_us({}) // 1000)::varchar"}[fmt]
    values = ", ".join(f"round(avg({p}), 4) as {p}_avg, round(max({p}), 4) as {p}_max" for p in pollutants)
    extra = f", '{engine}' as engine" if engine else ""
    return f"""pollution as (select {bound.format('ws')} as window_start, {bound.format('we')} as window_end,
    round(lat, 3) as lat, round(lon, 3) as lon, count(*) as vehicle_count, '{kind}' as window_type,
    '{size}' as window_duration, '{','.join(pollutants)}' as pollutants, '{vehicle}' as vehicle_filter{extra}, {values}
  from windowed group by ws, we, round(lat, 3), round(lon, 3))"""


def traffic(kind: str, size: str, types: bool = False) -> str:
    return f"""traffic as (select strftime(ws, '%Y-%m-%d %H:%M:%S') as window_start,
    strftime(we, '%Y-%m-%d %H:%M:%S') as window_end, round(lat, 3) as lat, round(lon, 3) as lon,
    count(*) as total_records, count(distinct nullif(vehicle_id, '')) as unique_vehicles,
    round(avg(speed), 2) as avg_speed_ms, '{kind}' as window_type, '{size}' as window_duration, 'all' as vehicle_filter
    {", count(distinct vehicle_type) as vehicle_types" if types else ""}
  from windowed group by ws, we, round(lat, 3), round(lon, 3))"""


DAILY = windows("1 day")
SLIDING = windows("10 minutes", "2 minutes", 5)
TEN_MINUTES = windows("10 minutes")
TRUCKS = windows("1 day", where="vehicle_type = 'truck_truck'")
# Events moved to the first hours of 1970, so that bounds in milliseconds have different numbers of digits.
TEN_EPOCH = """with early as (select round(40.40::double + (event_id % 7) * 0.001::double + 0.0002::double, 3) as lat,
    round(-3.70::double - (user_id % 5) * 0.001::double - 0.0002::double, 3) as lon,
    ((event_id % 20000000) // 600000 + 1) * 600000 as window_end from (select event_id * 7919 as event_id, user_id from events))"""
REVISED = """with revised as (select lat, lon, window_end, batch_id, count(*) as vehicle_count from (select
    round(40.40::double + (event_id % 7) * 0.001::double + 0.0002::double, 3) as lat,
    round(-3.70::double - (user_id % 5) * 0.001::double - 0.0002::double, 3) as lon,
    strftime(date_trunc('day', ts) + interval 1 day, '%Y-%m-%d %H:%M:%S') as window_end, event_id % 13 as batch_id from events) group by all)"""
LATEST = """latest as (select * exclude (rn) from (select *, row_number() over (partition by lat, lon
    order by window_end desc, window_start desc) as rn from {}) where rn = 1)"""


def colour(norm: str) -> str:
    stops = [(0, 204, 68), (170, 204, 0), (255, 170, 0), (255, 85, 0), (204, 0, 0)]
    step = f"least(floor({norm} * 4), 3)"
    channels = []
    for c in range(3):
        arms = " ".join(
            f"when {i} then {stops[i][c]} + ({norm} - {i} / 4.0::double) * 4 * ({stops[i + 1][c] - stops[i][c]})"
            for i in range(4))
        channels.append(f"trunc(case {step} {arms} end)::int")
    return f"printf('#%02x%02x%02x', {', '.join(channels)})"


def clamp(value: str, lo: float, hi: float) -> str:
    return f"greatest(0::double, least(1::double, ({value} - {lo}) / {hi - lo}::double))"


CELL_TEXT = """'<b>Grid Cell</b>: (' || printf('%.3f', lat) || ', ' || printf('%.3f', lon) || ')<br>'
    || '<b>Window</b>: ' || window_start || ' → ' || window_end || '<br>'"""


def pollution_layer(pollutant: str, shown: list[str], lo: int, hi: int, unit: str, whole: bool = False) -> str:
    pixels = "(30 + norm * 170) / 10"
    if whole:
        pixels = f"floor({pixels})"
    lines = " || ".join(
        f"'<b>{p}</b>: avg=' || printf('%.2f', {p}_avg) || ' | max=' || printf('%.2f', {p}_max) "
        f"|| ' {'dB' if p == 'noise' else 'mg/s'}<br>'" for p in POLLUTANTS if p in shown)
    return f"""select lat, lon, window_start, window_end, '{pollutant}' as pollutant, value, norm,
    {colour('norm')} as color, greatest(5::double, {pixels}) as radius,
    {CELL_TEXT} || '<b>Vehicles</b>: ' || vehicle_count || '<br><hr>' || {lines} as popup,
    '{pollutant}: ' || printf('%.1f', value) || ' {unit}' as tooltip, '{unit}' as unit
  from (select *, {pollutant}_avg as value, {clamp(f'{pollutant}_avg', lo, hi)} as norm from latest)"""


def wgs84(source: str) -> str:
    """CTE ``placed``: ``source`` with lat and lon from its x and y; hyperbolic functions by exponentials."""
    scale = geo.SCALE_FACTOR * geo.RADIUS
    sinh = lambda v: f"((exp({v}) - exp(-({v}))) / 2)"
    cosh = lambda v: f"((exp({v}) + exp(-({v}))) / 2)"
    num = lambda v: f"({v!r})::double"
    xi = "xi" + "".join(
        f" - {num(b)} * sin({2 * j} * xi) * {cosh(f'{2 * j} * eta')}" for j, b in enumerate(geo.BETA, 1))
    eta = "eta" + "".join(
        f" - {num(b)} * cos({2 * j} * xi) * {sinh(f'{2 * j} * eta')}" for j, b in enumerate(geo.BETA, 1))
    lat = "chi" + "".join(f" + {num(d)} * sin({2 * j} * chi)" for j, d in enumerate(geo.DELTA, 1))
    return f"""normal as (select *, (y + {num(-geo.NET_OFFSET_Y)}) / {num(scale)} as xi,
    (x + {num(-geo.NET_OFFSET_X - geo.FALSE_EASTING)}) / {num(scale)} as eta from {source}),
primed as (select *, {xi} as xi_p, {eta} as eta_p from normal),
conformal as (select *, asin(sin(xi_p) / {cosh('eta_p')}) as chi from primed),
placed as (select *, round(({lat}) * 180 / pi(), 6) as lat,
    round(atan2({sinh('eta_p')}, cos(xi_p)) * 180 / pi() - 3, 6) as lon from conformal)"""


FILES = VITALS + """, files as (
  select case_name as file_name, count(*) * 97 + (sum(RelativeTimeMilliseconds) % 1000)::bigint as size
  from vitals group by case_name),
total as (select sum(size)::bigint as total from files),
shuffled as (select *, row_number() over w as place, coalesce(sum(size) over (w rows between unbounded preceding
    and 1 preceding), 0)::bigint as before from files window w as (order by md5('42|' || file_name), file_name))"""

COPIES = FILES + """, rounds as (
  select file_name as source_name, size, c::int as copy from shuffled, total, range(1, 10) r(c)
  where total + (c - 1) * total + before < floor(total * 2.5::double)::bigint
  union all select file_name, size, 0 from files),
copies as (select case when copy > 0 then 'copy' || copy || '_' || source_name else source_name end as file_name,
    source_name, size, copy from rounds)"""

LANDED = """landed as (select distinct printf('vsd_case%02d_fulldata_%02d.csv', s_suppkey % 128 + 1, s_suppkey // 128 + 1)
  as file_name from supplier where s_acctbal > 5000)"""


def histogram(source: str, value: str, bins: int, by: str) -> str:
    return f"""extremes as (select {by}, min({value}) as lo, max({value}) as hi from {source} group by {by}),
bins as (select {by}, lo, hi, coalesce(least({bins}, floor({bins} * ({value} - lo) / nullif(hi - lo, 0)) + 1), 1)::int
    as bin from {source} join extremes using ({by})),
counted as (select {by}, bin, count(*) as count from bins group by {by}, bin),
every as (select *, unnest(range(1, {bins} + 1))::int as bin from extremes)
select {by}, bin, round(lo + (bin - 1) * ((hi - lo) / {bins}), 6) as bin_lo,
  round(lo + bin * ((hi - lo) / {bins}), 6) as bin_hi, coalesce(count, 0) as count from every left join counted using ({by}, bin)"""


def bars(source: str, metrics: list[str], models: list[str], by_metric: bool = True) -> str:
    parts = []
    for m in metrics:
        columns = ", ".join(f"max({m}) filter (model = '{x}') as {x}" for x in models)
        head = f"'{m}' as metric, " if by_metric else ""
        parts.append(f"select {head}segment, {columns} from {source} group by segment")
    return " union all ".join(parts)


STATS = """min({0}) as min, max({0}) as max, round(avg({0}), 4) as mean, round(stddev_samp({0}), 4) as std_dev,
  round(var_samp({0}), 4) as variance, quantile_disc({0}, 0.5) as median, count(*) as samples_count"""

_DRAW = "('0x' || substr(md5('11|' || {0}), 1, 8))::bigint"
SPLIT = f"""case when {_DRAW} < {round(0.7 * 2**32)} then 'train' when {_DRAW} < {round(0.85 * 2**32)} then 'val' else 'test' end"""
SMALL_SHARES = f"""case when {_DRAW} < {round(0.99 * 2**32)} then 'train' when {_DRAW} < {round(0.994 * 2**32)} then 'val' else 'test' end"""

SCATTER = KNOWN_VALUES + """, points as (select * from (select model, row_key, label_regression, prediction
  from value_predictions order by md5(concat_ws('|', '42', model, row_key)), model, row_key limit 5000))"""

LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
VITALS_COLUMNS = [
    "row_key", "case_name", "Time", "RelativeTimeMilliseconds", "HR", "SpO2", "Pulse", "Perf", "etCO2", "NBP_Sys",
    "NBP_Dia", "Temp", "RR", "Num_Patient_Alarms",
]


def statements() -> dict[str, str]:
    clipped = "HR is not null and HR > 0 and HR < 300 and SpO2 is not null and SpO2 >= 0 and SpO2 <= 100"
    raw = VITALS + """, raw as (select row_key, case_name, Time, trunc(HR)::int::double as HR,
    case when RelativeTimeMilliseconds % 11 = 0 then null else trunc(NBP_Sys)::int::double end as NBP_Sys,
    trunc(NBP_Dia)::int::double as NBP_Dia, null::double as Set_IE_ratio, trunc(RR)::int::double as Set_RR,
    case when Num_Patient_Alarms = 1 then 'HR HIGH' end as Alarm_1, trunc(RR)::int::double as Foo_Bar_Baz from vitals)"""
    daily_co2 = f"with {EMISSIONS}, {DAILY}, {pollution('tumbling', '1 day', ['CO2'])}"
    daily_traffic = f"with {EMISSIONS}, {DAILY}, {traffic('tumbling', '1 day')}"
    sliding_co2 = f"with {EMISSIONS}, {SLIDING}, {pollution('sliding', '10 minutes', ['CO2'])}"
    ten_co2 = f"with {EMISSIONS}, {TEN_MINUTES}, {pollution('tumbling', '10 minutes', ['CO2'])}"
    closed = "(select max(ts) - interval '30 seconds' from events)"
    uneven = windows("10 minutes", "2 minutes", 5, "true").replace(
        "where ts >= ws0", "where epoch_us(ws0) % 240000000 = 0 and ts >= ws0")
    xy = """xy as (select event_id, 3000 + value * 10 + (user_id % 50) * 20 as x,
    8000 + (event_id % 1000) * 3 + value as y from events)"""
    xml = EMISSIONS + """, documents as (select *, event_id * 0.25::double as timestep,
    (3000 + event_id % 1000)::double as x, (8000 + (event_id * 7) % 2000)::double as y from
    (select * exclude (lat, lon) from emissions))"""
    greedy = """, ordered as (select place, file_name, size from shuffled), budget as (
  select floor(total * 0.4::double)::bigint as room from total),
walk as (select 0::bigint as place, 0::bigint as used, null::varchar as file_name, null::bigint as size, false as taken
  union all select o.place, case when w.used + o.size <= room then w.used + o.size else w.used end,
    o.file_name, o.size, w.used + o.size <= room from walk w join ordered o on o.place = w.place + 1, budget)
select file_name, size from walk where taken"""
    density = KNOWN_VALUES + """, residuals as (select model, prediction - label_regression as residual
    from value_predictions),
  stats as (select model, min(residual) as lo, max(residual) as hi,
    stddev_samp(residual) * pow(count(*), -0.2::double) as h from residuals group by model),
  binned as (select model, lo, hi, h, least(floor((residual - lo) / (hi - lo) * 4096), 4095) as bin, count(*) as c, avg(residual - lo) as m
    from residuals join stats using (model) group by all),
  mass as (select model, p as point, lo, hi, h,
    sum(c * exp(-0.5::double * pow((p * ((hi - lo) / 199) - m) / h, 2))) as mass
    from binned, range(200) t(p) group by model, p, lo, hi, h)
  select model, point::int as point, round(lo + point * ((hi - lo) / 199), 6) as x,
    round(mass / (h * sqrt(2 * pi())) * ((hi - lo) / 60), 4) as height from mass"""

    approx = """select window_start, window_end, lat, lon, total_records, avg_speed_ms, unique_vehicles, true as close,
      vehicle_types, true as types_close from traffic"""
    layer = (f"with {EMISSIONS}, {SLIDING}, {pollution('sliding', '10 minutes', POLLUTANTS)}, "
             f"{LATEST.format('pollution')} " + pollution_layer("CO2", POLLUTANTS, 0, 5000, "mg/s"))

    sql = {
        "filter_sort_top20": f"with {VITALS} select case_name, Time, HR from vitals where HR > 100 "
                             "order by RelativeTimeMilliseconds, case_name, Time, HR limit 20",
        "filter_sorted": f"with {VITALS} select case_name, Time, HR, RelativeTimeMilliseconds from vitals "
                         "where HR > 100 order by RelativeTimeMilliseconds, case_name, Time",
        "filter_count": f"with {VITALS} select count(*) as total_samples from vitals where HR > 100",
        "grouped_stats": f"with {VITALS} select case_name, {STATS.format('HR')} from vitals group by case_name",
        "grouped_stats_native": f"select l_returnflag, {STATS.format('l_extendedprice')} from lineitem "
                                "group by l_returnflag",
        "profile_columns": " union all ".join(
            f"""select {i} as position, '{c}' as "column", '{t}' as type, count(*) as rows,
            count(*) - count({c}) as nulls from lineitem""" for i, (c, t) in enumerate(LINEITEM_TYPES.items())),
        "profile_vitals": f"with {VITALS} " + " union all ".join(
            f"""select '{c}' as "column", count(*) as rows, count(*) - count({c}) as nulls from vitals"""
            for c in VITALS_COLUMNS),
        "case_names": f"with {VITALS} select case_name, regexp_extract(case_name, 'case([0-9]+)', 1) as case_id, count(*) as rows "
                      "from vitals group by case_name",
        "valid_rows": f"with {VITALS} select case_name, count(*) as rows, round(avg(HR), 4) as mean_hr from vitals "
                      f"where {clipped} group by case_name",
        "validity_counts": f"with {VITALS} select count(*) as rows, count(*) filter ({clipped}) as kept, "
                           f"count(*) - count(*) filter ({clipped}) as rejected from vitals",
        "label_distribution": f"with {LABELLED} select label_classification, count(*) as count from labelled "
                              "group by label_classification order by label_classification",
        "pulse_pressure": f"with {LABELLED} select row_key, pulse_pressure_nbp, label_classification, "
                          "label_regression from labelled",
        "rename_sanitize_cast": f"with {raw} select * from raw",
        "vitals_csv_scan": f"with {raw} select row_key, Time, HR, NBP_Sys, '1:2' as Set_IE_ratio, Alarm_1 from raw",
        "value_range": f"with {VITALS} select min(RelativeTimeMilliseconds) as lo, "
                       "max(RelativeTimeMilliseconds) as hi from vitals",
        "time_norm": f"with {TIMED} select row_key, round(time_norm, 9) as time_norm from timed",
        "time_norm_per_case": f"""with {LABELLED} select row_key, round((RelativeTimeMilliseconds::double - lo)
          / coalesce(nullif(hi - lo, 0), 1), 9) as time_norm from (select *,
          (min(RelativeTimeMilliseconds) over w)::double as lo, (max(RelativeTimeMilliseconds) over w)::double as hi
          from labelled window w as (partition by case_name))""",
        "segment_counts": f"with {TIMED}, {segments('timed')} select segment, count(*) as rows from segmented "
                          "group by segment",
        "segment_counts_closed": f"with {TIMED}, {segments('timed', True)} select segment, count(*) as rows "
                                 "from segmented group by segment",
        "cls_metrics": f"with {LABELLED}, {class_predictions('labelled')}, "
                       f"{class_metrics('class_predictions', 'model')} select * from class_metrics",
        "auc_scales": f"""with {LABELLED}, scaled as (
            select 'rule_wide' as model, *, (RelativeTimeMilliseconds * 7919 % 1000003) * 1000.0::double + HR as probability from labelled
            union all select 'rule_narrow', *, 0.5::double + RelativeTimeMilliseconds * 1e-12::double from labelled),
          scored as (select *, case when SpO2 < 94 then 1 else 0 end as prediction from scaled),
          {class_metrics('scored', 'model')} select * from class_metrics""",
        "reg_metrics": f"with {KNOWN_VALUES}, {value_metrics('value_predictions', 'model')} "
                       "select * from value_metrics",
        "segment_metrics": f"with {SEGMENT_CLASS} select * from class_metrics",
        "segment_reg_metrics": f"with {SEGMENT_VALUE} select * from value_metrics",
        "metrics_round_trip": f"with {SEGMENT_VALUE} select * from value_metrics",

        "pollution_tumbling": f"{daily_co2} select * from pollution",
        "pollution_sliding": f"{sliding_co2} select * from pollution",
        "pollution_direct": f"{sliding_co2} select * from pollution",
        "pollution_all": f"with {EMISSIONS}, {SLIDING}, {pollution('sliding', '10 minutes', POLLUTANTS)} "
                         "select * from pollution",
        "pollution_trucks": f"with {EMISSIONS}, {TRUCKS}, "
                            f"{pollution('tumbling', '1 day', ['NOx', 'noise'], 'truck_truck', 'ms', 'spark')} "
                            "select * from pollution",
        "pollution_uneven_slide": f"with {EMISSIONS}, {uneven}, {pollution('sliding', '10 minutes', ['CO2'])} "
                                  "select * from pollution",
        "traffic_exact": f"{daily_traffic} select * from traffic",
        "traffic_sliding": f"with {EMISSIONS}, {SLIDING}, {traffic('sliding', '10 minutes')} select * from traffic",
        "proc_time_window": f"""with {EMISSIONS} select round(lat, 3) as lat, round(lon, 3) as lon,
          count(*) as vehicle_count, 'tumbling' as window_type, '1 day' as window_duration, 'CO2' as pollutants,
          'all' as vehicle_filter, round(avg(CO2), 4) as CO2_avg, round(max(CO2), 4) as CO2_max
          from emissions group by round(lat, 3), round(lon, 3)""",
        "proc_time_sliding": f"""with {EMISSIONS} select round(lat, 3) as lat, round(lon, 3) as lon,
          count(*) as total_records, count(distinct vehicle_id) as unique_vehicles,
          round(avg(speed), 2) as avg_speed_ms, 'sliding' as window_type, '2 days' as window_duration,
          'all' as vehicle_filter, 2::bigint as windows from emissions group by round(lat, 3), round(lon, 3)""",
        "pollution_json_roundtrip": f"with {EMISSIONS}, {DAILY}, {pollution('tumbling', '1 day', ['CO2', 'noise'])} "
                                    "select * from pollution",
        "traffic_json_roundtrip": f"{daily_traffic} select * from traffic",
        "rejected_messages": """select 'rejected' as kind, count(*) filter (event_id % 97 = 0) as messages from events
          union all select 'accepted', count(*) filter (event_id % 97 <> 0) from events""",
        "event_time_from_ms": f"""with {EMISSIONS} select strftime(make_timestamp((event_time_ms + 3600000) * 1000),
          '%Y-%m-%d %H:%M:%S.%g') as event_time, event_id from emissions""",
        "xml_emissions": f"""with {xml}, {wgs84('documents')} select timestep,
          case when event_id % 11 <> 0 then vehicle_id end as vehicle_id, vehicle_type, eclass, lat, lon, speed,
          0::double as angle, CO2, 0::double as CO, case when event_id % 5 <> 0 then noise else 0 end as noise,
          trunc(timestep * 1000)::bigint as event_time_ms from placed""",
        "xml_rejects": "select case when event_id % 17 < 3 then 'rejected' else 'accepted' end as kind, count(*) as timesteps "
                       "from events group by 1",
        "grid_to_wgs84": f"with {xy}, {wgs84('xy')} select event_id, lat, lon from placed",
        "stream_pollution_update": f"{ten_co2} select * from pollution",
        "stream_pollution_final": sliding_co2.replace("from windowed", f"from windowed where we <= {closed}")
                                  + " select * from pollution",
        "stream_traffic": daily_traffic.replace("from windowed", f"from windowed where we <= {closed}")
                          + " select * from traffic",
        "stream_late_drop": ten_co2.replace("from windowed", "from windowed where day(ts) < 10 or day(ts) >= 20")
                            + " select * from pollution",
        "stream_json_source": f"with {EMISSIONS}, {DAILY}, {pollution('tumbling', '1 day', POLLUTANTS)} "
                              "select * from pollution",
        "stream_latest_per_cell": f"{daily_co2}, {LATEST.format('pollution')} select * from latest",
        "latest_per_cell_daily": f"{daily_co2}, {LATEST.format('pollution')} select * from latest",
        "latest_epoch_ms": f"""{TEN_EPOCH} select lat, lon, max(window_end)::varchar as window_end from early group by lat, lon""",
        "latest_of_revisions": f"""{REVISED} select lat, lon, window_end, batch_id, vehicle_count from
          (select *, row_number() over (partition by lat, lon order by window_end desc, batch_id desc) as rn from revised) where rn = 1""",
        "latest_traffic_per_cell": f"{daily_traffic}, {LATEST.format('traffic')} select * from latest",
        "first_window_metadata": f"{sliding_co2} select window_type, window_duration from pollution "
                                 "order by window_start, window_end limit 1",
        "pollution_map_layer": layer,
        "stream_map_layer": layer,
        "pollution_map_layer_noise": f"with {EMISSIONS}, {DAILY}, {pollution('tumbling', '1 day', ['noise', 'CO'])}, "
                                     f"{LATEST.format('pollution')} "
                                     + pollution_layer("noise", ["noise", "CO"], 40, 90, "dB", whole=True),
        "traffic_map_layer": f"""{daily_traffic}, {LATEST.format('traffic')} select lat, lon, window_start, window_end,
          unique_vehicles, norm, {colour('norm')} as color, 4 + norm * 16 as radius, kmh as avg_speed_kmh,
          {CELL_TEXT} || '<b>Window type</b>: ' || window_type || ' (' || window_duration || ')<br><hr>'
          || '<b>Unique vehicles</b>: ' || unique_vehicles || '<br><b>Total observations</b>: ' || total_records
          || '<br><b>Avg speed</b>: ' || printf('%.1f', kmh) || ' km/h<br><b>Vehicle filter</b>: ' || vehicle_filter
          || '<br>' as popup,
          'Vehicles: ' || unique_vehicles || ' | Avg speed: ' || printf('%.1f', kmh) || ' km/h' as tooltip
          from (select *, {clamp('unique_vehicles', 0, 50)} as norm,
          round(avg_speed_ms * 3.6::double, 1) as kmh from latest)""",
        "legend_breaks": f"with {EMISSIONS}, {DAILY}, {pollution('tumbling', '1 day', ['noise'])} select "
                         "pollutants as pollutant, 'dB' as unit, '40' as lo, '65' as mid, '90' as hi, window_type, "
                         "window_duration from pollution order by window_start, window_end limit 1",
        "traffic_legend": f"{daily_traffic} select '0' as lo, '25' as mid, '50+' as hi, window_type, window_duration "
                          "from traffic order by window_start, window_end limit 1",
        "event_colours": f"""with {EMISSIONS} select event_id, {colour('norm')} as color,
          round(speed * 3.6::double, 1) as speed_kmh from (select *, {clamp('CO2', 0, 5000)} as norm from emissions)""",

        "hash_split": f"with {LABELLED} select {SPLIT.format('row_key')} as split, count(*) as rows, "
                      "sum(RelativeTimeMilliseconds)::bigint as time_sum from labelled group by 1",
        "case_split": f"with {LABELLED} select {SPLIT.format("regexp_extract(case_name, 'case([0-9]+)', 1)")} as split, "
                      "regexp_extract(case_name, 'case([0-9]+)', 1) as case_id, count(*) as rows from labelled group by 1, 2",
        "random_split": f"with {LABELLED} select count(*) as rows, count(distinct row_key) as keys, true as shares_hold from labelled",
        **{name: f"""with {TIMED}, held as (select * from timed where {SPLIT.format('row_key')} = 'test'), {segments('held')}
          select segment, count(*) as n_rows, true as in_range, true as reloaded_same from segmented group by segment"""
           for name in ("rf_cls", "gbt_cls", "rf_reg", "gbt_reg")},
        **{name: f"with {EMISSIONS}, {DAILY}, {traffic('tumbling', '1 day', types=True)} {approx}"
           for name in ("traffic_approx", "stream_traffic_approx")},
        "traffic_approx_sliding": f"with {EMISSIONS}, {SLIDING}, {traffic('sliding', '10 minutes', types=True)} {approx}",
        "stream_json_to_json": f"with {EMISSIONS}, {DAILY}, {pollution('tumbling', '1 day', POLLUTANTS)} select * from pollution",
        "stream_compacted": f"{ten_co2} select * from pollution",
        "training_summary": "select 'RF_Regressor' as model, true as timed, true as better_than_mean",
        "prediction_csv": f"""with {KNOWN_VALUES} select model, case_name, count(*) as rows,
          count(*) filter (RelativeTimeMilliseconds % 13 <> 0) as numbers,
          round(sum(prediction) filter (RelativeTimeMilliseconds % 13 <> 0), 4) as prediction_sum,
          round(sum(label_regression), 4) as label_sum from value_predictions group by model, case_name""",
        "small_share_split": f"with {LABELLED} select {SMALL_SHARES.format('row_key')} as split, count(*) as rows from labelled group by 1",
        "capped_sample": f"with {LABELLED} select row_key, HR, SpO2 from labelled "
                         "order by md5('42|' || row_key), row_key limit 5000",

        "metrics_pivot": f"with {SEGMENT_CLASS} "
                         + bars("class_metrics", ["auc", "f1", "accuracy"], ["rule_perfusion", "rule_pressure"]),
        "metrics_pivot_auc": f"with {SEGMENT_CLASS} "
                             + bars("class_metrics", ["auc"], ["rule_perfusion", "rule_pressure"], False),
        "metrics_pivot_reg": f"with {SEGMENT_VALUE} "
                             + bars("value_metrics", ["rmse", "mae", "r2"], ["rule_breath", "rule_pulse"]),
        "metric_profile": f"with {SEGMENT_CLASS} " + " union all ".join(
            f"select model, '{m}' as metric, {m} as value from class_metrics where segment = 'full_test'"
            for m in ("auc", "accuracy", "f1", "precision", "recall")),
        "auc_by_segment": f"with {SEGMENT_CLASS} select model, segment, auc from class_metrics",
        "error_points": f"with {SEGMENT_VALUE} select model, segment, rmse, mae from value_metrics",
        "dashboard": f"""select * from (with {SEGMENT_CLASS} select model, 'auc' as metric, auc as value
          from class_metrics where segment = 'full_test') union all select * from (with {SEGMENT_VALUE}
          select model, 'r2', r2 from value_metrics where segment = 'full_test')""",
        "pred_vs_actual": f"with {SCATTER} select model, label_regression, prediction from points",
        "pred_vs_actual_bounds": f"""with {KNOWN_VALUES} select model, least(min(label_regression), min(prediction)) as lo,
          greatest(max(label_regression), max(prediction)) as hi from value_predictions group by model""",
        "residual_hist": f"with {KNOWN_VALUES}, residuals as (select model, prediction - label_regression as residual "
                         f"from value_predictions), {histogram('residuals', 'residual', 60, 'model')}",
        "residual_density": f"with {density}",
        "prob_hist": f"with {LABELLED}, {class_predictions('labelled')}, "
                     + histogram("class_predictions", "probability", 50, "model, label_classification"),
        "prob_from_text": f"""with {LABELLED}, {class_predictions('labelled')} select model, count(*) as rows,
          count(*) filter (RelativeTimeMilliseconds % 13 <> 0) as parsed,
          round(sum(probability) filter (RelativeTimeMilliseconds % 13 <> 0), 4) as p_sum
          from class_predictions group by model""",
        "rows_per_case": f"with {VITALS} select case_name, count(*) as rows from vitals group by case_name",
        "longest_case_trace": f"""with {KNOWN_VALUES}, longest as (select case_name from value_predictions
          group by case_name order by count(*) desc, case_name limit 1)
          select case_name, round(RelativeTimeMilliseconds / 60000.0::double, 9) as minutes, model,
          label_regression as actual, prediction as predicted from value_predictions join longest using (case_name)""",
        "models_present": f"with {KNOWN_VALUES} select distinct model from value_predictions",

        "inventory_summary": f"with {FILES} select count(*) as files, sum(size)::bigint as bytes, "
                             "sum(size) / (1024.0::double ** 3) as gb from files",
        "budget_sample": f"with {FILES} select file_name, size from shuffled, total "
                         "where before + size <= floor(total * 0.4::double)::bigint",
        "budget_sample_rows": f"""with {FILES}, chosen as (select file_name from shuffled, total
          where before + size <= floor(total * 0.4::double)::bigint)
          select case_name, count(*) as rows, max(HR) as max_hr from vitals join chosen on case_name = file_name
          group by case_name""",
        "landing_stream": f"with {raw} select row_key, HR, NBP_Sys, Alarm_1 from raw",
        "greedy_budget_sample": "with recursive " + FILES + greedy,
        "replicate_to_size": f"with {COPIES} select file_name, source_name, size, copy from copies",
        "replicate_rows": f"with {COPIES} select file_name as case_name, count(*) as rows, max(HR) as max_hr "
                          "from copies join vitals on case_name = source_name group by file_name",
        "incremental_landing": f"with {FILES}, {LANDED} select file_name, size from files "
                               "where file_name not in (select file_name from landed)",
        "landing_report": f"with {FILES}, {LANDED} select count(*) filter (l.file_name is null) as copied, "
                          "count(*) filter (l.file_name is not null) as skipped "
                          "from files f left join landed l using (file_name)",
        "landing_check": f"""with {FILES} select count(*) as files, round(sum(size) / (1024.0::double ** 3), 9) as gb,
          count(distinct c) as cases, arg_min(c, c::hugeint) as first_case, arg_max(c, c::hugeint) as last_case
          from (select *, regexp_extract(file_name, 'case([0-9]+)', 1) as c from files)""",
        "landing_quarantine": f"""with {raw} select case when Set_RR = 11 then 'quarantined' else 'landed' end as kind,
          case when Set_RR = 11 then 1 else count(*) end as counted from raw group by 1, Set_RR = 11""",
        "discovered_recordings": f"with {VITALS} select case_name, count(*) as rows, max(HR) as max_hr from vitals group by case_name",
        "budget_sample_scan": "select true as within_budget, true as only_selected_scanned, true as all_rows_read",

    }
    return sql
