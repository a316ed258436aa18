"""The registered queries as SQL for DuckDB, written independently of the operators.

Only the mapping of the sample tables is shared with the Spark side.
"""

from __future__ import annotations

from roadledger.plans.table_queries import KNOWN_COEFFICIENTS
from roadledger.sources.sample_tables import SAMPLE_SQL

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
EARLIER = "TIMESTAMP '2024-01-16 00:00:00'"
DAY = "DATE '2024-01-31'"

_TABLES = {name: sql.format(events="events", orders="orders", customer="customer", part="part")
           for name, sql in SAMPLE_SQL.items()}

FORCES = {
    "calculated_g_force": "sqrt(accelerometer_x*accelerometer_x + accelerometer_y*accelerometer_y"
                          " + accelerometer_z*accelerometer_z) / 9.81",
    "lateral_g_force": "sqrt(accelerometer_x*accelerometer_x + accelerometer_y*accelerometer_y) / 9.81",
    "vertical_g_force": "abs((accelerometer_z - 9.81) / 9.81)",
    "gyro_magnitude": "sqrt(gyroscope_x*gyroscope_x + gyroscope_y*gyroscope_y + gyroscope_z*gyroscope_z)",
}
SEVERITY = """case when g_force >= 8 then 'CRITICAL' when g_force >= 6 then 'SEVERE'
  when g_force >= 4 then 'HIGH' when g_force >= 2 then 'MODERATE' else 'NORMAL' end"""
PRIORITY = """case when emergency_recommended and risk_score >= 90 then 'IMMEDIATE_RESPONSE'
  when emergency_recommended and risk_score >= 70 then 'URGENT_RESPONSE'
  when risk_score >= 50 then 'STANDARD_RESPONSE' else 'LOW_PRIORITY' end"""
RANK = """case when emergency_recommended and risk_score >= 90 then 1
  when emergency_recommended and risk_score >= 70 then 2 when risk_score >= 50 then 3 else 4 end"""
HOUR = "extract(hour from crash_timestamp)"
TIME = f"""case when {HOUR} between 6 and 9 then 'MORNING_RUSH' when {HOUR} between 17 and 19
  then 'EVENING_RUSH' when {HOUR} between 22 and 5 then 'NIGHT' else 'DAYTIME' end"""
TIME_WRAPPED = TIME.replace(f"{HOUR} between 22 and 5", f"({HOUR} >= 22 or {HOUR} <= 5)")


def category(score: str) -> str:
    return f"""case when {score} >= 90 then 'EXCELLENT' when {score} >= 80 then 'GOOD'
  when {score} >= 70 then 'AVERAGE' when {score} >= 60 then 'POOR' else 'HIGH_RISK' end"""


def num(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(28,10)), {digits}) as decimal(18,{digits}))"


def rate(part: str, whole: str) -> str:
    return f"cast(cast((({part}) * 20000 + {whole}) // (2 * {whole}) as decimal(18,0)) * 0.01 as decimal(5,2))"


def features(name: str, source: str, at: str, extra: str = "") -> str:
    return f"""{name} as (select driver_id, count(*) as total_events,
  {rate("count(*) - count(*) filter (where speed_mph > speed_limit_mph)", "count(*)")} as speed_compliance_rate,
  {num("avg(g_force)", 4)} as avg_g_force,
  count(*) filter (where g_force > 1.5) as harsh_driving_events,
  {rate("count(*) filter (where device_screen_on and speed_mph > 5)", "count(*)")} as phone_usage_rate,
  {num("stddev_samp(speed_mph)", 2)} as speed_variance,
  {num("avg(speed_mph)", 2)} as avg_speed, {num("max(speed_mph)", 2)} as max_speed,
  count(*) filter (where speed_mph > speed_limit_mph + 10) as excessive_speeding_count,
  {at} as last_updated {extra}
  from {source} where driver_id is not null group by driver_id)"""


EXTENDED = f""",
  {num("avg(case when speed_mph > speed_limit_mph then speed_mph - speed_limit_mph else 0 end)", 2)}
    as avg_speed_violation,
  {num("max(g_force)", 4)} as max_g_force,
  count(*) filter (where g_force > 3) as extreme_events,
  count(*) filter (where device_battery_level < 20 and speed_mph > 0) as low_battery_driving_events,
  {num("var_samp(speed_mph)", 4)} as speed_variance_squared,
  {num('''var_samp(accelerometer_x*accelerometer_x + accelerometer_y*accelerometer_y
    + accelerometer_z*accelerometer_z)''', 4)} as acceleration_variance"""


def training(name: str, source: str) -> str:
    return f"""{name} as (select f.*, coalesce(a.n, 0) as accident_count,
  case when a.n > 0 then 1 else 0 end as has_accident
  from {source} f left join (select driver_id, count(*) as n from accidents group by driver_id) a
  on f.driver_id = a.driver_id)"""


DETAIL = """total_events, speed_compliance_rate, avg_g_force, harsh_driving_events, phone_usage_rate,
  accident_count"""


def weighted(name: str, source: str) -> str:
    return f"""{name} as (select *, {category("safe_driver_score")} as risk_category from (
  select driver_id, cast(round(greatest(0, 25 - accident_count * 12.5) + speed_compliance_rate * 0.30
    + greatest(0, 20 - phone_usage_rate * 0.40) + greatest(0, 15 - harsh_driving_events * 0.025)
    + greatest(0, 10 - greatest(0, speed_variance - 6) * 0.65), 2) as decimal(5,2)) as safe_driver_score,
  {DETAIL} from {source}) s)"""


_INPUTS = ("speed_compliance_rate", "avg_g_force", "harsh_driving_events", "phone_usage_rate", "speed_variance")
_Z = f"cast({KNOWN_COEFFICIENTS[0]} as double)" + "".join(
    f" + cast({c} as double) * cast({name} as double)" for c, name in zip(KNOWN_COEFFICIENTS[1:], _INPUTS))
PREDICTED = f"predicted as (select *, 1 / (1 + exp(-({_Z}))) as accident_probability from training)"
LOGISTIC = f"""logistic as (select *, {category("safe_driver_score")} as risk_category from (
  select driver_id, accident_probability,
    cast(round(cast(100 * (1 - accident_probability) as decimal(28,10)), 2) as decimal(5,2)) as safe_driver_score,
    {DETAIL} from predicted) s)"""

WEIGHTED_NOTES = """concat('Risk: ', risk_category, ' | Accidents: ', accident_count, ' (25%)',
  ' | Speed: ', speed_compliance_rate, '% (30%)', ' | Phone: ', phone_usage_rate, '% (20%)',
  ' | Harsh: ', harsh_driving_events, ' (15%)', ' | Model: Weighted Formula v4')"""
LOGISTIC_NOTES = """concat('ML Risk Category: ', risk_category,
  ' | Speed Compliance: ', speed_compliance_rate, '%', ' | Harsh Events: ', harsh_driving_events,
  ' | Phone Usage: ', phone_usage_rate, '%', ' | Accidents: ', accident_count,
  ' | Model: MADlib Logistic Regression')"""

_STEPS = {
    "features": features("features", "telemetry", AS_OF),
    "features_extended": features("features_extended", "telemetry", AS_OF, EXTENDED),
    "early": f"early as (select * from telemetry where event_ts < {EARLIER})",
    "early_features": features("early_features", "early", EARLIER),
    "training": training("training", "features"),
    "early_training": training("early_training", "early_features"),
    "weighted": weighted("weighted", "training"),
    "early_weighted": weighted("early_weighted", "early_training"),
    "predicted": PREDICTED,
    "logistic": LOGISTIC,
    "history": f"""history as (
  select concat('a-', driver_id) as score_id, driver_id, safe_driver_score as score,
    {EARLIER} as calculation_date, {WEIGHTED_NOTES} as notes from early_weighted
  union all select concat('b-', driver_id), driver_id, safe_driver_score, {AS_OF}, {WEIGHTED_NOTES} from weighted
  union all select concat('c-', driver_id), driver_id, safe_driver_score,
    TIMESTAMP '2024-01-31 00:00:01', {LOGISTIC_NOTES} from logistic where safe_driver_score is not null)""",
    "current_scores": f"""current_scores as (select driver_id, score, calculation_date, notes,
  {category("score")} as risk_category from (select *, row_number() over (partition by driver_id
    order by calculation_date desc, score_id desc) as rn from history) h where rn = 1)""",
    "owned": f"""owned as (select c.*, v.make, v.model, v.year as vehicle_year, p.policy_number,
  p.status as policy_status, u.first_name, u.last_name, u.email from crash c
  left join vehicles v on c.vin = v.vin left join policies p on cast(c.policy_id as bigint) = p.policy_id
  left join customers u on p.customer_id = u.customer_id)""",
    "now_files": """now_files as (select date, count(*) as files from telemetry group by date)""",
    "kept": "kept as (select * from telemetry where date <> DATE '2024-01-15')",
    "kept_features": features("kept_features", "kept", AS_OF),
    "then_files": """then_files as (select cast(date + interval 7 day as date) as date, count(*) as files
  from telemetry group by 1)""",
}
_NEEDS = {
    "features": ["telemetry"], "features_extended": ["telemetry"], "early": ["telemetry"],
    "early_features": ["early"], "training": ["features", "accidents"],
    "early_training": ["early_features", "accidents"], "weighted": ["training"],
    "early_weighted": ["early_training"], "predicted": ["training"], "logistic": ["predicted"],
    "history": ["weighted", "early_weighted", "logistic"], "current_scores": ["history"],
    "owned": ["crash", "vehicles", "policies", "customers"],
    "now_files": ["telemetry"], "then_files": ["telemetry"],
    "kept": ["telemetry"], "kept_features": ["kept"],
}


def _ordered(names: list[str], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _ordered(_NEEDS.get(name, []), done)
            done.append(name)
    return done


def build(needs: str, columns: str, body: str) -> str:
    """``body`` over the named steps, its columns brought to comparable types.

    ``columns`` lists names, each with an optional kind: ``:n`` BIGINT, ``:d`` double
    rounded to four digits, ``:x`` decimal as double, ``:t`` timestamp.
    """
    ctes = [_STEPS.get(name) or f"{name} as ({_TABLES[name]})" for name in _ordered(needs.split(), [])]
    out = []
    for column in columns.split():
        name, _, kind = column.partition(":")
        value = {
            "": name,
            "n": f"cast({name} as bigint)",
            "d": f"cast(round(cast({name} as decimal(28,10)), 4) as double)",
            "x": f"cast({name} as double)",
            "t": f"cast({name} as timestamp)",
        }[kind]
        out.append(f"{value} as {name}")
    return f"with {', '.join(ctes)} select {', '.join(out)} from ({body}) final"


def _customer_risk(fanout: bool) -> str:
    """The fan-out form joins literally; the plain form aggregates each side by itself."""
    label = """case when crash_count > 0 then 'HIGH_RISK' when high_gforce_events > 10
  or speeding_events > 20 then 'MEDIUM_RISK' else 'LOW_RISK' end as risk_category"""
    tel = f"(select * from telemetry where date >= {DAY} - 30) vt"
    crash = f"(select * from crash where report_date >= {DAY} - 365) cr"
    if fanout:
        return f"""select *, {label} from (select c.customer_id, c.first_name || ' ' || c.last_name as customer_name,
  c.email, count(distinct vt.vin) as vehicles_count, avg(vt.g_force) as avg_g_force,
  count(*) filter (where vt.g_force > 2.0) as high_gforce_events, avg(vt.speed_mph) as avg_speed,
  count(*) filter (where vt.speed_mph > 80) as speeding_events, count(cr.report_id) as crash_count,
  max(cr.risk_score) as max_crash_risk_score,
  count(*) filter (where cr.emergency_recommended) as emergency_crashes
  from customers c join policies p on c.customer_id = p.customer_id
  left join {tel} on p.policy_id = vt.policy_id
  left join {crash} on cast(p.policy_id as string) = cr.policy_id
  where p.status = 'ACTIVE' group by c.customer_id, c.first_name, c.last_name, c.email
  having count(distinct vt.event_ts) > 0) r"""
    return f"""select *, {label} from (select c.customer_id, c.first_name || ' ' || c.last_name as customer_name,
  c.email, t.vehicles_count, t.avg_g_force, t.high_gforce_events, t.avg_speed, t.speeding_events,
  coalesce(k.crash_count, 0) as crash_count, k.max_crash_risk_score,
  coalesce(k.emergency_crashes, 0) as emergency_crashes from customers c
  join (select p.customer_id, count(distinct vt.vin) as vehicles_count, avg(vt.g_force) as avg_g_force,
    count(*) filter (where vt.g_force > 2.0) as high_gforce_events, avg(vt.speed_mph) as avg_speed,
    count(*) filter (where vt.speed_mph > 80) as speeding_events
    from policies p join {tel} on p.policy_id = vt.policy_id where p.status = 'ACTIVE'
    group by p.customer_id having count(distinct vt.event_ts) > 0) t on t.customer_id = c.customer_id
  left join (select p.customer_id, count(cr.report_id) as crash_count,
    max(cr.risk_score) as max_crash_risk_score,
    count(*) filter (where cr.emergency_recommended) as emergency_crashes
    from policies p join {crash} on cast(p.policy_id as string) = cr.policy_id where p.status = 'ACTIVE'
    group by p.customer_id) k on k.customer_id = c.customer_id) r"""


_RISK_ORDER = "order by crash_count desc, high_gforce_events desc, customer_id"
_RISK_COLUMNS = """customer_id:n customer_name email vehicles_count:n avg_g_force:d high_gforce_events:n
  avg_speed:d speeding_events:n crash_count:n max_crash_risk_score:d emergency_crashes:n risk_category"""
_RISK_NEEDS = "customers policies telemetry crash"


def _vehicle_safety(fanout: bool) -> str:
    tel = f"(select * from telemetry where date >= {DAY} - 90) vt"
    crash = f"(select * from crash where report_date >= {DAY} - 365) cr"
    order = """order by round(crashes_per_vehicle, 6) desc nulls first, round(avg_g_force, 6) desc nulls first,
  make, model, year limit 15"""
    ratio = "cast(total_crashes as double) / vehicle_count as crashes_per_vehicle"
    if fanout:
        return f"""select *, {ratio} from (select v.make, v.model, v.year, count(distinct vt.vin) as vehicle_count,
  avg(vt.g_force) as avg_g_force, count(cr.report_id) as total_crashes, avg(vt.speed_mph) as avg_speed,
  avg(vt.device_battery_level) as avg_device_health, avg(vt.gps_accuracy) as avg_gps_accuracy
  from vehicles v left join {tel} on v.vin = vt.vin left join {crash} on v.vin = cr.vin
  group by v.make, v.model, v.year having count(distinct vt.event_ts) > 100) g {order}"""
    return f"""select *, {ratio} from (select t.*, coalesce(k.n, 0) as total_crashes from (
  select v.make, v.model, v.year, count(distinct vt.vin) as vehicle_count, avg(vt.g_force) as avg_g_force,
  avg(vt.speed_mph) as avg_speed, avg(vt.device_battery_level) as avg_device_health,
  avg(vt.gps_accuracy) as avg_gps_accuracy from vehicles v join {tel} on v.vin = vt.vin
  group by v.make, v.model, v.year having count(distinct vt.event_ts) > 100) t
  left join (select v.make, v.model, v.year, count(cr.report_id) as n from vehicles v
  join {crash} on v.vin = cr.vin group by v.make, v.model, v.year) k
  on t.make = k.make and t.model = k.model and t.year = k.year) g {order}"""


_SAFETY_COLUMNS = """make model year:n vehicle_count:n avg_g_force:d total_crashes:n crashes_per_vehicle:d
  avg_speed:d avg_device_health:d avg_gps_accuracy:d"""

_FEATURE_COLUMNS = """driver_id:n total_events:n speed_compliance_rate:x avg_g_force:x harsh_driving_events:n
  phone_usage_rate:x speed_variance:x avg_speed:x max_speed:x excessive_speeding_count:n last_updated:t"""
_SCORE_COLUMNS = """driver_id:n safe_driver_score:x risk_category total_events:n speed_compliance_rate:x
  avg_g_force:x harsh_driving_events:n phone_usage_rate:x accident_count:n"""
_SUMMARY_COLUMNS = """record_count:n avg_speed:d max_speed:d avg_g_force:d max_g_force:d high_gforce_events:n
  speeding_events:n speed_limit_violations:n avg_battery_level:d avg_gps_accuracy:d"""


def _summary(where: str = "true") -> str:
    return f"""select policy_id, vin, cast(event_ts as date) as date, count(*) as record_count,
  avg(speed_mph) as avg_speed, max(speed_mph) as max_speed, avg(g_force) as avg_g_force,
  max(g_force) as max_g_force, count(*) filter (where g_force > 2.0) as high_gforce_events,
  count(*) filter (where speed_mph > 80) as speeding_events,
  count(*) filter (where speed_mph > speed_limit_mph) as speed_limit_violations,
  avg(device_battery_level) as avg_battery_level, avg(gps_accuracy) as avg_gps_accuracy
  from telemetry where {where} group by policy_id, vin, cast(event_ts as date)"""


_HOTSPOTS = """select round(cast(crash_latitude as decimal(20,12)), 3) as lat_zone,
  round(cast(crash_longitude as decimal(20,12)), 3) as lng_zone, count(*) as crash_count,
  avg(risk_score) as avg_risk_score, count(*) filter (where emergency_recommended) as emergency_crashes,
  string_agg(distinct current_street, ', ' order by current_street) as streets,
  max(crash_timestamp) as latest_crash from crash group by 1, 2 having count(*) >= 2"""
_HOTSPOT_COLUMNS = "lat_zone:x lng_zone:x crash_count:n avg_risk_score:d emergency_crashes:n streets latest_crash:t"

_HIGH_G = f"""select policy_id, vin, event_ts, current_street, speed_mph, speed_limit_mph, g_force, gps_latitude,
  gps_longitude, accelerometer_x, accelerometer_y, accelerometer_z,
  {FORCES["calculated_g_force"]} as calculated_g_force, {SEVERITY} as severity_level
  from telemetry where g_force >= 2.0"""

_BANDS = """count(*) filter (where score >= 90) as excellent,
  count(*) filter (where score >= 80 and score < 90) as good,
  count(*) filter (where score >= 70 and score < 80) as average,
  count(*) filter (where score >= 60 and score < 70) as poor,
  count(*) filter (where score < 60) as high_risk"""


def _missing(table: str, place: str, extra: str, day: str, days: int, source: str) -> str:
    return f"""select '{table}' as table_name, count(*) as total_records,
  count(*) filter (where policy_id is null) as missing_policy_id,
  count(*) filter (where vin is null) as missing_vin,
  count(*) filter (where {place} is null) as missing_gps,
  count(*) filter (where {extra} is null) as missing_device_data,
  count(distinct {day}) as unique_dates, count(distinct cast(policy_id as string)) as unique_policies
  from {source} where {day} >= {DAY} - {days}"""


def _orphan(child: str, fk: str, parent: str, pk: str) -> str:
    source = "current_scores" if child == "safe_driver_scores" else child
    return f"""select '{child}.{fk} -> {parent}.{pk}' as reference, count(*) as orphan_rows,
  count(distinct {fk}) as orphan_keys from {source}
  where {fk} is not null and {fk} not in (select {pk} from {parent})"""


_REFERENCES = (
    ("policies", "customer_id", "customers", "customer_id"), ("vehicles", "policy_id", "policies", "policy_id"),
    ("drivers", "policy_id", "policies", "policy_id"), ("accidents", "policy_id", "policies", "policy_id"),
    ("accidents", "vehicle_id", "vehicles", "vehicle_id"), ("accidents", "driver_id", "drivers", "driver_id"),
    ("claims", "accident_id", "accidents", "accident_id"), ("safe_driver_scores", "driver_id", "drivers", "driver_id"),
)


def _duplicate(name: str, key: str) -> str:
    source = {"driver_behavior_features": "features", "safe_driver_scores": "history"}.get(name, name)
    return f"""select '{name}' as table_name, count(*) as duplicate_keys,
  coalesce(sum(n - 1), 0) as surplus_rows from (select {key}, count(*) as n from {source}
  group by {key} having count(*) > 1) d"""


_KEYS = {"customers": "customer_id", "policies": "policy_id", "vehicles": "vehicle_id", "drivers": "driver_id",
         "accidents": "accident_id", "claims": "claim_id", "driver_behavior_features": "driver_id",
         "safe_driver_scores": "score_id"}

# Written from the declared tables: NOT NULL and primary keys, VARCHAR(n), CHECK, NUMERIC(p,s).
_NOT_NULL = {
    "customers": "customer_id first_name last_name email", "policies": "policy_id customer_id policy_number start_date end_date",
    "vehicles": "vehicle_id policy_id vin make model year",
    "drivers": "driver_id policy_id first_name last_name date_of_birth license_number",
    "accidents": "accident_id policy_id vehicle_id driver_id accident_timestamp", "claims": "claim_id accident_id claim_date",
    "history": "score_id driver_id score calculation_date"}
_LENGTH = {
    "customers": "first_name=50 last_name=50 email=255 phone_number=20 address=255 city=100 state=2 zip_code=10",
    "policies": "policy_number=20 status=20", "vehicles": "make=50 model=50 color=30",
    "drivers": "first_name=50 last_name=50 license_number=20", "claims": "status=20"}
_RULES = [
    *[(t, c, "not null", f"{c} is null") for t, names in _NOT_NULL.items() for c in names.split()],
    *[(t, c, f"length <= {n}", f"length({c}) > {n}") for t, lengths in _LENGTH.items()
      for c, n in (x.split("=") for x in lengths.split())],
    ("policies", "status", "in ACTIVE/EXPIRED/CANCELLED", "status not in ('ACTIVE', 'EXPIRED', 'CANCELLED')"),
    ("vehicles", "vin", "length = 17", "length(vin) <> 17"),
    ("claims", "status", "in PENDING/APPROVED/DENIED", "status not in ('PENDING', 'APPROVED', 'DENIED')"),
    *[("accidents", c, f"numeric({p})", f"abs({c}) >= {top}") for c, p, top in
      (("latitude", "10,7", 1000), ("longitude", "10,7", 1000), ("g_force", "4,2", 100))],
    ("claims", "amount", "numeric(10,2)", "abs(amount) >= 100000000"),
    ("history", "score", "numeric(5,2)", "abs(score) >= 1000"),
]
# Declared columns that the mapped tables do not have: their rules have a line without a number.
_ABSENT = {("customers", c) for c in "phone_number address city state zip_code".split()} | {
    ("policies", "end_date"), ("drivers", "date_of_birth"), ("drivers", "license_number"), ("claims", "amount"),
    ("accidents", "latitude"), ("accidents", "longitude"), ("accidents", "g_force")}
_DOMAIN = " union all ".join(
    f"select '{'safe_driver_scores' if t == 'history' else t}' as table_name, '{c}' as column_name, '{rule}' as rule, "
    + ("null" if (t, c) in _ABSENT else f"count(*) filter (where {broken})")
    + f" as broken_rows, count(*) as checked_rows from {t}"
    for t, c, rule, broken in _RULES)

_D = "cast({} as double)".format

_COMPOSITE = f"""select driver_id, speed_score, smoothness_score, harsh_driving_score, distraction_score,
  accident_score, round(greatest(0, least(100, total)), 2) as safe_driver_score,
  case when round(total, 2) >= 90 then 'EXCELLENT' when round(total, 2) >= 80 then 'GOOD'
    when round(total, 2) >= 60 then 'AVERAGE' when round(total, 2) >= 40 then 'POOR' else 'HIGH_RISK' end
    as risk_category, {DETAIL} from (select *, speed_score * 0.4 + smoothness_score * 0.15
    + harsh_driving_score * 0.15 + distraction_score * 0.2 + accident_score * 0.1 as total from (
  select *, greatest(0, 100 - (100 - speed_compliance_rate) * 2) as speed_score,
    greatest(0, 100 - (avg_g_force - 1.0) * 50) as smoothness_score,
    greatest(0, 100 - harsh_driving_events * 2) as harsh_driving_score,
    greatest(0, 100 - phone_usage_rate * 3) as distraction_score,
    greatest(0, 100 - accident_count * 20) as accident_score from training) p) q"""

# Weighted least squares by Newton steps from zero: each step sums the normal equations at the
# coefficients so far and solves them by elimination, pivots 1 to 6 in turn. A step that makes
# the loss larger is halved until it does not.
_FIT_X = "[cast(1 as double), " + ", ".join(f"cast({c} as double)" for c in _INPUTS) + "]"
_FIT = f"""
rows_ as (select {_FIT_X} as x, cast(has_accident as double) as y from training
  where {" and ".join(f"{c} is not null" for c in _INPUTS)}),
fit(step, beta, loss) as (
  select 0, [cast(0 as double) for i in range(6)], count(*) * ln(cast(2 as double)) from rows_
  union all
  select step + 1, tried.beta, tried.loss from (
    select step, loss, beta, [m[i][7] for i in range(1, 7)] as move from (
      select step, loss, beta, list_reduce(list_concat([matrix], [[[cast(k as double)]] for k in range(1, 7)]),
        lambda m, s: [[case when i = cast(s[1][1] as int) then m[i][j] / m[i][i]
            else m[i][j] - m[i][cast(s[1][1] as int)] * m[cast(s[1][1] as int)][j]
              / m[cast(s[1][1] as int)][cast(s[1][1] as int)] end for j in range(1, 8)] for i in range(1, 7)]) as m
      from (
        select step, loss, beta, [[sums[7 * (i - 1) + j] for j in range(1, 8)] for i in range(1, 7)] as matrix from (
          select step, any_value(loss) as loss, any_value(beta) as beta, [{", ".join(
              f"sum(p * (1 - p) * x[{i}] * x[{j}])" if j < 7 else f"sum((y - p) * x[{i}])"
              for i in range(1, 7) for j in range(1, 8))}] as sums
          from (select step, loss, beta, x, y, 1 / (1 + exp(-list_sum([beta[i] * x[i] for i in range(1, 7)]))) as p
            from fit, rows_ where step < 20) f group by step) s) t) u) v,
    lateral (
      select b as beta, loss from (
        select h, b, sum(ln(1 + exp(-abs(z))) + greatest(z, 0) - y * z) as loss from (
          select h, b, y, list_sum([b[i] * x[i] for i in range(1, 7)]) as z
          from rows_, (select h, [v.beta[i] + v.move[i] / (1 << h) for i in range(1, 7)] as b
            from range(11) hs(h)) c) e group by h, b) g
      order by case when loss <= v.loss * (1 + 1e-12) + 1e-12 then h else 100 - h end limit 1) tried)"""

_CLEANUP_COLUMNS = """total_files:n small_files:n bytes_before:n bytes_after:n bytes_freed:n small_below_1kb:n
  small_from_1kb:n reduction_percent:d health"""


def _cleanup(threshold: int) -> str:
    return f"""select *, floor(cast(bytes_freed * 10000 as double) / bytes_before) / cast(100 as double) as reduction_percent,
  case when small_files = 0 then 'healthy' when small_files < 10 then 'acceptable' when small_files < 100 then 'moderate'
    else 'high' end as health
  from (select count(*) as total_files, count(*) filter (where bytes <= {threshold}) as small_files,
    sum(bytes) as bytes_before, coalesce(sum(bytes) filter (where bytes > {threshold}), 0) as bytes_after,
    coalesce(sum(bytes) filter (where bytes <= {threshold}), 0) as bytes_freed,
    count(*) filter (where bytes < 1024) as small_below_1kb,
    count(*) filter (where bytes between 1024 and 10240) as small_from_1kb
    from (select event_id * 37 % 20000 as bytes from telemetry) f) s"""


ORACLE: dict[str, str] = {
    # scalar derivations
    **{name: build("telemetry", f"event_id:n {name}:d", f"select event_id, {sql} as {name} from telemetry")
       for name, sql in FORCES.items()},
    "severity_level": build("telemetry", "event_id:n severity_level",
                            f"select event_id, {SEVERITY} as severity_level from telemetry"),
    "response_priority_label": build("crash", "report_id response_priority",
                                     f"select report_id, {PRIORITY} as response_priority from crash"),
    "response_priority_rank": build("crash", "report_id response_priority:n",
                                    f"select report_id, {RANK} as response_priority from crash"),
    "crash_hour": build("crash", "report_id crash_hour:n", f"select report_id, {HOUR} as crash_hour from crash"),
    "crash_day_of_week": build("crash", "report_id crash_day_of_week:n",
                               "select report_id, extract(dow from crash_timestamp) as crash_day_of_week from crash"),
    "time_category": build("crash", "report_id time_category", f"select report_id, {TIME} as time_category from crash"),
    "time_category_wrapped": build("crash", "report_id time_category",
                                   f"select report_id, {TIME_WRAPPED} as time_category from crash"),
    "risk_category": build("weighted", "driver_id:n risk_category", "select * from weighted"),
    "customer_name": build("customers", "customer_id:n customer_name",
                           "select customer_id, first_name || ' ' || last_name as customer_name from customers"),
    "vehicle_description": build("vehicles", "vehicle_id:n vehicle_description make_and_color", """
  select vehicle_id, make || ' ' || model || ' (' || year || ')' as vehicle_description,
  make || ' ' || color as make_and_color from vehicles"""),
    "score_notes": build("weighted", "driver_id:n notes", f"select driver_id, {WEIGHTED_NOTES} as notes from weighted"),
    "score_notes_model": build("logistic", "driver_id:n notes",
                               f"select driver_id, {LOGISTIC_NOTES} as notes from logistic"),
    "minutes_since_crash": build("crash", "report_id minutes_since_crash:d", f"""
  select report_id, (epoch_us({AS_OF}) - epoch_us(crash_timestamp)) / cast(60000000 as double)
  as minutes_since_crash from crash"""),
    "event_date": build("telemetry", "event_id:n from_seconds from_millis from_iso", """
  select event_id, date as from_seconds, date as from_millis, date as from_iso from telemetry"""),
    "geo_zone": build("crash", "report_id lat_zone:x lng_zone:x", """
  select report_id, round(cast(crash_latitude as decimal(20,12)), 3) as lat_zone,
  round(cast(crash_longitude as decimal(20,12)), 3) as lng_zone from crash"""),
    "policy_key_cast": build("crash", "report_id policy_key:n", """
  select report_id, try_cast(case when policy_id like '%7' then 'P-' || policy_id else policy_id end as bigint)
  as policy_key from crash"""),
    # filters
    "high_gforce_events": build("telemetry", """policy_id:n vin event_ts:t current_street speed_mph:d
  speed_limit_mph:d g_force:d gps_latitude:d gps_longitude:d accelerometer_x:d accelerometer_y:d
  accelerometer_z:d calculated_g_force:d severity_level""", _HIGH_G),
    "recent_high_gforce_events": build(
        "telemetry", "policy_id:n vin event_ts:t current_street g_force:d speed_mph:d severity_level",
        f"""select * from ({_HIGH_G}) h where event_ts >= {AS_OF} - interval 24 hour
  order by g_force desc, event_ts desc, vin limit 20"""),
    "trailing_window": build("telemetry", "days:n events:n", " union all ".join(
        f"select {n} as days, count(*) as events from telemetry where date >= {DAY} - {n}"
        for n in (3, 7, 30, 90, 365))),
    "not_null_driver": build("telemetry", "event_id:n driver_id:n",
                             "select * from telemetry where driver_id is not null"),
    "post_agg_filter": build("telemetry", "vin events:n fast:n policies:n", """
  select vin, count(*) as events, count(*) filter (where speed_mph > 80) as fast,
  count(distinct policy_id) as policies from telemetry group by vin
  having count(*) >= 2 and count(*) filter (where speed_mph > 80) > 0 and count(distinct policy_id) > 0"""),
    "status_filter": build("policies", "policy_id:n customer_id:n policy_number",
                           "select * from policies where status = 'ACTIVE'"),
    "partition_equality": build("telemetry", "event_id:n g_force:d",
                                "select * from telemetry where date = DATE '2024-01-15' and g_force > 1.0"),
    "partition_prefix": build("now_files", "date files:n",
                              "select * from now_files where cast(date as string) like '2024-01-1%'"),
    "high_risk_drivers": build("current_scores", "driver_id:n score:x risk_category",
                               "select * from current_scores where score < 60"),
    # joins
    "telemetry_enriched": build(
        "telemetry vehicles policies customers", """event_id:n policy_id:n vin event_ts:t speed_mph:d g_force:d
  calculated_g_force:d lateral_g_force:d vertical_g_force:d gyro_magnitude:d make model vehicle_year:n color
  policy_number policy_status first_name last_name email""",
        "select vt.*, " + ", ".join(f"{sql} as {name}" for name, sql in FORCES.items()) + """,
  v.make, v.model, v.year as vehicle_year, v.color, p.policy_number, p.status as policy_status,
  c.first_name, c.last_name, c.email from telemetry vt left join vehicles v on vt.vin = v.vin
  left join policies p on vt.policy_id = p.policy_id left join customers c on p.customer_id = c.customer_id"""),
    "crash_enriched": build(
        "owned", """report_id policy_id vin crash_timestamp:t crash_type risk_score:d make model
  vehicle_year:n policy_number policy_status first_name last_name email response_priority crash_hour:n
  crash_day_of_week:n time_category""",
        f"""select *, {PRIORITY} as response_priority, {HOUR} as crash_hour,
  extract(dow from crash_timestamp) as crash_day_of_week, {TIME} as time_category from owned"""),
    "driver_training_data": build("training", _FEATURE_COLUMNS + " accident_count:n has_accident:n",
                                  "select * from training"),
    "customers_policies": build("customers policies", "customer_id:n policy_id:n policy_number status", """
  select c.customer_id, p.policy_id, p.policy_number, p.status from customers c
  join policies p on c.customer_id = p.customer_id"""),
    "on_clause_restriction": build("policies telemetry", "policy_id:n events:n", f"""
  select p.policy_id, count(vt.event_id) as events from policies p left join telemetry vt
  on p.policy_id = vt.policy_id and vt.date >= {DAY} - 7 where p.status = 'ACTIVE' group by p.policy_id"""),
    "new_data_gate": build("telemetry early_features", "new_records:n drivers:n", """
  select count(*) as new_records, count(distinct t.driver_id) as drivers from telemetry t
  left join early_features f on t.driver_id = f.driver_id
  where t.event_ts > coalesce(f.last_updated, TIMESTAMP '2024-01-01 00:00:00') or f.driver_id is null"""),
    "drivers_with_new_data": build("telemetry early_features", "driver_id:n latest_event:t", """
  select t.driver_id, max(t.event_ts) as latest_event from telemetry t
  left join early_features f on t.driver_id = f.driver_id
  where t.event_ts > coalesce(f.last_updated, TIMESTAMP '2024-01-01 00:00:00') or f.driver_id is null
  group by t.driver_id"""),
    "scalar_broadcast": build("predicted", "driver_id:n accident_probability:d", "select * from predicted"),
    "inventory_diff": build("now_files then_files", "date files_now:n files_before:n diff:n change", """
  select coalesce(n.date, t.date) as date, coalesce(n.files, 0) as files_now, coalesce(t.files, 0) as files_before,
  coalesce(n.files, 0) - coalesce(t.files, 0) as diff, case when t.date is null then 'added'
  when n.date is null then 'removed' else 'kept' end as change
  from now_files n full outer join then_files t on n.date = t.date"""),
    # aggregations
    "driver_behavior_features": build("features", _FEATURE_COLUMNS, "select * from features"),
    "driver_behavior_metrics": build("features_extended", _FEATURE_COLUMNS + """ avg_speed_violation:x
  max_g_force:x extreme_events:n low_battery_driving_events:n speed_variance_squared:x acceleration_variance:x""",
                                     "select * from features_extended"),
    "vehicle_behavior_summary": build("telemetry", "policy_id:n vin date " + _SUMMARY_COLUMNS, _summary()),
    "vehicle_behavior_summary_by_folder": build(
        "telemetry", "policy_id:n vin date " + _SUMMARY_COLUMNS, _summary()),
    "top_vehicle_behavior": build("telemetry", "policy_id:n vin date " + _SUMMARY_COLUMNS, _summary(
        f"date >= {DAY} - 7") + " order by max_g_force desc nulls first, date desc, policy_id nulls last, vin limit 10"),
    "crash_patterns": build("crash", """crash_type crash_count:n avg_risk_score:d avg_g_force:d
  avg_impact_speed:d emergency_cases:n rollover_cases:n spinning_cases:n avg_crash_hour:d weekend_crashes:n
  avg_latitude:d avg_longitude:d latest_crash:t earliest_crash:t""", f"""
  select crash_type, count(*) as crash_count, avg(risk_score) as avg_risk_score,
  avg(total_g_force) as avg_g_force, avg(speed_at_impact) as avg_impact_speed,
  count(*) filter (where emergency_recommended) as emergency_cases,
  count(*) filter (where rollover_detected) as rollover_cases,
  count(*) filter (where spinning_detected) as spinning_cases, avg({HOUR}) as avg_crash_hour,
  count(*) filter (where extract(dow from crash_timestamp) in (0, 6)) as weekend_crashes,
  avg(crash_latitude) as avg_latitude, avg(crash_longitude) as avg_longitude,
  max(crash_timestamp) as latest_crash, min(crash_timestamp) as earliest_crash from crash group by crash_type"""),
    "crash_hotspots": build("crash", _HOTSPOT_COLUMNS, _HOTSPOTS),
    "top_crash_hotspots": build("crash", _HOTSPOT_COLUMNS, f"""select * from ({_HOTSPOTS}) h
  order by crash_count desc, round(avg_risk_score, 6) desc nulls first, lat_zone nulls last,
  lng_zone nulls last limit 10"""),
    "speeding_analysis": build(
        "telemetry", "policy_id:n vin avg_speed:d max_speed:d speeding_violations:n severe_speeding:n total_records:n",
        f"""select policy_id, vin, avg(speed_mph) as avg_speed, max(speed_mph) as max_speed,
  count(*) filter (where speed_mph > 80) as speeding_violations,
  count(*) filter (where speed_mph > 90) as severe_speeding, count(*) as total_records
  from telemetry where date >= {DAY} - 7 group by policy_id, vin
  having count(*) filter (where speed_mph > 80) > 0
  order by speeding_violations desc, max_speed desc nulls first, policy_id nulls last, vin nulls last limit 15"""),
    "device_health": build(
        "telemetry", """policy_id:n vin avg_battery:d min_battery:d avg_signal:d low_battery_events:n
  poor_signal_events:n last_seen:t""", f"""select policy_id, vin, avg(device_battery_level) as avg_battery,
  min(device_battery_level) as min_battery, avg(device_signal_strength) as avg_signal,
  count(*) filter (where device_battery_level < 20) as low_battery_events,
  count(*) filter (where device_signal_strength < -80) as poor_signal_events, max(event_ts) as last_seen
  from telemetry where date >= {DAY} - 3 group by policy_id, vin
  order by low_battery_events desc, poor_signal_events desc, policy_id nulls last, vin nulls last limit 10"""),
    "recent_crashes": build("crash", "crash_type severity_level crash_count:n avg_risk_score:d emergency_cases:n", f"""
  select crash_type, severity_level, count(*) as crash_count, avg(risk_score) as avg_risk_score,
  count(*) filter (where emergency_recommended) as emergency_cases from crash
  where report_date >= {DAY} - 30 group by crash_type, severity_level"""),
    "customer_risk_profile": build(_RISK_NEEDS, _RISK_COLUMNS, _customer_risk(False)),
    "customer_risk_profile_fanout": build(_RISK_NEEDS, _RISK_COLUMNS, _customer_risk(True)),
    "top_customer_risk": build(_RISK_NEEDS, _RISK_COLUMNS, _customer_risk(True) + f" {_RISK_ORDER} limit 20"),
    "two_branch_fanout": build(_RISK_NEEDS, "customer_id:n high_gforce_events:n crash_count:n", _customer_risk(True)),
    "vehicle_safety": build("vehicles telemetry crash", _SAFETY_COLUMNS, _vehicle_safety(False)),
    "vehicle_safety_fanout": build("vehicles telemetry crash", _SAFETY_COLUMNS, _vehicle_safety(True)),
    "data_freshness": build("telemetry", "earliest_record:t latest_record:t unique_dates:n unique_policies:n", """
  select min(event_ts) as earliest_record, max(event_ts) as latest_record, count(distinct date) as unique_dates,
  count(distinct policy_id) as unique_policies from telemetry"""),
    "row_counts": build("telemetry crash", "table_name total_records:n", """
  select 'telemetry' as table_name, count(*) as total_records from telemetry
  union all select 'crash_reports', count(*) from crash"""),
    "performance_probe": build(
        "telemetry", "record_count:n time_range_start:t time_range_end:t unique_policies:n avg_g_force:d", """
  select count(*) as record_count, min(event_ts) as time_range_start, max(event_ts) as time_range_end,
  count(distinct policy_id) as unique_policies, avg(g_force) as avg_g_force from telemetry
  where date = DATE '2024-01-15' and g_force > 1.0"""),
    "accident_counts": build("accidents", "driver_id:n accident_count:n",
                             "select driver_id, count(*) as accident_count from accidents group by driver_id"),
    "recalculation_summary": build("weighted", """summary_type drivers_scored:n avg_score:x min_score:x max_score:x
  excellent_drivers:n good_drivers:n average_drivers:n poor_drivers:n high_risk_drivers:n""", """
  select 'RECALCULATION SUMMARY' as summary_type, count(*) as drivers_scored,
  round(cast(avg(safe_driver_score) as decimal(28,10)), 2) as avg_score, min(safe_driver_score) as min_score,
  max(safe_driver_score) as max_score, count(*) filter (where risk_category = 'EXCELLENT') as excellent_drivers,
  count(*) filter (where risk_category = 'GOOD') as good_drivers,
  count(*) filter (where risk_category = 'AVERAGE') as average_drivers,
  count(*) filter (where risk_category = 'POOR') as poor_drivers,
  count(*) filter (where risk_category = 'HIGH_RISK') as high_risk_drivers from weighted"""),
    "score_distribution": build(
        "current_scores", "total:n excellent:n good:n average:n poor:n high_risk:n line", f"""
  select *, 'Total: ' || total || ' | Excellent: ' || excellent || ' | Good: ' || good || ' | Average: ' || average
  || ' | Poor: ' || poor || ' | High-Risk: ' || high_risk as line
  from (select count(*) as total, {_BANDS} from current_scores) b"""),
    "refresh_statistics": build(
        "current_scores", "total_drivers:n avg_score:x excellent_count:n high_risk_count:n", """
  select count(*) as total_drivers, round(cast(avg(score) as decimal(28,10)), 2) as avg_score,
  count(*) filter (where score >= 90) as excellent_count,
  count(*) filter (where score < 60) as high_risk_count from current_scores"""),
    "high_risk_alert": build("current_scores", "drivers:n driver_ids", """
  select count(*) as drivers, string_agg(cast(driver_id as string), ',' order by driver_id) as driver_ids
  from current_scores where score < 60"""),
    # ordered operators and set operations
    "current_driver_scores": build("current_scores", "driver_id:n score:x calculation_date:t notes risk_category",
                                   "select * from current_scores"),
    "running_file_total": build("now_files", "date files:n running_total:n",
                                "select date, files, sum(files) over (order by date) as running_total from now_files"),
    "score_history": build(
        "history", "driver_id:n score_id calculation_date:t score:x previous_score:x change:x", """
  select *, score - previous_score as change from (select driver_id, score_id, calculation_date, score,
  lag(score) over (partition by driver_id order by calculation_date, score_id) as previous_score from history) h"""),
    "top_k": build("telemetry", "event_id:n policy_id:n vin event_ts:t speed_mph:d g_force:d",
                   "select * from telemetry order by event_ts desc nulls first, event_id limit 3"),
    "emergency_response_queue": build(
        "owned", """report_id policy_id vin crash_timestamp:t crash_type risk_score:d current_street
  crash_latitude:d crash_longitude:d customer_name phone_number vehicle_description response_priority:n
  minutes_since_crash:d""", f"""select *, first_name || ' ' || last_name as customer_name,
  cast(null as string) as phone_number, make || ' ' || model || ' (' || vehicle_year || ')' as vehicle_description,
  {RANK} as response_priority, (epoch_us({AS_OF}) - epoch_us(crash_timestamp)) / cast(60000000 as double)
  as minutes_since_crash from owned
  where crash_timestamp >= {AS_OF} - interval 24 hour and emergency_recommended"""),
    "data_completeness": build(
        "telemetry crash", """table_name total_records:n missing_policy_id:n missing_vin:n missing_gps:n
  missing_device_data:n unique_dates:n unique_policies:n""",
        _missing("vehicle_telemetry_data", "gps_latitude", "device_battery_level", "date", 7, "telemetry")
        + " union all "
        + _missing("crash_reports_data", "crash_latitude", "risk_score", "report_date", 30, "crash")),
    "partitions_added": build("now_files then_files", "date",
                              "select date from now_files except select date from then_files"),
    "partitions_removed": build("now_files then_files", "date",
                                "select date from then_files except select date from now_files"),
    # scores
    "score_weighted": build("weighted", _SCORE_COLUMNS, "select * from weighted"),
    "train_accident_model": build("training", "place:n millionths:n rows_used:n rows_skipped:n separable", f"""
  with recursive {_FIT}
  select i - 1 as place, round(beta[i] * 1000000) as millionths, (select count(*) from rows_) as rows_used,
    (select count(*) from training) - (select count(*) from rows_) as rows_skipped, false as separable
  from (select beta from fit order by step desc limit 1) b, range(1, 7) r(i)"""),
    "retrained_model": build("training", "driver_id:n accident_probability:d", f"""
  with recursive {_FIT}
  select driver_id, case when {" and ".join(f"{c} is not null" for c in _INPUTS)}
    then 1 / (1 + exp(-list_sum([beta[i] * ({_FIT_X})[i] for i in range(1, 7)]))) end as accident_probability
  from training, (select beta from fit order by step desc limit 1) b"""),
    "predict_accident_probability": build("predicted", "driver_id:n accident_probability:d", "select * from predicted"),
    "score_logistic": build("logistic", "accident_probability:d " + _SCORE_COLUMNS, "select * from logistic"),
    "score_composite": build("training", """speed_score:x smoothness_score:x harsh_driving_score:x
  distraction_score:x accident_score:x """ + _SCORE_COLUMNS, _COMPOSITE),
    "model_confusion": build("predicted", "label:n predicted:n drivers:n", """
  select has_accident as label, cast(accident_probability >= 0.5 as int) as predicted, count(*) as drivers
  from predicted where accident_probability is not null group by 1, 2"""),
    "model_evaluate": build("predicted", """true_positive:n false_positive:n true_negative:n false_negative:n
  accuracy:d area_under_roc:d""", """
  select *, (true_positive + true_negative) / cast(n as double) as accuracy,
    (rank_sum - p * (p + 1) / cast(2 as double)) / cast(p * (n - p) as double) as area_under_roc
  from (select count(*) as n, sum(has_accident) as p,
    count(*) filter (where has_accident = 1 and accident_probability >= 0.5) as true_positive,
    count(*) filter (where has_accident = 0 and accident_probability >= 0.5) as false_positive,
    count(*) filter (where has_accident = 0 and accident_probability < 0.5) as true_negative,
    count(*) filter (where has_accident = 1 and accident_probability < 0.5) as false_negative,
    sum(case when has_accident = 1 then mid_rank end) as rank_sum
    from (select *, (rank() over (order by accident_probability)
      + rank() over (order by accident_probability) + count(*) over (partition by accident_probability) - 1)
      / cast(2 as double) as mid_rank from predicted where accident_probability is not null) r) s"""),
    "alert_rules": build("weighted", "driver_id:n trigger severity message action", """
  select driver_id, 'safety_score < 40' as trigger, 'critical' as severity,
    'Driver ' || driver_id || ' flagged as HIGH_RISK' as message, 'immediate_intervention' as action
    from weighted where safe_driver_score < 40
  union all select driver_id, 'harsh_driving_events > 3', 'warning',
    'Aggressive driving detected for ' || driver_id, 'coaching_recommendation'
    from weighted where harsh_driving_events > 3
  union all select driver_id, 'phone_usage_rate > 30', 'warning', 'Excessive phone usage: ' || driver_id,
    'distraction_training' from weighted where phone_usage_rate > 30"""),
    # data quality
    "dq_orphans": build("customers policies vehicles drivers accidents claims current_scores",
                        "reference orphan_rows:n orphan_keys:n",
                        " union all ".join(_orphan(*r) for r in _REFERENCES)),
    "dq_orphan_rows": build(
        "accidents vehicles", "accident_id:n policy_id:n vehicle_id:n driver_id:n accident_timestamp:t created_at:t",
        "select * from accidents where vehicle_id not in (select vehicle_id from vehicles)"),
    "dq_duplicates": build("customers policies vehicles drivers accidents claims features history",
                           "table_name duplicate_keys:n surplus_rows:n",
                           " union all ".join(_duplicate(*k) for k in _KEYS.items())),
    "dq_duplicate_keys": build("telemetry", "vin minute:t copies:n", """
  select vin, date_trunc('minute', event_ts) as minute, count(*) as copies from telemetry
  group by 1, 2 having count(*) > 1"""),
    "dq_domain": build("customers policies vehicles drivers accidents claims history",
                       "table_name column_name rule broken_rows:n checked_rows:n", _DOMAIN),
    # sources, sinks and jobs
    "scan_telemetry_v2": build(
        "telemetry", """policy_id:n vehicle_id:n vin driver_id:n event_ts:t date speed_mph:d g_force:d
  device_battery_level:d device_signal_strength:n device_screen_on""", "select * from telemetry"),
    "scan_telemetry_v1": build(
        "telemetry", "policy_id:n vin driver_id:n event_ts:t date speed_mph:d device_battery_level:d",
        "select * from telemetry"),
    "scan_skip_corrupt": build("telemetry", "date events:n",
                               "select date, count(*) as events from telemetry group by date"),
    "flatten_json": build(
        "telemetry", """policy_id:n vin driver_id:n event_ts:t date speed_mph:d g_force:d gps_latitude:d
  accelerometer_z:d gyroscope_y:d device_battery_level:d device_signal_strength:n device_charging""",
        "select * from telemetry"),
    "bind_by_position": build("crash", "report_id crash_type crash_timestamp:t risk_score:d emergency_recommended",
                              "select * from crash"),
    "scan_crash_reports": build(
        "crash", """report_id policy_id vin crash_timestamp:t crash_type risk_score:d emergency_recommended
  severity_level report_date""", "select * from crash"),
    "reference_tables": build("customers policies vehicles drivers accidents claims", "table_name total_records:n",
                              " union all ".join(f"select '{t}' as table_name, count(*) as total_records from {t}"
                                                 for t in list(_KEYS)[:6])),
    "append_score_history": build("weighted", "score_id driver_id:n score:x calculation_date:t notes", f"""
  select concat(r.run, '-', driver_id) as score_id, driver_id, safe_driver_score as score,
  r.at as calculation_date, {WEIGHTED_NOTES} as notes from weighted,
  (select 'a' as run, {EARLIER} as at union all select 'b', {AS_OF}) r"""),
    "swap_table": build("features", _FEATURE_COLUMNS, "select * from features"),
    "compact_partition": build(
        "telemetry", "date status source_files:n written_files:n rows:n files_left:n events:n max_g_force:d", """
  select date, 'COMPACTED' as status, 6 as source_files, 1 as written_files, count(*) as rows, 1 as files_left,
  count(*) as events, max(g_force) as max_g_force from telemetry group by date"""),
    "reader_during_compaction": build("telemetry", "date files:n before_commit:n after_commit:n", """
  select date, count(distinct event_id % 6) + 1 as files, count(*) as before_commit, count(*) as after_commit
  from telemetry group by date"""),
    "compaction_row_check": build("telemetry", "date rows_before:n rows_after:n matches", """
  select date, count(*) as rows_before, count(*) filter (where date <> DATE '2024-01-15' or vin <> 'VIN7') as rows_after,
  count(*) filter (where date = DATE '2024-01-15' and vin = 'VIN7') = 0 as matches from telemetry group by date"""),
    "partition_inventory": build("telemetry", "date files:n has_bytes", """
  select date, count(distinct event_id % 6) as files, true as has_bytes from telemetry group by date
  union all select DATE '2024-02-05', 0, false"""),
    "incremental_inventory": build("telemetry", "date files:n relisted", """
  select date, count(distinct event_id % 6) + case when date = DATE '2024-01-15' then 1 else 0 end as files,
  date = DATE '2024-01-15' as relisted from telemetry where date <> DATE '2024-01-10' group by date"""),
    "compaction_preview": build(
        "telemetry", """date files:n total_bytes:n avg_bytes:n min_bytes:n max_bytes:n files_after:n reduction_percent:n
  grade query_speedup:n""", """
  select *, (files - files_after) * 100 // files as reduction_percent,
    case when files < 5 then 'below minimum' when files > 10 then 'excellent' when files > 5 then 'good'
      else 'eligible' end as grade, case when files > 1 then files // 2 end as query_speedup
  from (select date, count(*) as files, sum(bytes) as total_bytes, sum(bytes) // count(*) as avg_bytes,
      min(bytes) as min_bytes, max(bytes) as max_bytes,
      case when count(*) >= 5 then greatest(1, (sum(bytes) + 134217727) // 134217728) end as files_after
    from (select date, coalesce(policy_id, 0) % extract(day from date) as part, count(*) * 1000003 as bytes
      from telemetry group by 1, 2) f group by date) d"""),
    "cleanup_report": build("telemetry", _CLEANUP_COLUMNS, _cleanup(1024)),
    "cleanup_report_10kb": build("telemetry", _CLEANUP_COLUMNS, _cleanup(10240)),
    "folder_sizes": build("telemetry", "depth:n folder files:n bytes:n", " union all ".join(
        f"select {depth} as depth, {folder} as folder, count(*) as files, sum(event_id * 37 % 20000) as bytes"
        f" from telemetry group by 1, 2" for depth, folder in (
            (0, "''"), (1, "'date=' || date"), (2, "'date=' || date || '/hour=' || extract(hour from event_ts)")))),
    "scan_whole_files": build("telemetry", "date events:n damaged_files:n", """
  select date, count(*) filter (where not (date = DATE '2024-01-15' and event_id % 5 = 0)) as events,
  case when date = DATE '2024-01-15' then 1 else 0 end as damaged_files from telemetry group by date"""),
    "missing_paths": build("telemetry", "table_name total_records:n", """
  select 'there' as table_name, count(*) as total_records from telemetry
  union all select unnest(['telemetry', 'telemetry_v1', 'crash_reports', 'score_history']), 0"""),
    "scan_telemetry_v1_layouts": build("telemetry", "layout date driver_id_partition:n events:n", """
  select 'date and driver' as layout, date, coalesce(driver_id, 0) % 5 as driver_id_partition, count(*) as events
  from telemetry group by 1, 2, 3 union all select 'policy and month', date, null, count(*) from telemetry group by 1, 2"""),
    "scan_crash_by_position": build(
        "crash", "report_id policy_id crash_timestamp:t crash_type risk_score:d emergency_recommended severity_level",
        "select * from crash"),
    "kept_current_scores": build("weighted early_weighted", "driver_id:n score:x calculation_date:t risk_category", f"""
  select driver_id, score, calculation_date, {category("score")} as risk_category from (
    select *, row_number() over (partition by driver_id order by calculation_date desc) as rn from (
      select driver_id, safe_driver_score as score, {EARLIER} as calculation_date from early_weighted
      union all select driver_id, safe_driver_score, TIMESTAMP '2024-01-20 00:00:00' from weighted
      union all select driver_id, safe_driver_score, {AS_OF} from weighted where driver_id % 3 = 0) h
    where score is not null) r where rn = 1"""),
    "compact_range_dry_run": build("telemetry", "date status", """
  select distinct date, 'PLANNED' as status from telemetry
  where date between DATE '2024-01-13' and DATE '2024-01-15'"""),
    "inventory_snapshot": build("telemetry", "date diff:n change", """
  select distinct date, 0 as diff, 'kept' as change from telemetry
  union all select DATE '2024-02-01', 1, 'added'"""),
    "remove_tiny_files": build("telemetry", "date tiny:n", "select distinct date, 0 as tiny from telemetry"),
    "refresh_scores": build("weighted", "driver_id:n score:x risk_category notes", f"""
  select driver_id, safe_driver_score as score, risk_category, {WEIGHTED_NOTES} as notes from weighted"""),
    "refresh_after_late_file": build("weighted", "driver_id:n score:x risk_category notes", f"""
  select driver_id, safe_driver_score as score, risk_category, {WEIGHTED_NOTES} as notes from weighted"""),
    "refresh_after_removed_day": build("kept_features", _FEATURE_COLUMNS, "select * from kept_features"),
    "refresh_unchanged": build("weighted", "scores:n status",
                               "select count(safe_driver_score) as scores, 'NO_NEW_DATA' as status from weighted"),
    "refresh_retrained": build("weighted logistic", "by_model drivers:n", """
  select false as by_model, count(safe_driver_score) as drivers from weighted
  union all select true, count(safe_driver_score) from logistic"""),
    "skipped_files_report": build("telemetry", "rows:n files:n reason", """
  select count(*) as rows, 2 as files, 'no readable footer' as reason from telemetry"""),
    "stream_high_gforce_events": build("telemetry", "policy_id:n vin event_ts:t g_force:d severity_level", _HIGH_G),
    "stream_driver_features": build("features", _FEATURE_COLUMNS, "select * from features"),
    "stream_driver_scores": build("weighted", "driver_id:n score:x",
                                  "select driver_id, safe_driver_score as score from weighted"),
}
