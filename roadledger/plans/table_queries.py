"""Every operator as a query over the sample tables of a folder.

Results are made comparable across engines at the edge only: doubles rounded to four
digits, decimals as doubles, timestamps without zone, integers as BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    TimestampType,
)

from .. import functions as fx
from ..operators import (
    activity,
    crashes,
    enrich,
    inventory,
    mergeable,
    model,
    quality,
    risk,
    scoring,
    timespan,
    training,
)
from ..schemas import CRASH, TELEMETRY_FILE_V1
from ..session import materialized, shared_folder
from ..sources import (
    append_scores,
    crash_reports,
    manifest,
    load_core,
    overwrite_atomically,
    parse_telemetry,
    read_scores,
    telemetry,
    telemetry_v1,
    write_telemetry,
)
from ..sources import bind_by_position as source_bind
from ..sources.paths import Files, write_bytes, write_text
from ..sources.sample_tables import sample
from ..sources.telemetry import skipped_files
from ..streaming import merged_windows, stream_features, stream_high_gforce
from ..streaming.jobs import read_windows, stream_scores, telemetry_stream
from . import compaction
from .refresh import RefreshConfig, refresh, retrain_only
from .snapshot import refreshed_scores

AS_OF = "2024-01-31 00:00:00"
EARLIER = "2024-01-16 00:00:00"
PROBE_DAY = "2024-01-15"
# Files written for each date where a query compacts them.
FILES_A_DATE = 6

# Intercept and one coefficient per model feature, spread so that every band occurs.
KNOWN_COEFFICIENTS = [1.2, -0.04, 0.12, 0.02, 0.05, 0.01]

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """The result with engine-neutral column types."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DoubleType):
            column = F.round(fx.exact(column), 4).cast("double")
        elif isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


class Tables:
    """The mapped tables of one folder, and results that several queries start from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        """The mapped table ``name``, kept on this object once it was asked for."""
        df = sample(self.spark, self.folder, name)
        setattr(self, name, df)
        return df

    @property
    def owners(self):
        return self.vehicles, self.policies, self.customers

    def crash_enriched(self, **options) -> DataFrame:
        return enrich.crash_enriched(self.crash, *self.owners, **options)

    def features(self, before: str | None = None, **options) -> DataFrame:
        tel = self.telemetry
        if before:
            tel = tel.where(F.col("event_ts") < fx.instant(before))
        return training.driver_features(tel, before or AS_OF, **options)

    def training(self, before: str | None = None) -> DataFrame:
        return training.training_data(self.features(before), self.accidents)

    def predicted(self) -> DataFrame:
        return scoring.predict_accident_probability(self.training(), KNOWN_COEFFICIENTS)

    def history(self) -> DataFrame:
        """Weighted scores at two times and model scores one second after the second."""
        latest = materialized(self.training(), "training")
        runs = (
            ("a", scoring.score_weighted(self.training(EARLIER)), EARLIER, fx.weighted_notes()),
            ("b", scoring.score_weighted(latest), AS_OF, fx.weighted_notes()),
            ("c", scoring.score_logistic(latest, KNOWN_COEFFICIENTS),
             "2024-01-31 00:00:01", fx.logistic_notes()),
        )
        out = None
        for run, scored, at, notes in runs:
            rows = scored.where(F.col("safe_driver_score").isNotNull()).select(
                F.concat_ws("-", F.lit(run), F.col("driver_id")).alias("score_id"), "driver_id",
                F.col("safe_driver_score").alias("score"), fx.instant(at).alias("calculation_date"),
                notes.alias("notes"),
            )
            out = rows if out is None else out.unionAll(rows)
        return out

    def current(self) -> DataFrame:
        return scoring.current_scores(self.history())

    def inventories(self) -> tuple[DataFrame, DataFrame]:
        """Events per date standing in for files: all of them now, and the same moved by a week
        before, so that dates are added, removed and changed."""
        def counted(date) -> DataFrame:
            return self.telemetry.groupBy(date.alias("date")).agg(F.count(F.lit(1)).alias("files"))

        return counted(F.col("date")), counted(F.date_add("date", 7))

    def core(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name)
                for name in ("customers", "policies", "vehicles", "drivers", "accidents", "claims")}

    def write_files(self, *, many: bool = False) -> str:
        """Telemetry in the file layout, in a new shared folder."""
        base = f"{shared_folder(self.spark, 'telemetry')}/telemetry-data-v2"
        # At least six files a date, so that compaction has something to merge.
        parts = max(6, self.spark.sparkContext.defaultParallelism) if many else None
        self.write_to(base, self.telemetry.repartition(parts) if parts else self.telemetry)
        return base

    def write_parts(self) -> str:
        """The same with one file for each date and remainder of the event number."""
        base = f"{shared_folder(self.spark, 'telemetry')}/telemetry-data-v2"
        for k in range(FILES_A_DATE):
            self.write_to(base, self.telemetry.where(F.col("event_id") % FILES_A_DATE == k).coalesce(1))
        return base

    def listing(self) -> DataFrame:
        """A file for each event, its size from the event's number, in folders by date and hour."""
        name = F.format_string("telemetry-%s.parquet", F.col("event_id").cast("string"))
        return self.telemetry.select(
            F.format_string("/data/telemetry/date=%s/hour=%s/%s", F.col("date").cast("string"),
                            F.hour("event_ts").cast("string"), name).alias("path"),
            name.alias("name"), (F.col("event_id") * 37 % 20000).alias("bytes"), "date")

    def write_to(self, base: str, tel: DataFrame) -> None:
        write_telemetry(tel.withColumn(
            "event_time", (F.unix_micros("event_ts").cast("decimal(20,0)") / F.lit(1000000)).cast("string")), base)


def query(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register ``make`` under its name."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(make(Tables(spark, folder)))

    _QUERIES[make.__name__] = run
    return make


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- scalar derivations ---------------------------------------------------------------

@query
def calculated_g_force(t):
    return fx.with_forces(t.telemetry).select("event_id", "calculated_g_force")


@query
def lateral_g_force(t):
    return fx.with_forces(t.telemetry).select("event_id", "lateral_g_force")


@query
def vertical_g_force(t):
    return fx.with_forces(t.telemetry).select("event_id", "vertical_g_force")


@query
def gyro_magnitude(t):
    return fx.with_forces(t.telemetry).select("event_id", "gyro_magnitude")


@query
def severity_level(t):
    return t.telemetry.select("event_id", fx.severity_level(F.col("g_force")).alias("severity_level"))


@query
def response_priority_label(t):
    return t.crash.select("report_id", fx.response_priority().alias("response_priority"))


@query
def response_priority_rank(t):
    return t.crash.select("report_id", fx.response_priority(as_rank=True).alias("response_priority"))


@query
def crash_hour(t):
    return t.crash.select("report_id", F.hour("crash_timestamp").alias("crash_hour"))


@query
def crash_day_of_week(t):
    return t.crash.select(
        "report_id", fx.sunday_zero_weekday(F.col("crash_timestamp")).alias("crash_day_of_week"))


@query
def time_category(t):
    return t.crash.select("report_id", fx.time_category(F.col("crash_timestamp")).alias("time_category"))


@query
def time_category_wrapped(t):
    return t.crash.select(
        "report_id", fx.time_category(F.col("crash_timestamp"), wrapped=True).alias("time_category"))


@query
def risk_category(t):
    return scoring.score_weighted(t.training()).select("driver_id", "risk_category")


@query
def customer_name(t):
    return t.customers.select("customer_id", fx.customer_name().alias("customer_name"))


@query
def vehicle_description(t):
    return t.vehicles.select(
        "vehicle_id", fx.vehicle_description(year="year").alias("vehicle_description"),
        F.concat("make", F.lit(" "), "color").alias("make_and_color"))


@query
def score_notes(t):
    return scoring.score_weighted(t.training()).select("driver_id", fx.weighted_notes().alias("notes"))


@query
def score_notes_model(t):
    return scoring.score_logistic(t.training(), KNOWN_COEFFICIENTS).select(
        "driver_id", fx.logistic_notes().alias("notes"))


@query
def minutes_since_crash(t):
    return t.crash.select(
        "report_id", fx.minutes_since(F.col("crash_timestamp"), AS_OF).alias("minutes_since_crash"))


@query
def event_date(t):
    """The date through each text encoding of the event time."""
    micros = F.unix_micros("event_ts")
    seconds = (micros.cast("double") / 1e6).cast("string")
    millis = (micros.cast("double") / 1e3).cast("string")
    iso = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return t.telemetry.select(
        "event_id",
        *[fx.day_of(fx.event_ts(raw)).alias(name) for name, raw in
          (("from_seconds", seconds), ("from_millis", millis), ("from_iso", iso))])


@query
def geo_zone(t):
    return t.crash.select("report_id", fx.geo_zone(F.col("crash_latitude")).alias("lat_zone"),
                          fx.geo_zone(F.col("crash_longitude")).alias("lng_zone"))


@query
def policy_key_cast(t):
    mixed = F.when(F.col("policy_id").endswith("7"), F.concat(F.lit("P-"), "policy_id")) \
        .otherwise(F.col("policy_id"))
    return t.crash.select("report_id", fx.policy_key(mixed).alias("policy_key"))


# ---- filters --------------------------------------------------------------------------

@query
def high_gforce_events(t):
    return activity.high_gforce_events(t.telemetry)


@query
def recent_high_gforce_events(t):
    """The twenty hardest events of the last day."""
    last_day = timespan.recent_events(t.telemetry, AS_OF, hours=24)
    events = activity.high_gforce_events(last_day)
    return activity.top(
        events.select("policy_id", "vin", "event_ts", "current_street", "g_force", "speed_mph", "severity_level"),
        20, F.col("g_force").desc(), F.col("event_ts").desc(), F.col("vin").asc())


@query
def trailing_window(t):
    counts = [
        timespan.trailing(t.telemetry, "date", AS_OF, days=days)
        .agg(F.count(F.lit(1)).alias("events")).select(F.lit(days).alias("days"), "events")
        for days in (3, 7, 30, 90, 365)
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionAll(more)
    return out


@query
def not_null_driver(t):
    return t.telemetry.where(F.col("driver_id").isNotNull()).select("event_id", "driver_id")


@query
def post_agg_filter(t):
    return (
        t.telemetry.groupBy("vin")
        .agg(F.count(F.lit(1)).alias("events"),
             F.count_if(F.col("speed_mph") > 80).alias("fast"),
             F.count_distinct("policy_id").alias("policies"))
        .where((F.col("events") >= 2) & (F.col("fast") > 0) & (F.col("policies") > 0))
    )


@query
def status_filter(t):
    return t.policies.where(F.col("status") == "ACTIVE").select("policy_id", "customer_id", "policy_number")


@query
def partition_equality(t):
    return t.telemetry.where(
        (F.col("date") == F.lit(PROBE_DAY).cast("date")) & (F.col("g_force") > 1.0)
    ).select("event_id", "g_force")


@query
def partition_prefix(t):
    now, _ = t.inventories()
    return timespan.partition_prefix(now, "2024-01-1")


@query
def high_risk_drivers(t):
    return scoring.high_risk_drivers(t.current()).select("driver_id", "score", "risk_category")


# ---- joins ----------------------------------------------------------------------------

@query
def telemetry_enriched(t):
    return enrich.telemetry_enriched(t.telemetry, *t.owners).select(
        "event_id", "policy_id", "vin", "event_ts", "speed_mph", "g_force",
        "calculated_g_force", "lateral_g_force", "vertical_g_force", "gyro_magnitude",
        "make", "model", "vehicle_year", "color", "policy_number", "policy_status",
        "first_name", "last_name", "email")


@query
def crash_enriched(t):
    return t.crash_enriched().select(
        "report_id", "policy_id", "vin", "crash_timestamp", "crash_type", "risk_score",
        "make", "model", "vehicle_year", "policy_number", "policy_status", "first_name",
        "last_name", "email", "response_priority", "crash_hour", "crash_day_of_week", "time_category")


@query
def driver_training_data(t):
    return t.training()


@query
def customers_policies(t):
    return t.customers.join(t.policies, "customer_id").select(
        "customer_id", "policy_id", "policy_number", "status")


@query
def on_clause_restriction(t):
    """Every active policy with its telemetry of the last week, kept when it has none."""
    week = timespan.trailing(t.telemetry, "date", AS_OF, days=7).where(F.col("policy_id").isNotNull()) \
        .groupBy("policy_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        t.policies.where(F.col("status") == "ACTIVE").select("policy_id").join(week, "policy_id", "left")
        .select("policy_id", F.coalesce("n", F.lit(0)).alias("events"))
    )


@query
def new_data_gate(t):
    """New events and drivers since the features were refreshed in the middle of the month."""
    known = materialized(t.features(EARLIER), "features")
    return training.new_data(t.telemetry, known, materialized(training.zone_map(t.telemetry), "zones")).agg(
        F.count(F.lit(1)).alias("new_records"), F.count_distinct("driver_id").alias("drivers"))


@query
def drivers_with_new_data(t):
    return training.drivers_with_new_data(t.telemetry, materialized(t.features(EARLIER), "features"))


@query
def scalar_broadcast(t):
    """Probabilities from a coefficient table of one row."""
    table = model.coefficients_table(t.spark, KNOWN_COEFFICIENTS)
    return scoring.predict_accident_probability(t.training(), table).select(
        "driver_id", "accident_probability")


@query
def inventory_diff(t):
    return inventory.inventory_diff(*t.inventories())


# ---- aggregations ---------------------------------------------------------------------

@query
def driver_behavior_features(t):
    return t.features()


@query
def driver_behavior_metrics(t):
    return t.features(extended=True)


@query
def vehicle_behavior_summary(t):
    return activity.vehicle_behavior_summary(t.telemetry)


@query
def vehicle_behavior_summary_by_folder(t):
    """The summary by the folder's date, over files."""
    return activity.vehicle_behavior_summary(telemetry(t.spark, t.write_files()), by_folder=True)


@query
def top_vehicle_behavior(t):
    """The ten hardest vehicle days of the last week."""
    summary = activity.vehicle_behavior_summary(timespan.trailing(t.telemetry, "date", AS_OF, days=7))
    return activity.top(summary, 10, F.col("max_g_force").desc_nulls_first(), F.col("date").desc(),
                        F.col("policy_id").asc_nulls_last(), F.col("vin").asc())


@query
def crash_patterns(t):
    return crashes.crash_patterns(t.crash)


@query
def crash_hotspots(t):
    return crashes.crash_hotspots(t.crash)


@query
def top_crash_hotspots(t):
    return activity.top(
        crashes.crash_hotspots(t.crash), 10, F.col("crash_count").desc(),
        activity.sort_key("avg_risk_score").desc_nulls_first(),
        F.col("lat_zone").asc_nulls_last(), F.col("lng_zone").asc_nulls_last())


@query
def speeding_analysis(t):
    return activity.speeding_analysis(t.telemetry, AS_OF)


@query
def device_health(t):
    return activity.device_health(t.telemetry, AS_OF)


@query
def recent_crashes(t):
    return crashes.recent_crashes(t.crash, AS_OF)


@query
def customer_risk_profile(t):
    return risk.customer_risk_profile(t.customers, t.policies, t.telemetry, t.crash, AS_OF, k=None)


@query
def customer_risk_profile_fanout(t):
    return risk.customer_risk_profile(t.customers, t.policies, t.telemetry, t.crash, AS_OF, fanout=True, k=None)


@query
def top_customer_risk(t):
    return risk.customer_risk_profile(t.customers, t.policies, t.telemetry, t.crash, AS_OF, fanout=True)


@query
def two_branch_fanout(t):
    """Crash and telemetry counts of the join of both branches, without making its rows."""
    return risk.customer_risk_profile(
        t.customers, t.policies, t.telemetry, t.crash, AS_OF, fanout=True, k=None
    ).select("customer_id", "high_gforce_events", "crash_count")


@query
def vehicle_safety(t):
    return risk.vehicle_safety(t.vehicles, t.telemetry, t.crash, AS_OF)


@query
def vehicle_safety_fanout(t):
    return risk.vehicle_safety(t.vehicles, t.telemetry, t.crash, AS_OF, fanout=True)


@query
def data_freshness(t):
    return activity.data_freshness(t.telemetry)


@query
def row_counts(t):
    return activity.row_counts(telemetry=t.telemetry, crash_reports=t.crash)


@query
def performance_probe(t):
    return activity.performance_probe(t.telemetry, PROBE_DAY)


@query
def accident_counts(t):
    return training.accident_counts(t.accidents)


@query
def recalculation_summary(t):
    return scoring.recalculation_summary(scoring.score_weighted(t.training()))


@query
def score_distribution(t):
    return scoring.score_distribution(t.current())


@query
def refresh_statistics(t):
    return scoring.refresh_statistics(t.current())


@query
def high_risk_alert(t):
    return scoring.high_risk_alert(t.current())


# ---- ordered operators and set operations ---------------------------------------------

@query
def current_driver_scores(t):
    return t.current()


@query
def running_file_total(t):
    now, _ = t.inventories()
    return inventory.running_total(now)


@query
def score_history(t):
    return scoring.score_history(t.history())


@query
def top_k(t):
    """The three latest telemetry rows."""
    return activity.top(
        t.telemetry.select("event_id", "policy_id", "vin", "event_ts", "speed_mph", "g_force"), 3,
        F.col("event_ts").desc_nulls_first(), F.col("event_id").asc())


@query
def emergency_response_queue(t):
    return enrich.emergency_queue(t.crash_enriched(), AS_OF)


@query
def data_completeness(t):
    return activity.data_completeness(t.telemetry, t.crash, AS_OF)


@query
def partitions_added(t):
    return inventory.partitions_added(*t.inventories())


@query
def partitions_removed(t):
    return inventory.partitions_removed(*t.inventories())


# ---- scores and model -----------------------------------------------------------------

@query
def score_weighted(t):
    return scoring.score_weighted(t.training())


@query
def train_accident_model(t):
    """The fitted coefficients in millionths, by place."""
    fitted = model.train_accident_model(materialized(t.training(), "training"))
    return fitted.select(F.posexplode("coef").alias("place", "c"), "rows_used", "rows_skipped", "separable").select(
        "place", F.round(F.col("c") * 1e6).cast("bigint").alias("millionths"), "rows_used", "rows_skipped", "separable")


@query
def retrained_model(t):
    """Training again on the stored data of a refresh: the model predicts as the one before."""
    config, _ = _refreshed(t, _add(t), force=True)
    retrain_only(t.spark, config, max_iter=15)
    stored = t.spark.read.parquet(config.training)
    fitted = t.spark.read.parquet(config.model)
    return scoring.predict_accident_probability(stored, fitted).select("driver_id", "accident_probability")


@query
def predict_accident_probability(t):
    return t.predicted().select("driver_id", "accident_probability")


@query
def score_logistic(t):
    return scoring.score_logistic(t.training(), KNOWN_COEFFICIENTS)


@query
def score_composite(t):
    return scoring.score_composite(t.training())


@query
def model_confusion(t):
    return model.confusion(t.predicted())


@query
def model_evaluate(t):
    return model.model_evaluate(materialized(t.predicted(), "predicted"))


@query
def alert_rules(t):
    return scoring.alerts(scoring.score_weighted(t.training()))


# ---- data quality ---------------------------------------------------------------------

@query
def dq_orphans(t):
    scores = t.current().select("driver_id")
    return quality.orphan_report({**t.core(), "safe_driver_scores": scores})


@query
def dq_orphan_rows(t):
    return quality.orphans(t.accidents, t.vehicles, "vehicle_id", "vehicle_id")


@query
def dq_duplicates(t):
    return quality.duplicate_report(
        {**t.core(), "driver_behavior_features": t.features(), "safe_driver_scores": t.history()})


@query
def dq_duplicate_keys(t):
    """Vehicles reporting more than once in a minute, as a key that is not one."""
    return quality.duplicates(
        t.telemetry.withColumn("minute", F.date_trunc("minute", "event_ts")), ["vin", "minute"])


@query
def dq_domain(t):
    report = None
    for table, rules in quality.declared_rules().items():
        df = t.history() if table == "safe_driver_scores" else getattr(t, table)
        lines = quality.domain_report(df, rules).select(F.lit(table).alias("table_name"), "*")
        report = lines if report is None else report.unionAll(lines)
    return report


# ---- sources, sinks and jobs, over files written from the tables ----------------------

@query
def scan_telemetry_v2(t):
    tel = telemetry(t.spark, t.write_files())
    return tel.select("policy_id", "vehicle_id", "vin", "driver_id", "event_ts", "date", "speed_mph",
                      "g_force", "device_battery_level", "device_signal_strength", "device_screen_on")


@query
def scan_telemetry_v1(t):
    base = f"{shared_folder(t.spark, 'legacy')}/telemetry-data"
    stored = [c for c in TELEMETRY_FILE_V1.names if c in t.telemetry.columns or c == "event_time"]
    t.telemetry.withColumn("event_time", F.col("event_ts")).select(*stored, "date").write.partitionBy("date") \
        .option("mapreduce.output.basename", "telemetry").parquet(base)
    return telemetry_v1(t.spark, base).select("policy_id", "vin", "driver_id", "event_ts", "date", "speed_mph",
                                              "device_battery_level")


@query
def scan_skip_corrupt(t):
    """A scan that passes over a file that is not Parquet and one that is too small."""
    base = t.write_files()
    for name, size in (("bad", 4000), ("tiny", 10)):
        write_text(t.spark, f"{base}/date={PROBE_DAY}/telemetry-{name}.parquet", "x" * size)
    return telemetry(t.spark, base, skip_corrupt=True).groupBy("date").agg(F.count(F.lit(1)).alias("events"))


@query
def scan_whole_files(t):
    """A scan without the rows of a file that is damaged in the middle, and the files left out."""
    base = f"{shared_folder(t.spark, 'telemetry')}/telemetry-data-v2"
    apart = (F.col("date") == F.lit(PROBE_DAY).cast("date")) & (F.col("event_id") % 5 == 0)
    t.write_to(base, t.telemetry.where(apart).coalesce(1))
    bad = inventory.list_files(t.spark, base).first()["path"]
    t.write_to(base, t.telemetry.where(~apart))
    content = bytearray(t.spark.read.format("binaryFile").load(bad).first()["content"])
    content[len(content) // 3:len(content) // 2] = b"\xff" * (len(content) // 2 - len(content) // 3)
    write_bytes(t.spark, bad, content)
    damaged = materialized(skipped_files(t.spark, base), "damaged")
    rows = telemetry(t.spark, base, skip_corrupt=True, without=damaged).groupBy("date").agg(F.count(F.lit(1)).alias("events"))
    listed = damaged.where("reason = 'damaged'").groupBy("date").agg(F.count(F.lit(1)).alias("damaged_files"))
    return rows.join(listed, "date", "left").fillna(0, ["damaged_files"])


@query
def missing_paths(t):
    """Rows of each scan over a folder that is not there, beside one that is."""
    nowhere = f"{shared_folder(t.spark, 'nowhere')}/none"
    return activity.row_counts(
        telemetry=telemetry(t.spark, nowhere), telemetry_v1=telemetry_v1(t.spark, nowhere),
        crash_reports=crash_reports(t.spark, nowhere), score_history=read_scores(t.spark, nowhere),
        there=telemetry(t.spark, t.write_files()))


@query
def scan_telemetry_v1_layouts(t):
    """Legacy files by date and driver, and by policy, year, month and date."""
    stored = [c for c in TELEMETRY_FILE_V1.names if c in t.telemetry.columns or c == "event_time"]
    rows = t.telemetry.withColumn("event_time", F.col("event_ts")).select(*stored, "date")
    out = None
    for layout, values in (
        ("date and driver", {"date": F.col("date"), "driver_id_partition": F.coalesce("driver_id", F.lit(0)) % 5}),
        ("policy and month", {"policy": F.coalesce("policy_id", F.lit(0)) % 5, "year": F.year("date"),
                              "month": F.month("date"), "date": F.col("date")}),
    ):
        base = f"{shared_folder(t.spark, 'legacy')}/telemetry-data"
        rows.withColumns(values).write.partitionBy(*values).option("mapreduce.output.basename", "telemetry").parquet(base)
        found = telemetry_v1(t.spark, base).groupBy("date", "driver_id_partition").agg(
            F.count(F.lit(1)).alias("events")).select(F.lit(layout).alias("layout"), "*")
        out = found if out is None else out.unionAll(found)
    return out


@query
def scan_crash_by_position(t):
    """Crash files whose columns have other names, bound by position."""
    base = f"{shared_folder(t.spark, 'crashes')}/accident-reports"
    full = t.crash.select("severity_level", "report_date", *[
        (F.col(f.name) if f.name in t.crash.columns else F.lit(None)).cast(f.dataType).alias(f"c{i}")
        for i, f in enumerate(CRASH)])
    full.write.partitionBy("severity_level", "report_date").parquet(base)
    return crash_reports(t.spark, base, by_position=True).select(
        "report_id", "policy_id", "crash_timestamp", "crash_type", "risk_score", "emergency_recommended", "severity_level")


@query
def flatten_json(t):
    """Telemetry through nested JSON events and back."""
    def group(**fields: str):
        return F.struct(*[F.col(column).alias(name) for name, column in fields.items()])

    event = F.struct(
        "policy_id", "vin", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"),
        "speed_mph", "speed_limit_mph", "g_force",
        F.concat(F.lit("DRIVER-"), F.col("driver_id").cast("string")).alias("driver_id"),
        F.struct(
            group(latitude="gps_latitude", longitude="gps_longitude", accuracy="gps_accuracy").alias("gps"),
            group(x="accelerometer_x", y="accelerometer_y", z="accelerometer_z").alias("accelerometer"),
            group(pitch="gyroscope_x", roll="gyroscope_y", yaw="gyroscope_z").alias("gyroscope"),
            group(battery_level="device_battery_level", signal_strength="device_signal_strength",
                  screen_on="device_screen_on", charging="device_charging").alias("device"),
        ).alias("sensors"),
    )
    return parse_telemetry(t.telemetry.select(F.to_json(event).alias("value"))).select(
        "policy_id", "vin", "driver_id", "event_ts", "date", "speed_mph", "g_force", "gps_latitude",
        "accelerometer_z", "gyroscope_y", "device_battery_level", "device_signal_strength", "device_charging")


@query
def bind_by_position(t):
    """Crash columns given other names, bound back by their position."""
    names = t.crash.columns
    return source_bind(t.crash.toDF(*[f"c{i}" for i in range(len(names))]), t.crash.schema).select(
        "report_id", "crash_type", "crash_timestamp", "risk_score", "emergency_recommended")


@query
def scan_crash_reports(t):
    base = f"{shared_folder(t.spark, 'crashes')}/accident-reports"
    stored = t.crash.withColumnsRenamed({"crash_timestamp": "accident_timestamp", "crash_type": "accident_type"})
    stored.write.partitionBy("severity_level", "report_date").parquet(base)
    return crash_reports(t.spark, base).select(
        "report_id", "policy_id", "vin", "crash_timestamp", "crash_type", "risk_score",
        "emergency_recommended", "severity_level", "report_date")


@query
def reference_tables(t):
    folder = shared_folder(t.spark, "core")
    for name, df in t.core().items():
        df.write.parquet(f"{folder}/{name}")
    return activity.row_counts(**load_core(t.spark, folder))


@query
def append_score_history(t):
    """Two runs appended, the second one twice: the history holds each once."""
    path = f"{shared_folder(t.spark, 'history')}/safe_driver_scores"
    scored = materialized(scoring.score_weighted(t.training()), "scored")
    for run, at in (("a", EARLIER), ("b", AS_OF), ("b", AS_OF)):
        append_scores(scored, path, run, fx.instant(at), fx.weighted_notes())
    return read_scores(t.spark, path).select("score_id", "driver_id", "score", "calculation_date", "notes")


@query
def kept_current_scores(t):
    """The snapshot of current scores after each of three runs, the last one written twice."""
    home = shared_folder(t.spark, "history")
    path, saved = f"{home}/safe_driver_scores", f"{home}/current"
    early = materialized(scoring.score_weighted(t.training(EARLIER)), "scored")
    late = materialized(scoring.score_weighted(t.training()), "scored")
    done = None
    for run, scored, at in (("a", early, EARLIER), ("b", late, "2024-01-20 00:00:00"),
                            ("c", late.where("driver_id % 2 = 0"), AS_OF), ("c", late.where("driver_id % 3 = 0"), AS_OF)):
        append_scores(scored, path, run, fx.instant(at), fx.weighted_notes())
        done = refreshed_scores(t.spark, path, saved)
    return done.scores.select("driver_id", "score", "calculation_date", "risk_category")


@query
def swap_table(t):
    path = f"{shared_folder(t.spark, 'swap')}/features"
    overwrite_atomically(t.features(EARLIER), path)
    return overwrite_atomically(t.features(), path)


@query
def partition_inventory(t):
    """Files of each date folder, one of them empty."""
    base = t.write_parts()
    Files(t.spark, base).make_folder(f"{base}/date=2024-02-05")
    listing = inventory.refreshed_listing(t.spark, base, f"{shared_folder(t.spark, 'listing')}/saved")
    return listing.inventory.select("date", "files", (F.col("bytes") > 0).alias("has_bytes"))


@query
def incremental_inventory(t):
    """The kept listing after a day got a file and another one went: which dates were listed again."""
    base, saved = t.write_parts(), f"{shared_folder(t.spark, 'listing')}/saved"
    inventory.refreshed_listing(t.spark, base, saved, settle_ms=0)
    write_text(t.spark, f"{base}/date={PROBE_DAY}/telemetry-late.parquet", "x" * 2000)
    Files(t.spark, base).delete(f"{base}/date=2024-01-10", recursive=True)
    listing = inventory.refreshed_listing(t.spark, base, saved, settle_ms=0)
    again = F.col("date").cast("string").isin(listing.relisted)
    return listing.inventory.select("date", "files", again.alias("relisted"))


@query
def compaction_preview(t):
    """Dates with one file, two files and so on, as sizes of the sample's events."""
    part = F.col("user_id") % F.dayofmonth("date")
    sizes = t.telemetry.withColumn("user_id", F.coalesce("policy_id", F.lit(0))).groupBy("date", part.alias("part")).agg(
        (F.count(F.lit(1)) * 1000003).alias("bytes"))
    return inventory.compaction_preview(sizes)


@query
def cleanup_report(t):
    return inventory.cleanup_report(t.listing())


@query
def cleanup_report_10kb(t):
    return inventory.cleanup_report(t.listing(), threshold_bytes=10240)


@query
def folder_sizes(t):
    """Files and bytes of the base, each date and each hour in it."""
    return inventory.folder_sizes(t.listing(), "/data/telemetry", depth=2)


@query
def compact_partition(t):
    """What compacting every date did, with the files and rows found afterwards."""
    base = f"{shared_folder(t.spark, 'telemetry')}/telemetry-data-v2"
    t.write_to(base, t.telemetry.repartition(FILES_A_DATE))
    days = [str(r["date"]) for r in inventory.partition_inventory(
        inventory.list_files(t.spark, base)).select("date").collect()]
    done = compaction.compact(t.spark, base, days, dry_run=False)
    files = inventory.partition_inventory(inventory.list_files(t.spark, base)).select("date", F.col("files").alias("files_left"))
    rows = telemetry(t.spark, base).groupBy("date").agg(
        F.count(F.lit(1)).alias("events"), F.max("g_force").alias("max_g_force"))
    return done.select("date", "status", "source_files", "written_files", "rows").join(files, "date").join(rows, "date")


@query
def reader_during_compaction(t):
    """Events a scan counts after the merged files came, before and after they are made to count."""
    base = t.write_parts()
    days = [str(r["date"]) for r in inventory.partition_inventory(
        inventory.list_files(t.spark, base)).select("date").collect()]
    compaction.compact(t.spark, base, days, dry_run=False, keep_sources=True)
    files = Files(t.spark, base)

    def counted(name: str) -> DataFrame:
        return materialized(telemetry(t.spark, base).groupBy("date").agg(F.count(F.lit(1)).alias(name)), "counted")

    after = counted("after_commit")
    (run, _), = manifest.runs(t.spark, base).items()
    marker = f"{base}/{manifest.WORK}/{run}"
    files.rename(marker + manifest.COMMITTED, marker + manifest.PENDING)
    before = counted("before_commit")
    files.rename(marker + manifest.PENDING, marker + manifest.COMMITTED)
    stored = inventory.partition_inventory(inventory.list_files(t.spark, base)).select("date", "files")
    return stored.join(before, "date").join(after, "date")


@query
def compaction_row_check(t):
    """Rows and checksums by date before and after compaction, one date losing rows afterwards."""
    base = t.write_parts()
    before = materialized(telemetry(t.spark, base), "before")
    days = [str(r["date"]) for r in before.select("date").distinct().collect()]
    compaction.compact(t.spark, base, days, dry_run=False)
    after = telemetry(t.spark, base).where((F.col("date") != F.lit(PROBE_DAY).cast("date")) | (F.col("vin") != "VIN7"))
    return quality.rows_match(before, after, "date").select("date", "rows_before", "rows_after", "matches")


@query
def compact_range_dry_run(t):
    """What a compaction of a day and the two before it would touch."""
    base = t.write_files(many=True)
    return compaction.compact(t.spark, base, compaction.dates_back(PROBE_DAY, 2)).select("date", "status")


@query
def inventory_snapshot(t):
    """File counts by date against the saved snapshot, after one more day arrived."""
    folder = shared_folder(t.spark, "snapshot")
    base = t.write_files()
    compaction.snapshot(t.spark, base, f"{folder}/saved")
    write_text(t.spark, f"{base}/date=2024-02-01/telemetry-new.parquet", "x" * 2000)
    current, previous = compaction.snapshot(t.spark, base, f"{folder}/saved")
    return inventory.inventory_diff(current, previous).select("date", "diff", "change")


@query
def remove_tiny_files(t):
    """Dates that still hold tiny files after they were removed from two of them."""
    base = t.write_files()
    for day in ("2024-01-10", PROBE_DAY):
        write_text(t.spark, f"{base}/date={day}/telemetry-tiny.parquet", "x")
    compaction.remove_tiny(t.spark, base, dry_run=False)
    files = inventory.list_files(t.spark, base)
    return files.groupBy("date").agg(F.count_if(F.col("bytes") <= compaction.TINY_BYTES).alias("tiny"))


@query
def refresh_scores(t):
    """Current scores after a refresh over files."""
    home = shared_folder(t.spark, "refresh")
    for name, df in t.core().items():
        df.write.parquet(f"{home}/core/{name}")
    config = RefreshConfig(telemetry=t.write_files(), core=f"{home}/core", home=f"{home}/state")
    done = refresh(t.spark, config, datetime.fromisoformat(AS_OF))
    return done.current.select("driver_id", "score", "risk_category", "notes")


def _refreshed(t, *steps, **options):
    """Refresh after each step; the last result. A step changes the telemetry folder."""
    home, base = shared_folder(t.spark, "refresh"), f"{shared_folder(t.spark, 'telemetry')}/telemetry-data-v2"
    for name, df in t.core().items():
        df.write.parquet(f"{home}/core/{name}")
    config = RefreshConfig(telemetry=base, core=f"{home}/core", home=f"{home}/state")
    done = None
    for n, step in enumerate(steps):
        step(base)
        last = n + 1 == len(steps)
        done = refresh(t.spark, config, datetime.fromisoformat(AS_OF if last else EARLIER), **(options if last else {}))
    return config, done


def _add(t, condition: str = "true"):
    return lambda base: t.write_to(base, t.telemetry.where(condition))


def _scores_of(done):
    return done.current.select("driver_id", "score", "risk_category", "notes")


@query
def refresh_after_late_file(t):
    """Current scores after a second file came for every date, with older and newer events."""
    return _scores_of(_refreshed(t, _add(t, "event_type = 'view'"),
                                 _add(t, "event_type <> 'view' or event_type is null"))[1])


@query
def refresh_after_removed_day(t):
    """Features after one date folder was removed between two refreshes."""
    def remove(base):
        Files(t.spark, base).delete(f"{base}/date={PROBE_DAY}", recursive=True)

    config, _ = _refreshed(t, _add(t), remove)
    return t.spark.read.parquet(config.features)


@query
def refresh_unchanged(t):
    """Status and stored scores of a refresh without new files, rows without a driver present."""
    config, done = _refreshed(t, _add(t), lambda base: None)
    scores = read_scores(t.spark, config.history)
    return scores.agg(F.count(F.lit(1)).alias("scores")).withColumn("status", F.lit(done.status))


@query
def refresh_retrained(t):
    """Scores stored by a forced refresh: the weighted and the model's run."""
    config, done = _refreshed(t, _add(t), force=True)
    scores = read_scores(t.spark, config.history)
    return scores.groupBy(F.col("notes").contains("(Retrained)").alias("by_model")).agg(
        F.count_distinct("driver_id").alias("drivers"))


@query
def skipped_files_report(t):
    """Files that cannot be read, in a folder of readable ones."""
    base = t.write_files()
    for day in ("2024-01-10", PROBE_DAY):
        write_text(t.spark, f"{base}/date={day}/telemetry-bad.parquet", "x" * 3000)
    read = telemetry(t.spark, base, skip_corrupt=True).select(
        F.lit(1).alias("rows"), F.lit(0).alias("files"), F.lit(None).cast("string").alias("reason"))
    lost = skipped_files(t.spark, base).select(F.lit(0).alias("rows"), F.lit(1).alias("files"), "reason")
    return read.unionAll(lost).agg(F.sum("rows").alias("rows"), F.sum("files").alias("files"),
                                   F.max("reason").alias("reason"))


@query
def stream_high_gforce_events(t):
    """The alert stream run over everything there is."""
    out = shared_folder(t.spark, "alerts")
    stream_high_gforce(
        telemetry_stream(t.spark, t.write_files()), f"{out}/sink", f"{out}/checkpoint", every=None
    ).awaitTermination()
    return t.spark.read.parquet(f"{out}/sink").select("policy_id", "vin", "event_ts", "g_force", "severity_level")


def _windows(t: Tables, out: str) -> str:
    stream_features(
        telemetry_stream(t.spark, t.write_files(), max_files=4), f"{out}/windows", f"{out}/checkpoint", every=None
    ).awaitTermination()
    return f"{out}/windows"


@query
def stream_driver_features(t):
    """Features combined from streamed windows; equal to the batch features."""
    windows = _windows(t, shared_folder(t.spark, "features"))
    return mergeable.combine_features(merged_windows(read_windows(t.spark, windows)), AS_OF)


@query
def stream_driver_scores(t):
    """Scores appended by the rescoring stream."""
    out = shared_folder(t.spark, "scores")
    windows = _windows(t, out)
    accidents = overwrite_atomically(t.accidents, f"{out}/accidents")
    stream_scores(t.spark, windows, accidents, f"{out}/history", f"{out}/rescoring", every=None) \
        .awaitTermination()
    return read_scores(t.spark, f"{out}/history").select("driver_id", "score")
