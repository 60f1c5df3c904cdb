"""Registered queries: one per operator and model, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perkline.catalogue import inputs as I
from perkline.defaults import CONTRACT_TYPES
from perkline.functions import (
    city_from_address, clean_numeric_key, cohort, full_name, is_valid_activity, nullif_trim, reference_year,
    render, row_hash, stable_id, strict_cast,
)
from perkline.functions.dates import duration_seconds
from perkline.functions.dates import excel_serial_to_date as excel_serial
from perkline.operators import calendar as C
from perkline.operators import joins as J
from perkline.operators import ranking
from perkline.operators.activity import daily_activity
from perkline.operators.latest import first_per_key
from perkline.plans import bi, bronze, gold, monitoring, quality, refresh, rollups, silver, timeline
from perkline.plans import rules as R
from perkline.session import scratch_path
from perkline.sources import jsonl, landing, stored, tables
from perkline.streaming import events as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Neutral result types for comparison across engines: bigint, double and text dates."""
    def neutral(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.alias(field.name)

    return df.select(*[neutral(f) for f in df.schema.fields])


def query(name_or_fn: str | Callable[["Domain"], DataFrame]):
    """Register ``fn(domain)`` under the given name, or under its own."""
    def register(fn, name):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(Domain(spark, sf_dir)))

        QUERIES[name] = run
        return fn

    if isinstance(name_or_fn, str):
        return lambda fn: register(fn, name_or_fn)
    return register(name_or_fn, name_or_fn.__name__)


class Domain:
    """Lazily built models over one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return I.table(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @cached_property
    def employees_raw(self):
        return I.employees_raw(self.spark, self.sf_dir)

    @cached_property
    def declarations_raw(self):
        return I.declarations_raw(self.spark, self.sf_dir)

    @cached_property
    def activities_raw(self):
        return I.activities_raw(self.spark, self.sf_dir)

    @cached_property
    def documents(self):
        return I.rule_documents(self.spark, self.sf_dir)

    @cached_property
    def rules_raw(self):
        return I.rules_raw(self.spark, self.sf_dir)

    @cached_property
    def parameters_raw(self):
        return I.parameters_raw(self.spark, self.sf_dir)

    @cached_property
    def validity(self):
        return I.validity(self.spark, self.sf_dir)

    @cached_property
    def employees_bronze(self):
        return bronze.brz_rh_employees(self.employees_raw)

    @cached_property
    def declarations_bronze(self):
        return bronze.brz_sport_declarations(self.declarations_raw)

    @cached_property
    def activities_bronze(self):
        return bronze.brz_sport_activities(self.activities_raw)

    @cached_property
    def employees(self):
        return silver.sil_employees(self.employees_bronze, self.validity)

    @cached_property
    def declarations(self):
        return silver.sil_sport_declarations(self.declarations_bronze)

    @cached_property
    def activities(self):
        return silver.sil_sport_activities(self.activities_bronze)

    @cached_property
    def valid_activities(self):
        return self.activities.filter("is_valid_activity")

    def yearly(self, window_days: int = 365):
        return silver.sil_employee_activity_yearly(self.activities, I.AS_OF, window_days)

    def joined(self, window_days: int = 365):
        return silver.sil_employee_activity_joined(self.employees, self.declarations, self.yearly(window_days))

    def bonus(self):
        return gold.gold_eligible_sport_bonus(self.joined(), self.validity, I.AS_OF)

    def wellbeing(self, window_days: int = 365):
        return gold.gold_eligible_wellbeing_days(self.joined(window_days), self.validity, I.AS_OF)

    def status(self):
        return gold.employee_status(self.joined(), self.validity, I.AS_OF)

    def timeline(self, window_days: int = 365):
        return timeline.gold_employee_benefit_timeline(self.employees, self.activities, self.validity, window_days)

    def anomalies(self):
        return gold.gold_quality_anomalies(self.employees, self.activities, self.validity, I.AS_OF, I.AS_OF_TS)

    @cached_property
    def stored(self):
        """Silver tables written once, for models that read them several times."""
        silver_tables = {"sil_employees": self.employees, "sil_sport_activities": self.activities}
        return tables.materialize_layer(silver_tables, "silver", self.scratch("layers"))

    @cached_property
    def stored_joined(self):
        """Employees with their declarations and yearly activity, written once."""
        return tables.materialize_layer(
            {"sil_employee_activity_joined": self.joined()}, "silver", self.scratch("layers"))["sil_employee_activity_joined"]

    def stored_status(self):
        joined = silver.sil_employee_activity_joined(
            self.stored["sil_employees"], self.declarations,
            silver.sil_employee_activity_yearly(self.stored["sil_sport_activities"], I.AS_OF))
        return gold.employee_status(joined, self.validity, I.AS_OF)

    def stored_timeline(self, window_days: int = 365):
        return timeline.gold_employee_benefit_timeline(
            self.stored["sil_employees"], self.stored["sil_sport_activities"], self.validity, window_days)

    def daily_counts(self, window_days: int = 365):
        """Counts of the timeline per date, from its runs."""
        return rollups.daily_counts(*timeline.benefit_runs(self.employees, self.activities, self.validity, window_days))

    def volumes(self, window_days: int = 365):
        activities = self.stored["sil_sport_activities"]
        counts = rollups.daily_counts(
            *timeline.benefit_runs(self.stored["sil_employees"], activities, self.validity, window_days))
        return monitoring.monitoring_activity_volumes_daily(
            monitoring.raw_volumes(self.activities_bronze), monitoring.silver_volumes(activities),
            rollups.timeline_volumes(counts))

    def long_timeline(self):
        """The timeline of more than six years of activity."""
        return timeline.gold_employee_benefit_timeline(
            self.employees, I.long_activities(self.spark, self.sf_dir), self.validity, 365)

    def event_volumes(self):
        """Daily event counts on the same dates, without building the timeline."""
        activities = self.stored["sil_sport_activities"]
        return monitoring.monitoring_activity_volumes_daily(
            monitoring.raw_volumes(self.activities_bronze), monitoring.silver_volumes(activities),
            timeline.timeline_dates(activities, self.validity))

    @cached_property
    def runs(self):
        return I.runs(self.spark, self.sf_dir)

    @cached_property
    def tasks(self):
        return I.tasks(self.spark, self.sf_dir)

    def run_log(self):
        return monitoring.monitoring_runs(self.runs, self.tasks, I.RUNS_AS_OF_TS)

    def counts(self):
        return monitoring.monitoring_table_row_counts({
            ("raw", "rh_employees_raw"): self.employees_raw,
            ("raw", "sport_declarations_raw"): self.declarations_raw,
            ("raw", "sport_activities_stream_raw"): self.activities_raw,
            ("silver", "sil_employees"): self.stored["sil_employees"],
            ("silver", "sil_sport_activities"): self.stored["sil_sport_activities"],
            ("gold", "gold_kpi_employee_status"): self.stored_status(),
            ("gold", "gold_employee_benefit_timeline"): self.stored_timeline(),
            ("gold", "gold_employee_map"): gold.gold_employee_map(self.stored["sil_employees"], self.stored_status()),
        })

    def grid(self, columns: list[str], window_days: int):
        daily = timeline.stage_daily(self.activities)
        return timeline.activity_grid(self.employees.select(*columns), daily, C.distinct_dates(daily), window_days)

    def write_messages(self, rounds: int = 1, altered: bool = False) -> str:
        """Topic messages as files; every further round delivers the same messages again.

        ``altered`` gives later rounds later offsets and another payload, so that it shows which copy won.
        """
        path = self.scratch("messages")
        for again in range(rounds):
            batch = I.messages(self.spark, self.sf_dir)
            if altered and again:
                batch = batch.withColumns({
                    "offset": F.col("offset") + again * 10_000_000,
                    "value": F.regexp_replace("value", r"\}\s*$", f',"round":{again}}}')})
            batch.write.mode("append").json(path)
        return path

    def ingest(self, on_batch=None) -> str:
        """Run the ingestion stream over the messages delivered twice; returns the sink folder."""
        root = self.scratch("landed")
        source = S.stream_source(self.spark, path=self.write_messages(rounds=2), max_files=8)
        S.drain(S.start_ingest(source, root, self.scratch("progress"), process_date=I.INGEST_DATE, on_batch=on_batch))
        return root


# --- sources, landing, sinks -----------------------------------------------------------------

@query
def land_table(d):
    k = F.col("c_custkey")
    source = d.table("customer").select(
        F.concat(k, F.lit(".0")).alias("ID salarié"), F.col("c_name").alias("Nom"), k.alias("Date de naissance"),
        F.col("c_mktsegment").alias("BU"), (k % 400 + 20000).alias("Salaire brut"))
    return landing.land_table(source, landing.EMPLOYEE_HEADERS, "employees.csv", "2024-01-05", "run-1", "2024-01-05 06:00:00")


@query("clean_numeric_key")
def clean_numeric_key_table(d):
    k = F.col("o_orderkey")
    raw = F.when(k % 2 == 0, F.concat(k, F.lit(".0"))).otherwise(F.concat(k, F.lit(".05")))
    return d.table("orders").select("o_orderkey", clean_numeric_key(raw).alias("employee_id"))


@query("row_hash")
def row_hash_table(d):
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    blank = F.when(F.col("c_custkey") % 5 != 0, F.col("c_name"))
    return d.table("customer").withColumn("c_name", blank).select(
        "c_custkey", row_hash([F.col(c) for c in columns]).alias("row_hash"))


@query
def tag_process_date(d):
    return landing.tag_process_date(d.table("orders").select("o_orderkey", "o_orderstatus"), I.AS_OF)


def _corrected_batch(d):
    """The second employee batch delivered again with a corrected salary and fewer rows."""
    return d.employees_raw.filter((F.col("ingestion_id") == "hr-2") & (F.col("employee_id").cast("bigint") % 2 == 0)) \
        .withColumn("gross_salary_raw", F.lit("31000.00"))


@query
def replace_batch(d):
    replaced = tables.replace_batch(d.employees_raw, _corrected_batch(d))
    return replaced.select("ingestion_id", "process_date", "source_file", "employee_id", "gross_salary_raw")


@query
def replace_batch_files(d):
    path = d.scratch("batches")
    tables.write_batches(d.employees_raw, path)
    tables.write_batches(_corrected_batch(d), path)
    return d.spark.read.parquet(path).groupBy("source_file", "process_date", "ingestion_id").agg(
        F.count("*").alias("rows"), F.sum(F.expr("nullif(gross_salary_raw, '')").cast("decimal(12,2)")).alias("salaries"))


@query
def evolve_schema(d):
    old = d.table("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    new = d.table("customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    return tables.evolve_schema(old, new)


def _rule_updates(d):
    """Every second version delivered twice with a later load time; the last delivery counts."""
    deliveries = F.explode(F.array(F.lit(1), F.lit(2)))
    half = d.rules_raw.filter(F.substring("rule_version", 2, 20).cast("bigint") % 2 == 0)
    return half.withColumn("delivery", deliveries).withColumns({
        "wellbeing_days": F.col("wellbeing_days") + F.col("delivery") * 10,
        "loaded_at": F.timestamp_add("DAY", F.col("delivery"), F.col("loaded_at")),
    }).drop("delivery")


@query
def upsert_by_key(d):
    return tables.upsert_by_key(d.rules_raw, _rule_updates(d), ["rule_version"], ["loaded_at"]).select(
        "rule_version", "effective_from", "wellbeing_days", "loaded_at")


@query
def replace_by_key(d):
    fewer = d.parameters_raw.filter(
        (F.substring("rule_version", 2, 20).cast("bigint") % 5 == 0) & (F.col("rule_path") != "limits.ratio"))
    return tables.replace_by_key(d.parameters_raw, fewer, ["rule_version"]).select(
        "rule_version", "rule_path", "rule_value_json", "value_type")


@query
def insert_if_absent(d):
    held = d.activities_raw.filter(F.col("event_id").cast("bigint") % 2 == 0)
    accepted = tables.insert_if_absent(held, d.activities_raw, "event_id", [F.col("offset_id").asc()])
    return accepted.select("event_id", "offset_id", "process_date")


@query
def upsert_stored(d):
    """The upsert into a table on storage, in two batches."""
    path, updates = d.scratch("keyed"), _rule_updates(d)
    stored.create_keyed(d.rules_raw, path, ["rule_version"])
    late = F.col("loaded_at") > F.lit("2024-01-03").cast("timestamp")
    for batch in (updates.filter(~late), updates):
        stored.upsert_stored(path, batch, ["loaded_at"])
    return stored.read_keyed(d.spark, path).select("rule_version", "effective_from", "wellbeing_days", "loaded_at")


@query
def replace_stored(d):
    path = d.scratch("keyed")
    stored.create_keyed(d.parameters_raw, path, ["rule_version"])
    stored.replace_stored(path, d.parameters_raw.filter(
        (F.substring("rule_version", 2, 20).cast("bigint") % 5 == 0) & (F.col("rule_path") != "limits.ratio")))
    return stored.read_keyed(d.spark, path).select("rule_version", "rule_path", "rule_value_json", "value_type")


@query
def insert_stored(d):
    """What two deliveries of the same events add to a table that holds every second one."""
    path, events = d.scratch("keyed"), d.activities_raw.select("event_id", "offset_id", "process_date")
    stored.create_keyed(events.filter(F.col("event_id").cast("bigint") % 2 == 0).withColumn("held", F.lit(True)), path, ["event_id"])
    for _ in range(2):
        stored.insert_stored(path, events, [F.col("offset_id").asc()])
    return stored.read_keyed(d.spark, path).filter("held is null").drop("held")


@query
def evolve_stored(d):
    """Batches of an old and a new layout in one folder, read back as one table."""
    path = d.scratch("evolving")
    batch = [F.lit("f.csv").alias("source_file"), F.lit("2024-01-05").cast("date").alias("process_date")]
    old = d.table("supplier").select(
        F.col("s_suppkey").cast("int").alias("key"), F.col("s_name").alias("name"), *batch, F.lit("old").alias("ingestion_id"))
    new = d.table("customer").select(
        F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), *batch, F.lit("new").alias("ingestion_id"))
    for rows in (old, new):
        stored.write_evolving(rows, path, ["ingestion_id"])
    return stored.read_stored(d.spark, path).select("key", "name", "segment", "ingestion_id")


def _write_event_lines(d) -> str:
    path = d.scratch("jsonl")
    jsonl.write_jsonl(d.activities_bronze.select(
        "activity_id", "employee_id", "activity_type", "activity_date", "distance_km", "duration_min",
        "calories_burned", "source_system", "event_ts", "process_date"), path)
    return path


@query
def read_jsonl(d):
    return jsonl.read_jsonl(d.spark, _write_event_lines(d))


@query
def write_jsonl(d):
    """Lines written per processing date, as text."""
    lines = d.spark.read.text(_write_event_lines(d))
    return lines.groupBy("process_date").agg(
        F.count("*").alias("lines"), F.count(F.get_json_object("value", "$.employee_id")).alias("known_employees"))


@query
def publish_rows(d):
    rows = d.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return jsonl.publish_rows(rows, "o_custkey")


@query
def backfill_dates(d):
    first, last = "2024-01-03", "2024-02-03"
    days = landing.backfill_dates(d.spark, first, last)
    landed = landing.backfill_slice(d.activities_raw, first, last).groupBy("process_date").agg(F.count("*").alias("events"))
    return days.join(landed, "process_date", "left").select("process_date", F.coalesce("events", F.lit(0)).alias("events"))


@query
def materialize_layer(d):
    stored = tables.materialize_layer({"sil_sport_activities": d.activities}, "silver", d.scratch("layers"))
    return stored["sil_sport_activities"].groupBy("activity_type", "is_valid_activity").agg(
        F.count("*").alias("activities"), F.sum("distance_km").alias("distance_km"))


@query
def assign_weighted_cohort(d):
    return d.table("customer").select("c_custkey", cohort(F.col("c_custkey").cast("string")).alias("cohort"))


# --- enrichment steps ------------------------------------------------------------------------

@query
def bronze_trim(d):
    return bronze.trim_columns(d.employees_raw, bronze.EMPLOYEE_TEXT).select(
        "employee_id", "ingestion_id", *bronze.EMPLOYEE_TEXT)


@query
def json_extract_typed(d):
    return d.activities_bronze.select(
        "activity_id", "offset_id", "activity_date", "distance_km", "duration_min", "payload_process_date")


@query
def json_array_explode_in(d):
    """Employees against the exploded mode lists of all versions: how many versions reward their mode."""
    exploded = d.rules_raw.select(F.explode(F.from_json("sportive_transport_modes", "array<string>")).alias("transport_mode"))
    # modes are few and one may cover most employees: broadcast after counting them
    rewarded = exploded.groupBy("transport_mode").agg(F.count("*").alias("rule_count"))
    return d.employees.join(rewarded, "transport_mode", "left").select(
        "employee_id", "transport_mode", F.coalesce("rule_count", F.lit(0)).alias("rule_count"))


@query
def json_array_contains(d):
    return d.rules_raw.select(
        "rule_version",
        *[silver.mode_is_sportive(F.lit(m), silver.parsed_modes(F.col("sportive_transport_modes"))).alias(n)
          for m, n in (("velo", "has_velo"), ("vélo", "has_accented"), ("trottinette", "has_scooter"))])


@query
def normalize_text_mode(d):
    return silver.normalize_modes(d.employees_raw).select("employee_id", "ingestion_id", "transport_mode")


@query
def normalize_mode_lookup(d):
    return silver.normalize_modes(d.employees_raw, vocabulary="lookup").select("employee_id", "ingestion_id", "transport_mode")


@query
def excel_serial_to_date(d):
    return silver.parse_serial_dates(
        d.employees_raw, {"hire_date_raw": "hire_date", "birth_date_raw": "birth_date"}
    ).select("employee_id", "ingestion_id", "hire_date", "birth_date")


@query
def strict_cast_nullif(d):
    return d.employees_raw.select(
        "employee_id", "ingestion_id",
        strict_cast(F.col("gross_salary_raw"), "decimal(12,2)").alias("gross_salary"),
        strict_cast(F.col("cp_days_raw"), "int").alias("cp_days"),
        strict_cast(F.col("gross_salary_raw"), "int", strict=False).alias("lenient_salary"))


@query
def lenient_cast_rejects(d):
    """Customers' balances and keys as raw text, some of it unreadable."""
    raw = d.table("customer").selectExpr(
        "string(c_custkey) employee_id",
        "case when c_custkey % 9 = 0 then concat('x', c_custkey) when c_custkey % 9 = 1 then '' else string(cast(c_acctbal as decimal(12,2))) end gross_salary_raw",
        "case when c_custkey % 7 = 0 then 'soon' when c_custkey % 7 = 1 then null else string(c_custkey % 30) end cp_days_raw",
        "case when c_custkey % 11 = 0 then '2020-02-31' else '44000' end hire_date_raw")
    return silver.cast_rejects(raw, ["employee_id"], {
        "gross_salary_raw": (strict_cast(F.col("gross_salary_raw"), "decimal(12,2)", False), "decimal(12,2)"),
        "cp_days_raw": (strict_cast(F.col("cp_days_raw"), "int", False), "int"),
        "hire_date_raw": (excel_serial(F.col("hire_date_raw"), False), "date")})


@query("full_name")
def full_names(d):
    return d.employees_raw.select(
        "employee_id", "ingestion_id", full_name(F.col("first_name"), F.trim("last_name")).alias("full_name"))


@query("nullif_trim")
def nullif_trim_table(d):
    return d.declarations_raw.select(
        "employee_id", "ingestion_id", nullif_trim(F.col("declared_sport")).alias("declared_sport"))


@query
def pseudo_geocode(d):
    return silver.geocode_addresses(d.employees_raw).select("employee_id", "ingestion_id", "home_lat", "home_lon")


@query
def pseudo_geocode_sha(d):
    return silver.geocode_addresses(d.employees_raw, method="sha256").select(
        "employee_id", "ingestion_id", "home_lat", "home_lon")


def _distances(d, form):
    located = d.employees_raw.transform(silver.geocode_addresses).transform(silver.add_office)
    return silver.add_distance(located, form).select("employee_id", "ingestion_id", "distance_km_to_office")


@query("haversine_km")
def haversine_asin(d):
    return _distances(d, "asin")


@query("haversine_km_atan2")
def haversine_atan2(d):
    return _distances(d, "atan2")


@query("city_from_address")
def city_from_address_table(d):
    return d.employees_raw.select(
        "employee_id", "ingestion_id", city_from_address(F.col("home_address")).alias("home_city"))


@query
def render_message(d):
    return d.activities_bronze.select("activity_id", "offset_id", render([
        "activity ", F.lower("activity_type"), " of ", F.col("employee_id"), " on ", F.col("activity_date"),
        ": ", F.col("distance_km"), " km"]).alias("message_text"))


@query
def anomaly_id(d):
    return d.employees_raw.select(
        "employee_id", "ingestion_id", stable_id(F.col("employee_id"), "distance").alias("anomaly_id"))


@query("duration_seconds")
def duration_seconds_table(d):
    return d.runs.select("dag_id", "run_id", duration_seconds(
        F.col("start_date"), F.col("end_date"), I.RUNS_AS_OF_TS).alias("duration_seconds"))


@query("reference_year")
def reference_year_table(d):
    return d.activities_bronze.groupBy(reference_year(F.col("process_date")).alias("reference_year")).agg(
        F.count("*").alias("events"))


@query
def validity_flag(d):
    flag = is_valid_activity(*[F.col(c) for c in ("employee_id", "activity_date", "distance_km", "duration_min")])
    return d.activities_bronze.select("activity_id", "offset_id", flag.alias("is_valid_activity"))


@query
def office_coordinates(d):
    return silver.add_office(d.employees_raw.select("employee_id", "ingestion_id"))


# --- rules -----------------------------------------------------------------------------------

@query
def flatten_rules(d):
    return d.parameters_raw.drop("loaded_at")


@query
def flatten_event_props(d):
    return R.flatten_rules(d.table("events"), ["event_id"], "props")


@query
def normalize_rules_payload(d):
    return d.documents.select("rule_version", R.normalize_rules_payload(F.col("document")).alias("rules_payload"))


def _partial_documents(d):
    """Documents of which every seventh has lost a required key."""
    k = F.substring("rule_version", 2, 20).cast("bigint")
    cut = F.regexp_replace("document", '"wellbeing_days":[0-9]+,', "")
    return d.documents.withColumn("document", F.when(k % 7 == 3, cut).otherwise(F.col("document")))


@query
def require_rule_keys(d):
    _, rejects = R.split_rule_documents(_partial_documents(d))
    return rejects.select("rule_version", F.array_join("missing_keys", ",").alias("missing_keys"))


@query
def rules_wide(d):
    return d.rules_raw


@query
def rules_history(d):
    return R.rules_history(d.rules_raw).drop("rules_payload")


@query
def rules_validity(d):
    return d.validity.drop("rules_payload")


@query
def rules_current(d):
    return R.rules_current(d.validity)


@query
def rule_parameters_history(d):
    return R.rule_parameters_history(d.parameters_raw, d.validity)


@query
def rule_parameters_current(d):
    return R.rule_parameters_current(R.rule_parameters_history(d.parameters_raw, d.validity))


@query
def rules_active_at(d):
    return R.rules_active_at(d.validity, "2024-01-10").select("rule_version", "effective_from", "effective_to_exclusive")


# --- joins -----------------------------------------------------------------------------------

@query
def join_left_equi(d):
    return d.employees.join(d.declarations, "employee_id", "left").select("employee_id", "business_unit", "declared_sport")


@query
def join_left_status(d):
    joined = d.stored_joined
    return gold.gold_kpi_employee_status(
        joined, gold.gold_eligible_sport_bonus(joined, d.validity, I.AS_OF),
        gold.gold_eligible_wellbeing_days(joined, d.validity, I.AS_OF))


@query
def join_left_composite(d):
    counts = monitoring.task_state_counts(d.tasks)
    return d.runs.join(counts, ["dag_id", "run_id"], "left").select(
        "dag_id", "run_id", "state", F.coalesce("task_count", F.lit(0)).alias("task_count"))


@query
def join_inner_equi(d):
    return d.parameters_raw.join(R.rules_history(d.rules_raw).select("rule_version", "effective_from"), "rule_version") \
        .select("rule_version", "effective_from", "rule_path")


@query
def join_asof_rule(d):
    return C.join_asof_rule(d.valid_activities, "activity_date", d.validity, ["rule_version", "bonus_rate"]).select(
        "activity_id", "activity_date", "rule_version", "bonus_rate")


@query
def join_interval_lookback(d):
    return d.grid(["employee_id"], I.SHORT_WINDOW).select(
        "employee_id", "snapshot_date", "activity_count_12m", "sport_days_count_12m",
        "last_activity_date", "last_process_date")


@query
def join_cross_grid(d):
    return d.grid(["employee_id", "business_unit"], I.SHORT_WINDOW).select("employee_id", "business_unit", "snapshot_date")


@query
def join_cross_rules(d):
    return gold.with_active_rule(d.employees, d.validity, I.AS_OF).select(
        "employee_id", "_rule.rule_version", "_rule.bonus_rate", "_rule.min_activities_per_year")


@query
def join_cross_scalars(d):
    valid = d.stored["sil_sport_activities"].agg(F.count_if("is_valid_activity").alias("n"))
    return gold.decision_totals(d.stored_status()).select("*", valid.scalar().alias("activity_count_total"))


@query
def join_full_outer_chain(d):
    """Events by processing day, by activity day, and orders by day of month, on one date axis."""
    by_process = d.activities_bronze.groupBy(F.col("process_date").alias("day")).agg(F.count("*").alias("processed"))
    by_activity = d.valid_activities.groupBy(F.col("activity_date").alias("day")).agg(F.count("*").alias("active"))
    hired = d.employees.groupBy(F.col("birth_date").alias("day")).agg(F.count("*").alias("born")).filter("day is not null")
    merged = by_process.join(by_activity, "day", "full").join(hired, "day", "full")
    return merged.select("day", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("processed", "active", "born")])


@query
def in_subquery_flag(d):
    modes = R.rules_current(d.validity).select(F.explode(
        F.from_json("sportive_transport_modes", "array<string>")).alias("mode")).distinct()
    flagged = d.employees.join(modes, F.col("transport_mode") == F.col("mode"), "left")
    return flagged.select("employee_id", "transport_mode", F.col("mode").isNotNull().alias("is_sportive"))


@query
def scalar_subquery(d):
    latest = d.activities.agg(F.max("process_date")).scalar()
    return d.activities.filter(F.col("process_date") == latest).select("activity_id", "process_date")


@query
def anti_join_orphans(d):
    return J.orphan_rows(d.activities, d.employees, "employee_id", "employee_id").select("activity_id", "employee_id")


@query
def orphan_keys(d):
    return J.orphan_keys(d.activities, d.employees, "employee_id", "employee_id")


# --- aggregations ----------------------------------------------------------------------------

@query
def agg_yearly_activity(d):
    return d.yearly(I.SHORT_WINDOW)


@query
def agg_filtered_global(d):
    return gold.decision_totals(d.status()).drop("eligible_wellbeing_employees")


@query
def agg_timeline_group(d):
    return daily_activity(d.valid_activities)


@query
def agg_daily_counts(d):
    return monitoring.silver_volumes(d.activities)


@query
def agg_timeline_daily(d):
    return rollups.timeline_volumes(d.daily_counts())


@query
def agg_timeline_daily_7d(d):
    return rollups.timeline_volumes(d.daily_counts(I.SHORT_WINDOW))


@query
def agg_timeline_daily_long(d):
    """A trailing year over more than six years of orders, so that the window moves."""
    activities = I.long_activities(d.spark, d.sf_dir)
    return rollups.timeline_volumes(rollups.daily_counts(*timeline.benefit_runs(d.employees, activities, d.validity, 365)))


@query
def agg_state_pivot(d):
    return monitoring.task_state_counts(d.tasks)


@query
def distinct_values(d):
    return C.distinct_dates(d.valid_activities)


@query
def distinct_employee_ids(d):
    return d.employees_raw.filter("employee_id is not null").select("employee_id").distinct().orderBy("employee_id")


@query
def row_counts(d):
    names = ("customer", "orders", "lineitem", "events", "supplier", "documents", "pages", "conversations")
    return monitoring.monitoring_table_row_counts({("source", n): d.table(n) for n in names})


# --- windows and dedup -----------------------------------------------------------------------

@query
def dedup_latest_employee(d):
    return silver.latest_employees(d.employees_bronze).select("employee_id", "ingested_at", "gross_salary_raw", "row_hash")


@query
def dedup_latest_declaration(d):
    return silver.latest_declarations(d.declarations_bronze).select("employee_id", "ingested_at", "declared_sport", "row_hash")


@query
def dedup_latest_activity(d):
    return silver.latest_activities(d.activities_bronze).select("activity_id", "event_ts", "offset_id", "distance_km")


def _recency():
    return [F.desc(c) for c in ("effective_from", "loaded_at", "rule_version")]


@query
def rank_recency(d):
    return ranking.total_order_rank(d.rules_raw, _recency(), "recency_rank").select("rule_version", "recency_rank")


def _chronology():
    return [F.asc(c) for c in ("effective_from", "loaded_at", "rule_version")]


@query
def rank_chronology(d):
    return ranking.total_order_rank(d.rules_raw, _chronology(), "chronology_rank").select("rule_version", "chronology_rank")


@query
def lead_next(d):
    return ranking.lead_in_order(d.rules_raw, _chronology(), "effective_from", "next_effective_from").select(
        "rule_version", "effective_from", "next_effective_from")


@query
def rank_runs_by_time(d):
    order = [F.asc("execution_date"), F.asc(F.col("run_id").cast("bigint"))]
    return ranking.total_order_rank(d.runs, order, "position").select("run_id", "execution_date", "position")


# --- set operations, sort, limit -------------------------------------------------------------

@query
def union_all_anomalies(d):
    return d.anomalies().groupBy("table_name", "anomaly_type", "anomaly_detail").agg(F.count("*").alias("anomalies"))


@query
def union_all_counts(d):
    return d.counts()


@query
def topk_recent(d):
    return monitoring.recent_runs(d.runs).select("dag_id", "run_id", "state")


@query
def sort_series(d):
    return monitoring.raw_volumes(d.activities_bronze).orderBy("process_date")


# --- models ----------------------------------------------------------------------------------

@query
def brz_rh_employees(d):
    return d.employees_bronze


@query
def brz_sport_declarations(d):
    return d.declarations_bronze


@query
def brz_sport_activities(d):
    return d.activities_bronze


def _messages_table(d):
    readable = S.readable_events(S.parse_events(I.messages(d.spark, d.sf_dir)))
    return S.notifications(first_per_key(readable, ["event_id"], [F.asc("offset_id")]))


@query
def brz_slack_messages(d):
    return bronze.brz_slack_messages(_messages_table(d))


@query
def gold_slack_messages(d):
    return gold.gold_slack_messages(bronze.brz_slack_messages(_messages_table(d)))


@query
def sil_employees(d):
    return d.employees


@query
def sil_sport_declarations(d):
    return d.declarations


@query
def sil_sport_activities(d):
    return d.activities


@query
def sil_employee_activity_yearly(d):
    return d.yearly()


@query
def sil_employee_activity_joined(d):
    return d.joined()


@query
def gold_eligible_sport_bonus(d):
    return d.bonus()


@query
def gold_eligible_wellbeing_days(d):
    return d.wellbeing()


@query
def gold_eligible_wellbeing_days_7d(d):
    return d.wellbeing(I.SHORT_WINDOW)


@query
def gold_kpi_employee_status(d):
    return d.status()


@query
def gold_employee_map(d):
    return gold.gold_employee_map(d.employees, d.status())


@query
def gold_kpi_finance(d):
    return gold.gold_kpi_finance(d.stored_status(), d.stored["sil_sport_activities"], I.AS_OF)


@query
def gold_employee_benefit_timeline(d):
    return d.timeline()


@query
def gold_employee_benefit_timeline_7d(d):
    return d.timeline(I.SHORT_WINDOW)


def _refreshed(d, window_days: int):
    """Stored without the activities of one day and those that came late on two others, then brought up to date."""
    late = F.col("activity_date") == F.lit("2024-01-20").cast("date")
    late |= F.col("activity_date").isin("2024-01-08", "2024-01-09") & (F.datediff("process_date", "activity_date") == 2)
    activities, path = d.stored["sil_sport_activities"], d.scratch("timeline")
    refresh.store_timeline(path, d.stored["sil_employees"], activities.filter(~late), d.validity, window_days)
    return refresh.refresh_timeline(
        path, d.stored["sil_employees"], activities, d.validity, activities.filter(late), window_days).select(
        *timeline.COLUMNS)


@query
def timeline_refreshed(d):
    return _refreshed(d, 365)


@query
def timeline_refreshed_7d(d):
    return _refreshed(d, I.SHORT_WINDOW)


@query
def timeline_known_at(d):
    """Snapshots as they were known on their dates: activities count once they have been processed."""
    return timeline.gold_employee_benefit_timeline(d.employees, d.activities, d.validity, I.SHORT_WINDOW, known_at=True)


def _sum_of_some(name: str):
    """The sum of a decimal that is zero in most rows, which adds the others only: decimals are slow to add up."""
    others = F.expr(f"sum({name}) filter (where {name} <> 0)")
    return F.coalesce(others, F.when(F.count(name) > 0, F.lit(0))).alias(name)


@query
def timeline_long_history(d):
    """The whole employee x date grid over six years of activity, rolled up per date."""
    grid = d.long_timeline()
    return grid.groupBy("snapshot_date").agg(
        F.count("*").alias("employees"),
        F.sum("activity_count_on_date").alias("on_date"),
        _sum_of_some("distance_km_on_date").alias("distance_km"),
        F.sum("activity_count_12m").alias("trailing"),
        F.sum("sport_days_count_12m").alias("trailing_days"),
        F.max("last_activity_date").alias("last_activity_date"),
        F.sum(F.datediff("snapshot_date", "last_activity_date")).alias("days_since_activity"),
        F.sum(F.datediff("last_process_date", "last_activity_date")).alias("process_lag"),
        F.count_if("is_wellbeing_eligible").alias("wellbeing_eligible"),
        _sum_of_some("bonus_amount"),
    )


@query
def gold_quality_anomalies(d):
    return d.anomalies()


@query
def monitoring_activity_volumes_daily(d):
    return d.volumes()


@query
def monitoring_activity_volumes_daily_7d(d):
    return d.volumes(I.SHORT_WINDOW)


@query
def monitoring_runs(d):
    return d.run_log()


@query
def monitoring_table_row_counts(d):
    return d.counts()


# --- dashboards and BI -----------------------------------------------------------------------

@query
def dash_failed_runs_7d(d):
    return monitoring.dash_failed_runs_7d(d.runs, I.RUNS_AS_OF_TS)


@query
def dash_latest_day_volume(d):
    return monitoring.dash_latest_day_volume(d.event_volumes())


@query
def dash_flow_series(d):
    return monitoring.dash_flow_series(d.event_volumes())


@query
def dash_active_series(d):
    return monitoring.dash_active_series(d.volumes())


@query
def dash_active_series_7d(d):
    return monitoring.dash_active_series(d.volumes(I.SHORT_WINDOW))


@query
def dash_recent_runs(d):
    return monitoring.dash_recent_runs(d.runs, d.tasks, I.RUNS_AS_OF_TS)


@query
def dash_row_counts(d):
    return monitoring.dash_row_counts(d.counts())


@query
def bi_program_kpis(d):
    return bi.bi_program_kpis(d.status())


@query("bi_distribution")
def bi_distribution_contract(d):
    return bi.bi_distribution(d.status(), "contract_type")


@query("bi_distribution_by_mode")
def bi_distribution_mode(d):
    return bi.bi_distribution(d.status(), "transport_mode")


@query
def bi_eligibility_trend(d):
    return rollups.eligibility_trend(d.daily_counts())


@query
def bi_eligibility_trend_7d(d):
    return rollups.eligibility_trend(d.daily_counts(I.SHORT_WINDOW))


@query
def bi_activity_trend(d):
    return rollups.activity_trend(d.employees, d.activities, d.validity, "contract_type")


@query
def bi_activity_trend_filtered(d):
    return rollups.activity_trend(
        d.employees, d.activities, d.validity, "business_unit", contract_type=["CDI", "CDD"],
        transport_mode=["velo", "marche/running"], date_from="2024-01-08", date_to="2024-01-21")


# --- data quality ----------------------------------------------------------------------------

@query
def check_not_null(d):
    return quality.check_not_null(d.activities, "employee_id").select("activity_id")


@query
def check_unique(d):
    return quality.check_unique(d.activities_bronze, "activity_id")


@query
def check_accepted_values(d):
    return quality.check_accepted_values(d.employees, "contract_type", CONTRACT_TYPES).select("employee_id", "contract_type")


@query
def check_relationships(d):
    return quality.check_relationships(d.activities, d.employees, "employee_id", "employee_id").select(
        "activity_id", "employee_id")


@query
def check_non_negative(d):
    return quality.check_non_negative(d.activities, "distance_km").select("activity_id", "distance_km")


@query
def check_positive_value(d):
    return quality.check_positive_value(d.employees, "gross_salary").select("employee_id", "gross_salary")


@query
def check_between(d):
    return quality.check_between(d.employees, "distance_km_to_office", 2, 25, strict_min=True).select(
        "employee_id", "distance_km_to_office")


@query
def check_in_set(d):
    return quality.check_in_set(d.status(), "is_bonus_eligible", [False]).select("employee_id", "is_bonus_eligible")


def _suite_results(d):
    return quality.validation_suite({**d.stored, "gold_kpi_employee_status": d.stored_status()})


@query
def validation_suite(d):
    return _suite_results(d)


@query
def validation_suite_faults(d):
    """Every kind of check on tables in which some rows fail it."""
    C = quality.Check
    suites = (
        quality.Suite("orders", (
            C("not_null", "order_id"), C("unique", "order_id"), C("not_null", "customer_id"),
            C("relationships", "customer_id", parent=("customers", "customer_id")),
            C("accepted_values", "status", values=("F", "O")), C("in_set", "priority", values=(1, 2, 4)),
            C("non_negative", "amount"), C("positive_value", "priority"),
            C("between", "amount", min_value=0, max_value=100_000, strict_min=True))),
        quality.Suite("customers", (C("unique", "customer_id"),)),
    )
    return quality.validation_suite(I.faulty_tables(d.spark, d.sf_dir), suites)


@query
def model_tests(d):
    """The tests of all models, layer by layer."""
    history, parameters = R.rules_history(d.rules_raw), R.rule_parameters_history(d.parameters_raw, d.validity)
    joined = d.stored_joined
    models = {
        **d.stored,
        "business_rules_history": history, "business_rules_validity": d.validity, "business_rules": R.rules_current(d.validity),
        "business_rule_parameters_history": parameters,
        "business_rule_parameters": R.rule_parameters_current(parameters),
        "brz_rh_employees": d.employees_bronze, "brz_sport_declarations": d.declarations_bronze,
        "brz_sport_activities": d.activities_bronze,
        "sil_employee_activity_yearly": silver.sil_employee_activity_yearly(d.stored["sil_sport_activities"], I.AS_OF),
        "gold_eligible_sport_bonus": gold.gold_eligible_sport_bonus(joined, d.validity, I.AS_OF),
        "gold_eligible_wellbeing_days": gold.gold_eligible_wellbeing_days(joined, d.validity, I.AS_OF),
        "gold_kpi_employee_status": gold.employee_status(joined, d.validity, I.AS_OF),
        "gold_employee_benefit_timeline": d.stored_timeline(),
        "gold_employee_map": gold.gold_employee_map(d.stored["sil_employees"], gold.employee_status(joined, d.validity, I.AS_OF)),
        "monitoring_runs": d.run_log(), "monitoring_activity_volumes_daily": d.volumes(),
    }
    return quality.validation_suite(models, [s for layer in quality.MODEL_SUITES.values() for s in layer])


@query
def validation_report(d):
    """The published report document, one row per table with its single results as text."""
    report = quality.validation_report(_suite_results(d), I.AS_OF_TS)
    document = quality.report_document(report)
    folder = d.scratch("reports")
    quality.publish_report(report, folder, "20240131T120000Z", fail=False)
    published = d.spark.read.schema(document.schema).json(f"{folder}/latest")
    rows = published.select("generated_at", F.col("success").alias("report_success"), F.inline("validations"))
    details = F.transform("details", lambda x: F.concat_ws(
        ":", x["check_name"], x["column_name"], x["failing_rows"].cast("string"), x["success"].cast("string")))
    return rows.select(
        "table_name", "row_count", "success", "evaluated_checks", "successful_checks", "unsuccessful_checks",
        "success_percent", "generated_at", "report_success", F.array_join(details, ",").alias("details"))


# --- streaming -------------------------------------------------------------------------------

def _collect_stream(d, stream: DataFrame, name: str) -> DataFrame:
    """Drain a stream into files and read them back."""
    path = d.scratch(name)
    query = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", d.scratch("progress")).trigger(availableNow=True).start()
    )
    S.drain(query)
    return d.spark.read.schema(stream.schema).parquet(path)


@query
def stream_source(d):
    landed = _collect_stream(d, S.stream_source(d.spark, path=d.write_messages(), max_files=4), "source")
    return landed.groupBy("topic", "partition").agg(F.count("*").alias("messages"), F.max("offset").alias("last_offset"))


@query
def stream_parse_event(d):
    parsed = S.parse_events(S.stream_source(d.spark, path=d.write_messages()))
    return _collect_stream(d, parsed, "parsed").select(
        "event_id", "process_date", "topic", "partition_id", "offset_id", "event_ts", "is_readable")


@query("stream_skip_errors")
def stream_dead_letters(d):
    dead = S.dead_letters(S.parse_events(S.stream_source(d.spark, path=d.write_messages())))
    return _collect_stream(d, dead, "dead").select("partition_id", "offset_id", "payload_json")


@query
def stream_dedup_first(d):
    events = S.readable_events(S.parse_events(S.stream_source(d.spark, path=d.write_messages(rounds=2, altered=True))))
    path = d.scratch("deduped")
    S.drain(S.stream_dedup_first(events, path, d.scratch("progress")))
    return d.spark.read.schema(events.schema).parquet(path).select(
        "event_id", "process_date", "partition_id", "offset_id", "payload_json")


@query
def stream_drain(d):
    return S.read_sink(d.spark, d.ingest(), "events").select("event_id", "process_date", "partition_id", "offset_id")


@query
def stream_notify_once(d):
    return S.read_sink(d.spark, d.ingest(), "messages").select(
        "message_id", "activity_id", "employee_id", "process_date", "message_text", "status")


@query
def stream_progress_metrics(d):
    """Totals of the counts that the running stream wrote batch by batch."""
    names = ("consumed", "accepted", "duplicates", "unreadable", "other_process_date")
    return S.read_sink(d.spark, d.ingest(), "progress").agg(*[F.sum(n).alias(n) for n in names])


@query
def stream_max_messages(d):
    """Two runs with a limit: a third of all messages, then a quarter of them; which run landed an event."""
    total = I.messages(d.spark, d.sf_dir).count()
    root, checkpoint, source = d.scratch("landed"), d.scratch("progress"), d.write_messages()
    for limit in (total // 3, total // 4):
        S.ingest(S.stream_source(d.spark, path=source), root, checkpoint, I.INGEST_DATE, max_messages=limit)
    return S.read_sink(d.spark, root, "events").select(
        "event_id", "partition_id", "offset_id", F.when(F.col("batch_id") >= 0, 1).otherwise(2).alias("run"))


@query
def stream_compaction(d):
    """Messages delivered twice, landed in two runs; the files of their micro-batches are merged after each run."""
    total = I.messages(d.spark, d.sf_dir).count()
    root, checkpoint, source = d.scratch("landed"), d.scratch("progress"), d.write_messages(rounds=2)
    for limit in (total, None):
        S.ingest(S.stream_source(d.spark, path=source, max_files=8), root, checkpoint, I.INGEST_DATE, max_messages=limit)
        S.compact(d.spark, root, checkpoint)
    S.remove_compacted(d.spark, root)
    return S.read_sink(d.spark, root, "events").select("event_id", "process_date", "partition_id", "offset_id")
