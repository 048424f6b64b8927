"""Monitoring messages: parsing, validation, registry, liveness, rollups, error tracking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from inkwell import schemas
from inkwell.functions import status as S
from inkwell.operators import timeline as TL
from inkwell.operators.evaluate import computed_once

# The two published lists of required fields.
REQUIRED_FULL = ("instanceId", "timestamp", "event", "status", "url", "meta.service", "meta.processingStage")
REQUIRED_BASIC = ("instanceId", "timestamp", "status", "meta.service")
REGISTRY_KEY = ["service", "instanceId"]


def _timeline(slicing: TL.Slicing) -> TL.Timeline:
    return TL.Timeline(REGISTRY_KEY, ["ts", "event_id"], slicing=slicing)


def parse_metrics(df: DataFrame, value: str = "value") -> DataFrame:
    """Typed columns of a JSON monitoring message plus ``ts`` and ``malformed``."""
    schema = T.StructType(schemas.METRICS.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = computed_once(df, "_m", parsed)
    keep = [c for c in df.columns if c != value]
    bad = F.col("_m").isNull() | F.col("_m._corrupt").isNotNull()
    return out.select(
        *keep,
        *[F.when(~bad, _with_tags(F.col("_m.meta")) if f.name == "meta" else F.col(f"_m.{f.name}")).alias(f.name) for f in schemas.METRICS.fields],
        S.message_time(F.col("_m.timestamp")).alias("ts"),
        bad.alias("malformed"),
    )


def _with_tags(meta: Column) -> Column:
    """Absent tags are an empty map."""
    none = F.create_map().cast("map<string,string>")
    return F.when(meta.isNotNull(), meta.withField("tags", F.coalesce(meta["tags"], none)))


def validate_metrics(parsed: DataFrame, required: tuple[str, ...] = REQUIRED_FULL) -> DataFrame:
    """Add ``violations``, the names of missing fields and of values outside the vocabularies."""
    checks = [F.when(F.col(n).isNull(), F.lit(f"missing:{n}")) for n in required]
    checks.append(F.when(F.col("timestamp").isNotNull() & F.col("ts").isNull(), F.lit("format:timestamp")))
    for name, domain in (("event", S.EVENTS), ("status", S.STATUSES), ("meta.processingStage", S.STAGES)):
        checks.append(F.when(~F.col(name).isin(*domain), F.lit(f"value:{name}")))
    found = F.array_compact(F.array(*checks))
    return parsed.withColumn("violations", F.when(F.col("malformed"), F.array(F.lit("malformed"))).otherwise(found))


def search_events(df: DataFrame, term: str, value: str = "value") -> DataFrame:
    """Messages whose text contains the term, ignoring case."""
    return df.where(F.contains(F.lower(F.col(value)), F.lit(term.lower())))


def metrics_json(metrics: DataFrame) -> DataFrame:
    """Messages as JSON text for any sink; NULL fields are left out."""
    names = [f.name for f in schemas.METRICS.fields if f.name in metrics.columns]
    return metrics.withColumn("value", F.to_json(F.struct(*names)))


def instance_registry(metrics: DataFrame) -> DataFrame:
    """Last activity (any message), heartbeat (INIT, HEARTBEAT) and shutdown per instance."""
    event = F.col("event")
    return metrics.groupBy(*REGISTRY_KEY).agg(
        F.max("ts").alias("last_activity"),
        F.max(F.when(event.isin("INIT", "HEARTBEAT"), F.col("ts"))).alias("last_heartbeat"),
        F.max(F.when(event == "SHUTDOWN", F.col("ts"))).alias("last_shutdown"),
        F.count(F.lit(1)).alias("n_messages"),
    )


def with_liveness(registry: DataFrame, as_of: Column, alive_s: float = 30, degraded_s: float = 120,
                  stale_s: float = 20) -> DataFrame:
    """Add ``liveness`` and ``hb_stale``; an instance whose last message was SHUTDOWN is Stopped."""
    now = F.unix_micros(as_of)
    age = now - F.unix_micros("last_activity")
    beat_age = now - F.unix_micros("last_heartbeat")
    ended = F.coalesce(F.col("last_shutdown") == F.col("last_activity"), F.lit(False))
    return registry.withColumns(
        {
            "liveness": F.when(ended, F.lit("Stopped")).otherwise(S.liveness(age, alive_s, degraded_s)),
            # never a heartbeat counts as stale
            "hb_stale": F.coalesce(beat_age > F.lit(int(stale_s * 1_000_000)), F.lit(True)),
        }
    )


def service_rollup(live: DataFrame) -> DataFrame:
    return live.groupBy("service", "liveness").agg(F.count(F.lit(1)).alias("n_instances"))


def dashboard_counts(metrics: DataFrame) -> DataFrame:
    """All messages, those from active instances and errors."""
    return metrics.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status").isin("RUNNING", "PROCESSING")).alias("active"),
        F.count_if(F.col("status") == "ERROR").alias("errors"),
    )


def recent_events(metrics: DataFrame, n: int = 50) -> DataFrame:
    """The last ``n`` messages, newest first; this report is a top-n by definition."""
    return metrics.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def instance_rates(metrics: DataFrame, done_event: str = "FILE_COMPLETE") -> DataFrame:
    """Files per whole second between the first and the last message of an instance."""
    agg = metrics.groupBy(*REGISTRY_KEY).agg(
        F.count_if(F.col("event") == done_event).alias("files_processed"),
        F.min("ts").alias("_from"),
        F.max("ts").alias("_to"),
    )
    seconds = F.call_function("div", F.unix_micros("_to") - F.unix_micros("_from"), F.lit(1_000_000))
    return agg.withColumn("uptime_s", seconds).select(
        *REGISTRY_KEY,
        "files_processed",
        "uptime_s",
        S.processing_rate(F.col("files_processed"), F.col("uptime_s")).alias("rate"),
        S.uptime_text(F.col("uptime_s")).alias("uptime"),
    )


def boot_epochs(metrics: DataFrame, slicing: TL.Slicing = TL.Slicing()) -> DataFrame:
    """Set ``bootEpoch`` to the epoch milliseconds of the latest INIT at or before each message."""
    init = F.when(F.col("event") == "INIT", F.unix_millis("ts"))
    rest = metrics.drop("bootEpoch")
    return TL.running_last(rest, _timeline(slicing), init, "bootEpoch")


def init_messages(metrics: DataFrame) -> DataFrame:
    """The start message of each boot: its first message with zeroed counters."""
    first = (
        metrics.where(F.col("bootEpoch").isNotNull())
        .groupBy(*REGISTRY_KEY, "bootEpoch")
        .agg(F.min(F.struct("ts", "event_id", "version", "hostname")).alias("f"))
    )
    zero = F.lit(0).cast("long")
    unknown = F.lit(-1).cast("long")
    return first.select(
        *REGISTRY_KEY,
        "bootEpoch",
        F.col("f.ts").alias("ts"),
        F.col("f.version").alias("version"),
        F.col("f.hostname").alias("hostname"),
        F.lit("INIT").alias("event"),
        F.lit("STARTING").alias("status"),
        F.lit("starting").alias("stage"),
        F.lit("0s").alias("uptime"),
        zero.alias("filesProcessed"),
        zero.alias("errorCount"),
        unknown.alias("filesTotal"),
        unknown.alias("pendingMessages"),
    )


def snapshot(metrics: DataFrame, control: DataFrame, as_of: Column) -> DataFrame:
    """One current monitoring message per instance from its messages and control state."""
    order = F.struct("ts", "event_id")
    agg = metrics.groupBy(*REGISTRY_KEY).agg(
        F.count_if(F.col("event") == "FILE_COMPLETE").alias("filesProcessed"),
        F.min("ts").alias("_from"),
        F.max_by("hostname", order).alias("hostname"),
        F.max_by("version", order).alias("version"),
        # -1 stands for unknown
        F.max_by(F.expr("nullif(pendingMessages, -1)"),
                 F.when(F.expr("nullif(pendingMessages, -1)").isNotNull(), order)).alias("pendingMessages"),
    )
    joined = agg.join(control.select(F.col("instance_id").alias("instanceId"), "enabled"), "instanceId", "left")
    enabled = F.coalesce("enabled", F.lit(False))
    seconds = F.call_function("div", F.unix_micros(as_of) - F.unix_micros("_from"), F.lit(1_000_000))
    return joined.withColumn("_s", seconds).select(
        *REGISTRY_KEY,
        F.lit("HEARTBEAT").alias("event"),
        S.derived_status(enabled, enabled).alias("status"),
        S.derived_stage(enabled, enabled).alias("stage"),
        "filesProcessed",
        "pendingMessages",
        S.processing_rate(F.col("filesProcessed"), F.col("_s")).alias("processingRate"),
        S.uptime_text(F.col("_s")).alias("uptime"),
        "hostname",
        "version",
    )


def restarts(metrics: DataFrame) -> DataFrame:
    """Boots, restarts and latest version per instance."""
    return metrics.groupBy(*REGISTRY_KEY).agg(
        F.countDistinct("bootEpoch").alias("boots"),
        F.greatest(F.countDistinct("bootEpoch") - 1, F.lit(0)).alias("restarts"),
        F.max_by("version", F.when(F.col("version").isNotNull(), F.struct("ts", "event_id"))).alias("version"),
    )


def error_tracking(metrics: DataFrame, slicing: TL.Slicing = TL.Slicing()) -> DataFrame:
    """Running error count and last error text per message."""
    line = _timeline(slicing)
    rest = metrics.drop("errorCount")
    local = (
        line.sliced(rest)
        .withColumn("_e", F.when(F.col("event") == "ERROR", F.lit(1)).otherwise(F.lit(0)).cast("long"))
        .withColumns(
            {"_n": F.sum("_e").over(line.within()), "_l": F.last("lastError", ignorenulls=True).over(line.within())}
        )
    )
    carries = {
        "_cn": F.sum("_ne").over(line.before()),
        "_cl": F.last("_le", ignorenulls=True).over(line.before()),
    }
    joined = line.with_carry(local, {"_ne": F.sum("_e"), "_le": line.last_of("lastError")}, carries)
    return joined.select(
        *line.restored([c for c in rest.columns if c != "lastError"]),
        (F.col("_n") + F.coalesce("_cn", F.lit(0))).alias("errorCount"),
        F.coalesce("_l", "_cl").alias("lastError"),
    )


def status_mapping(metrics: DataFrame, enabled: Column, interval_s: int,
                   slicing: TL.Slicing = TL.Slicing()) -> DataFrame:
    """ERROR, DISABLED, PROCESSING (work within the last interval) or IDLE per message."""
    work = F.when(F.col("event").isin("FILE_START", "FILE_COMPLETE", "CHUNK_COMPLETE"), F.col("ts"))
    withwork = TL.running_last(metrics, _timeline(slicing), work, "last_work")
    recent = F.unix_micros("ts") - F.unix_micros("last_work") <= F.lit(interval_s * 1_000_000)
    return withwork.withColumn(
        "mapped_status",
        F.when(F.col("status") == "ERROR", F.lit("ERROR"))
        .when(~enabled, F.lit("DISABLED"))
        .when(recent, F.lit("PROCESSING"))
        .otherwise(F.lit("IDLE")),
    )


def heartbeat_windows(metrics: DataFrame, width: str = "10 seconds") -> DataFrame:
    """Messages and heartbeats per instance and time window."""
    return (
        metrics.groupBy(*REGISTRY_KEY, F.window("ts", width).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.count_if(F.col("event").isin("INIT", "HEARTBEAT")).alias("n_heartbeats"),
        )
        .select(*REGISTRY_KEY, F.col("w.start").alias("window_start"), "n_messages", "n_heartbeats")
    )


def missed_heartbeats(metrics: DataFrame, interval_s: int, slicing: TL.Slicing = TL.Slicing()) -> DataFrame:
    """Heartbeats that came later than one interval after the previous one, with the beats missed."""
    beats = metrics.where(F.col("event").isin("INIT", "HEARTBEAT")).select(*REGISTRY_KEY, "ts", "event_id")
    prev = TL.running_last(beats, _timeline(slicing), F.col("ts"), "previous_ts", current=False)
    gap = F.unix_micros("ts") - F.unix_micros("previous_ts")
    missed = F.call_function("div", gap - 1, F.lit(interval_s * 1_000_000))
    return prev.withColumn("missed", missed).where("missed > 0")


def health_report(metrics: DataFrame, control: DataFrame) -> DataFrame:
    """UP or DEGRADED per instance from its latest message; details are kept either way."""
    order = F.struct("ts", "event_id")
    latest = metrics.groupBy(*REGISTRY_KEY).agg(
        F.max_by("hdfsProcessedDirExists", order).alias("dir_exists"),
        F.max_by("bindingState", order).alias("binding"),
        F.count_if(F.col("event") == "FILE_COMPLETE").alias("processed_count"),
    )
    joined = latest.join(
        control.select(F.col("instance_id").alias("instanceId"), F.col("status").alias("_state")), "instanceId", "left"
    )
    return joined.select(
        *REGISTRY_KEY,
        S.health(F.coalesce("dir_exists", F.lit(False))).alias("health"),
        F.coalesce("_state", F.lit("STOPPED")).alias("processing_state"),
        S.is_running(F.col("binding")).alias("consumer_running"),
        F.coalesce("dir_exists", F.lit(False)).alias("dir_exists"),
        "processed_count",
    )
