"""Vocabularies and derivations used by monitoring messages and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Closed vocabularies of the monitoring message.
EVENTS = (
    "INIT", "HEARTBEAT", "ERROR", "SHUTDOWN", "RESTART",
    "FILE_START", "FILE_COMPLETE", "CHUNK_COMPLETE", "FILE_PROCESSED",
)
STATUSES = ("RUNNING", "PROCESSING", "IDLE", "ERROR", "STARTING", "STOPPING", "DISABLED")
STAGES = ("watching", "scanning", "processing", "uploading", "idle", "error", "starting", "stopping")

# Message fragments of each error class, checked in this order.
ERROR_CLASSES = {
    "CORRUPTED_PDF": (
        "Missing root object specification in trailer",
        "TIKA-198",
        "Illegal IOException from org.apache.tika.parser.pdf.PDFParser",
    ),
    "PARSE_ERROR": ("TikaException", "org.apache.tika"),
    "IO_ERROR": ("IOException",),
    "MEMORY_ERROR": ("OutOfMemoryError", "memory"),
}


def error_class(message: Column) -> Column:
    """First matching class wins; NULL has its own class."""
    result = F.when(message.isNull(), F.lit("NO_MESSAGE"))
    for name, fragments in ERROR_CLASSES.items():
        hit = F.contains(message, F.lit(fragments[0]))
        for fragment in fragments[1:]:
            hit = hit | F.contains(message, F.lit(fragment))
        result = result.when(hit, F.lit(name))
    return result.otherwise(F.lit("UNKNOWN"))


def consumer_status(raw: Column) -> Column:
    """CONSUMING / IDLE by substring, running first; anything else in upper case."""
    low = F.lower(raw)
    return (
        F.when(raw.isNull(), F.lit("UNKNOWN"))
        .when(F.contains(low, F.lit("running")), F.lit("CONSUMING"))
        .when(F.contains(low, F.lit("stopped")), F.lit("IDLE"))
        .otherwise(F.upper(raw))
    )


def binding_status(name: Column, state: Column) -> Column:
    """Readable status line of a named binding from its raw state text."""
    return F.concat(
        F.lit("Binding "),
        name,
        F.lit(": "),
        F.when(state.isNull(), F.lit("unknown"))
        .when(F.contains(state, F.lit("state=running")), F.lit("running"))
        .when(F.contains(state, F.lit("state=stopped")), F.lit("stopped"))
        .otherwise(state),
    )


def is_running(state: Column) -> Column:
    """Looser boolean: the state text mentions running at all."""
    return F.coalesce(F.contains(state, F.lit("running")), F.lit(False))


def derived_status(enabled: Column, running: Column) -> Column:
    return F.when(enabled & running, F.lit("RUNNING")).otherwise(F.lit("IDLE"))


def derived_stage(enabled: Column, running: Column) -> Column:
    return F.when(enabled & running, F.lit("processing")).otherwise(F.lit("idle"))


def event_status(event: Column, enabled: Column, running: Column) -> Column:
    busy = F.upper(event).isin("PROCESSING", "FILE_START", "FILE_COMPLETE")
    return F.when(busy, F.lit("PROCESSING")).otherwise(derived_status(enabled, running))


def event_stage(event: Column, enabled: Column, running: Column) -> Column:
    busy = F.upper(event).isin("FILE_START", "FILE_COMPLETE")
    return F.when(busy, F.lit("processing")).otherwise(derived_stage(enabled, running))


def uptime_text(seconds: Column) -> Column:
    """``25h 0m`` style."""
    hours = F.call_function("div", seconds, F.lit(3600))
    minutes = F.call_function("div", seconds, F.lit(60)) % 60
    return F.format_string("%dh %dm", hours.cast("long"), minutes.cast("long"))


def processing_rate(count: Column, seconds: Column) -> Column:
    """Items per whole second of uptime, 0.0 before the first second has passed."""
    return F.when(seconds > 0, count.cast("double") / seconds.cast("double")).otherwise(F.lit(0.0))


def present(value: Column) -> Column:
    """NULL for blank values, so that ``coalesce`` skips them."""
    return F.when(F.trim(value) != "", value)


def first_uri_host(platform_json: Column) -> Column:
    """Lower-cased first entry of ``application_uris`` in a platform JSON document."""
    return F.lower(F.get_json_object(platform_json, "$.application_uris[0]"))


def port_number(raw: Column, default: int = 8080) -> Column:
    return F.coalesce(raw.try_cast("int"), F.lit(default))


def public_url(override: Column, public_host: Column, port: Column) -> Column:
    return F.coalesce(
        present(override),
        F.concat(F.lit("https://"), present(public_host)),
        F.concat(F.lit("http://localhost:"), port.cast("string")),
    )


def instance_url(url: Column, public_host: Column, host: Column, default_port: int = 8080) -> Column:
    """The message's own URL, else the public or internal host with a port."""
    target = F.coalesce(present(public_host), present(host))
    with_port = F.when(target.rlike(r":\d+\z"), target).otherwise(F.concat(target, F.lit(f":{default_port}")))
    return F.coalesce(present(url), F.concat(F.lit("http://"), with_port))


def instance_id(override: Column, app: Column, index: Column, pid: Column, host: Column) -> Column:
    """Override, else app-index, else app-pid@host with ``unknown`` for a missing pid."""
    pid_text = F.when(pid > 0, pid.cast("string")).otherwise(F.lit("unknown"))
    return F.coalesce(
        present(override),
        F.concat(app, F.lit("-"), present(index)),
        F.concat(app, F.lit("-"), pid_text, F.lit("@"), host),
    )


def message_time(raw: Column) -> Column:
    """ISO-8601 text or epoch milliseconds as a timestamp; NULL for anything else."""
    return F.when(raw.rlike(r"\A\d+\z"), F.timestamp_millis(raw.try_cast("long"))).otherwise(
        F.try_to_timestamp(raw)
    )


def health(dir_exists: Column) -> Column:
    return F.when(dir_exists, F.lit("UP")).otherwise(F.lit("DEGRADED"))


def liveness(age_us: Column, alive_s: float = 30, degraded_s: float = 120) -> Column:
    """Alive / Degraded / Offline by microseconds since the last activity, bounds inclusive."""
    return (
        F.when(age_us <= F.lit(int(alive_s * 1_000_000)), F.lit("Alive"))
        .when(age_us <= F.lit(int(degraded_s * 1_000_000)), F.lit("Degraded"))
        .otherwise(F.lit("Offline"))
    )
