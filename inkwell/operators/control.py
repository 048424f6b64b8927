"""Start/stop control log: replay, state as of a time, backlog of waiting messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.operators import timeline as TL

# Reasons and answers of the control interface, used here and by the live control.
STARTED_REASON = "Processing started via API"
STOPPED_REASON = "Processing stopped via API"
STARTUP_REASON = "Application startup"
START_ANSWER = "Processing started successfully"
STOP_ANSWER = "Processing stopped successfully. Messages will remain in queue."
RESET_ANSWER = "Reset completed successfully. Processing stopped and files cleared."
TOGGLE_ANSWER = "Processing %s successfully. Previous state: %s, Current state: %s. %s"
WORDS = ("stopped", "started")
STATES = ("disabled", "enabled")
TAILS = ("Messages will remain in queue.", "Now consuming messages from queue.")


def control_replay(log: DataFrame, slicing: TL.Slicing = TL.Slicing()) -> DataFrame:
    """State before and after every command; instances begin stopped.

    ``start`` sets 1, ``stop`` and ``reset`` set 0, ``toggle`` flips, anything else
    keeps. With T = running number of toggles and b = (value + T) at the latest
    absolute command, the state is (b + T) mod 2, so two running values per slice
    and two carried ones replace the sequential loop.

    Columns: input, ``state_before``, ``state_after`` (0/1), ``changed``,
    ``reported_change`` (a reset always reports a change), ``status``.
    """
    line = TL.Timeline(["instance_id"], ["ts", "cmd_id"], slicing=slicing)
    w = line.within()
    cmd = F.lower("cmd")
    value = F.when(cmd == "start", F.lit(1)).when(cmd.isin("stop", "reset"), F.lit(0))
    local = (
        line.sliced(log)
        .withColumn("_flip", F.when(cmd == "toggle", F.lit(1)).otherwise(F.lit(0)).cast("long"))
        .withColumn("_t", F.sum("_flip").over(w))
        .withColumn("_set", value + F.col("_t"))
        .withColumns(
            {
                "_b": F.last("_set", ignorenulls=True).over(w),
                "_b0": F.last("_set", ignorenulls=True).over(line.strictly_within()),
            }
        )
    )
    joined = line.with_carry(
        local,
        {"_toggles": F.sum("_flip"), "_last_set": line.last_of("_set")},
        {"_toggles_in": F.sum("_toggles").over(line.before())},
        {"_set_in": F.last(F.col("_last_set") + F.coalesce("_toggles_in", F.lit(0)), ignorenulls=True).over(line.before())},
    )
    toggles_in = F.coalesce("_toggles_in", F.lit(0))
    t_now = F.col("_t") + toggles_in

    def state(local_b: str, toggles: Column) -> Column:
        base = F.coalesce(F.col(local_b) + toggles_in, F.col("_set_in"), F.lit(0))
        return ((base + toggles) % 2).cast("int")

    after = state("_b", t_now)
    return (
        joined.withColumn("state_before", state("_b0", t_now - F.col("_flip")))
        .withColumn("state_after", after)
        .select(
            *line.restored(log.columns),
            "state_before",
            "state_after",
            (F.col("state_before") != F.col("state_after")).alias("changed"),
            ((F.col("state_before") != F.col("state_after")) | (F.lower("cmd") == "reset")).alias("reported_change"),
            F.when(F.col("state_after") == 1, F.lit("STARTED")).otherwise(F.lit("STOPPED")).alias("status"),
        )
    )


def control_state(replay: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Current state, time and reason of the last change per instance."""
    rows = replay if as_of is None else replay.where(F.col("ts") <= as_of)
    order = F.struct("ts", "cmd_id")
    change_order = F.when(F.col("changed"), order)
    return rows.groupBy("instance_id").agg(
        F.max_by("status", order).alias("status"),
        F.max_by("ts", change_order).alias("last_changed"),
        F.coalesce(
            F.max_by(
                F.when(F.col("state_after") == 1, F.lit(STARTED_REASON)).otherwise(F.lit(STOPPED_REASON)),
                change_order,
            ),
            F.lit(STARTUP_REASON),
        ).alias("reason"),
    ).withColumn("enabled", F.col("status") == "STARTED")


def control_response(replay: DataFrame) -> DataFrame:
    """The answer each command gives: success flag, states, consumer status, message."""

    def choose(c: str, values: tuple[str, str]) -> Column:
        return F.when(F.col(c) == 1, F.lit(values[1])).otherwise(F.lit(values[0]))

    word = choose("state_after", WORDS)
    cmd = F.lower("cmd")
    message = (
        F.when(cmd == "start", F.lit(START_ANSWER))
        .when(cmd == "stop", F.lit(STOP_ANSWER))
        .when(cmd == "reset", F.lit(RESET_ANSWER))
        .when(
            cmd == "toggle",
            F.format_string(TOGGLE_ANSWER, word, choose("state_before", STATES), choose("state_after", STATES), choose("state_after", TAILS)),
        )
    )
    return replay.select(
        "cmd_id", "instance_id", "ts", "cmd", "status",
        F.col("reported_change").alias("state_changed"),
        F.when(F.col("state_after") == 1, F.lit("CONSUMING")).otherwise(F.lit("IDLE")).alias("consumer_status"),
        F.when(cmd == "toggle", word).alias("action"),
        message.alias("message"),
    )


def consume_backlog(arrivals: DataFrame, replay: DataFrame, slicing: TL.Slicing = TL.Slicing()) -> DataFrame:
    """When each arrival is consumed: at once while started, else at the next start.

    An interval join written as one union of both logs: the state comes from the
    changes before the arrival, the next start from those after it.
    ``consumed_at`` stays NULL while no later start exists.
    """
    line = TL.Timeline(["instance_id"], ["ts", "event_id"], slicing=slicing)
    changes = replay.where("changed").select(
        "instance_id", "ts", F.col("cmd_id").alias("event_id"), F.col("state_after").alias("_state")
    )
    both = arrivals.select("instance_id", "ts", "event_id", F.lit(None).cast("int").alias("_state")).unionByName(changes)
    start_ts = F.when(F.col("_state") == 1, F.col("ts"))
    local = line.sliced(both).withColumns(
        {
            "_now": F.last("_state", ignorenulls=True).over(line.within()),
            "_next": F.min(start_ts).over(line.rest_of_slice()),
        }
    )
    carries = {
        "_now_c": F.last("_last", ignorenulls=True).over(line.before()),
        "_next_c": F.min("_first_start").over(line.after()),
    }
    tails = {"_last": line.last_of("_state"), "_first_start": F.min(start_ts)}
    joined = line.with_carry(local, tails, carries).where(F.col("_state").isNull())
    started = F.coalesce("_now", "_now_c", F.lit(0)) == 1
    return joined.select(
        *line.restored(["instance_id", "event_id"]),
        F.col("ts").alias("arrived_at"),
        F.when(started, F.col("ts")).otherwise(F.coalesce("_next", "_next_c")).alias("consumed_at"),
        (~started).alias("waited"),
    )


def queue_depth_series(consumed: DataFrame, slicing: TL.Slicing = TL.Slicing()) -> DataFrame:
    """Messages waiting after each moment at which something arrived or was consumed."""
    moves = consumed.select(
        "instance_id",
        F.explode(
            F.array(
                F.struct(F.col("arrived_at").alias("ts"), F.lit(1).alias("arrived"), F.lit(0).alias("taken")),
                F.struct(F.col("consumed_at").alias("ts"), F.lit(0).alias("arrived"), F.lit(1).alias("taken")),
            )
        ).alias("m"),
    ).select("instance_id", "m.*").where(F.col("ts").isNotNull())
    # one row per moment first: a restart consumes a whole backlog at one instant
    steps = moves.groupBy("instance_id", "ts").agg(F.sum("arrived").alias("arrived"), F.sum("taken").alias("taken"))
    line = TL.Timeline(["instance_id"], ["ts"], slicing=slicing)
    return TL.running_sum(steps, line, F.col("arrived") - F.col("taken"), "depth")
