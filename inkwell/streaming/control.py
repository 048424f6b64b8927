"""Start, stop, toggle and reset of a document stream, with a durable command log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from inkwell import schemas
from inkwell.operators import control as K
from inkwell.sinks import tables as TB

# starts the stream on the tables and checkpoint of one generation
Starter = Callable[[str, str], StreamingQuery]


def _now() -> datetime:
    """With its zone: a naive time would be read in the zone of the driver."""
    return datetime.now(timezone.utc)


def _text(at: datetime) -> str:
    return at.replace(tzinfo=None).isoformat() + "Z"


class PipelineControl:
    """Controls one stream. It begins stopped; messages wait in the source while it is.

    Output tables and checkpoint live in a generation folder. A reset deletes the
    current one and moves on to the next, because a stream that kept its checkpoint
    would not read its input again.
    """

    def __init__(self, spark: SparkSession, root: str, starter: Starter, instance_id: str = "document-stream"):
        self.spark, self.root, self.starter, self.instance_id = spark, root.rstrip("/"), starter, instance_id
        self.query: StreamingQuery | None = None
        self.last_changed = _now()
        self.reason = K.STARTUP_REASON
        self._log_path = f"{self.root}/control_log"
        TB.ensure_dir(spark, self.tables)

    @property
    def generation(self) -> int:
        found = [int(d.split("=")[1]) for d in TB.sub_dirs(self.spark, f"{self.root}/generations")]
        return max(found, default=0)

    @property
    def tables(self) -> str:
        return f"{self.root}/generations/gen={self.generation}"

    @property
    def enabled(self) -> bool:
        return self.query is not None and self.query.isActive

    def _record(self, cmd: str) -> None:
        row = [(int(_now().timestamp() * 1_000_000), self.instance_id, _now(), cmd)]
        self.spark.createDataFrame(row, schemas.CONTROL_LOG).write.mode("append").parquet(self._log_path)

    def _notice_end(self) -> None:
        """A query that ended by itself is logged as a stop, with its reason."""
        if self.query is not None and not self.query.isActive:
            error = self.query.exception()
            self.query = None
            self.reason = f"Query ended: {error}" if error else "Query ended"
            self.last_changed = _now()
            self._record("stop")

    def _set(self, on: bool) -> bool:
        if on == self.enabled:
            return False
        if on:
            self.query = self.starter(self.tables, f"{self.tables}/checkpoint")
            self.reason = K.STARTED_REASON
        else:
            self.query.stop()
            self.query = None
            self.reason = K.STOPPED_REASON
        self.last_changed = _now()
        return True

    def _answer(self, message: str, changed: bool, **extra) -> dict:
        on = self.enabled
        return {
            "success": True,
            "message": message,
            "stateChanged": changed,
            "enabled": on,
            "status": "STARTED" if on else "STOPPED",
            "consumerStatus": "CONSUMING" if on else "IDLE",
            "lastChanged": _text(self.last_changed),
            "timestamp": _text(_now()),
            **extra,
        }

    def start(self) -> dict:
        self._notice_end()
        self._record("start")
        return self._answer(K.START_ANSWER, self._set(True))

    def stop(self) -> dict:
        self._notice_end()
        self._record("stop")
        changed = self._set(False)
        return self._answer(K.STOP_ANSWER, changed)

    def toggle(self) -> dict:
        self._notice_end()
        self._record("toggle")
        was = self.enabled
        changed = self._set(not was)
        now = int(not was)
        word = K.WORDS[now]
        message = K.TOGGLE_ANSWER % (word, K.STATES[int(was)], K.STATES[now], K.TAILS[now])
        before = {"enabled": was, "status": "STARTED" if was else "STOPPED"}
        return self._answer(message, changed, action=word, previousState=before)

    def reset(self) -> dict:
        """Stop, drop all output and processing history, continue in a new generation."""
        self._notice_end()
        self._record("reset")
        self._set(False)
        old, number = self.tables, self.generation
        created = TB.ensure_dir(self.spark, f"{self.root}/generations/gen={number + 1}")
        cleared = TB.delete_dir(self.spark, old)
        return self._answer(
            K.RESET_ANSWER, True,
            hdfsCleared=cleared, directoryRecreated=created,
        )

    def state(self) -> dict:
        self._notice_end()
        on = self.enabled
        return {
            "enabled": on,
            "status": "STARTED" if on else "STOPPED",
            "consumerStatus": "CONSUMING" if on else "IDLE",
            "lastChanged": _text(self.last_changed),
            "lastChangeReason": self.reason,
            "timestamp": _text(_now()),
        }

    def log(self) -> DataFrame:
        """All commands ever given, as input for the control operators."""
        if not TB.path_exists(self.spark, self._log_path):
            return self.spark.createDataFrame([], schemas.CONTROL_LOG)
        return self.spark.read.schema(schemas.CONTROL_LOG).parquet(self._log_path)
