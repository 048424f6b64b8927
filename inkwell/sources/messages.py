"""File-reference messages: parsing and validation of any DataFrame with a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from inkwell import schemas
from inkwell.functions import text as TX, urls as U
from inkwell.operators.evaluate import computed_once

CORRUPT = "_corrupt"
ACCEPTED_TYPES = ("HDFS",)


def parse_file_refs(df: DataFrame, value: str = "value") -> DataFrame:
    """Add type, url, inputStream, outputStream and ``malformed``.

    Scalars of any JSON type are read as text, unknown fields are ignored, a JSON
    null counts as absent. The whole message is malformed when it is not one object.
    """
    schema = T.StructType(schemas.FILE_REF.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col(value).cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    out = computed_once(df, "_m", parsed)
    bad = F.col("_m").isNull() | F.col(f"_m.{CORRUPT}").isNotNull()
    fields = [
        # an object or array in place of a scalar reads as empty text
        F.when(~bad & ~F.coalesce(F.col(f"_m.{n}").rlike(r"\A\s*[{\[]"), F.lit(False)), F.col(f"_m.{n}")).alias(n)
        for n in schemas.FILE_REF.fieldNames()
    ]
    return out.select(*df.columns, *fields, bad.alias("malformed"))


def validate_refs(refs: DataFrame, accepted: tuple[str, ...] = ACCEPTED_TYPES) -> DataFrame:
    """Add ``filename``, ``url_key`` and ``reject``, the reason to refuse or NULL."""
    name = U.stream_filename(F.col("url"))
    reject = (
        F.when(F.col("malformed"), F.lit("MALFORMED_JSON"))
        .when(~F.upper(F.coalesce("type", F.lit(""))).isin(*accepted), F.lit("UNSUPPORTED_TYPE"))
        .when(TX.is_blank_trimmed(F.col("url")), F.lit("MISSING_URL"))
        .when(name.isNull(), F.lit("BAD_ENCODING"))
        .when(name == "", F.lit("BAD_NAME"))
    )
    return refs.withColumns({"filename": name, "url_key": U.file_key(F.col("url")), "reject": reject})


def read_messages(spark, path: str, streaming: bool = False, fmt: str = "text") -> DataFrame:
    """File-based message source; any other source only has to provide ``value``.

    A Kafka stream plugs in the same way:
    ``spark.readStream.format("kafka")...selectExpr("CAST(value AS STRING) AS value")``.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "text":
        return reader.format("text").schema("value STRING").load(path)
    return reader.format(fmt).load(path)
