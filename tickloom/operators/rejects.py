"""Decode JSON messages, keep what cannot be decoded, and count both on the way.

A message that is no JSON, or has a field of the wrong type, decodes to NULLs nobody counts
(:mod:`tickloom.operators.decode`). Here each message gets the reason why it is rejected, or
none; rows and rejects are written by one job, and ``observe`` counts them as they pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickloom.functions import EmptyInputError

# Reasons, the first that holds.
NO_VALUE, BROKEN, WRONG_TYPE, MISSING = "no value", "broken JSON", "wrong type", "missing {}"

_RAW = "_raw"


@dataclass(frozen=True)
class Decoded:
    """What was written: decoded rows, rejects (``raw``, ``reason``), and how many each."""

    rows: DataFrame
    rejects: DataFrame
    accepted: int
    rejected: int

    def require_rows(self, what: str = "messages") -> Decoded:
        """Raise if no message was accepted; nothing is read for that."""
        if not self.accepted:
            raise EmptyInputError(f"no usable rows in {what}: {self.rejected} rejected")
        return self


def with_reason(
    records: DataFrame, schema: StructType, required: Sequence[str] = (), keep: Sequence[str] = (), times: Sequence[str] = ()
) -> DataFrame:
    """``keep`` columns, ``data`` (the decoded struct), ``raw`` text and ``reason``.

    ``required`` fields must be there; ``times`` must be readable as timestamps, too.
    """
    wide = StructType([*schema.fields, StructField(_RAW, StringType())])
    raw = F.col("value").cast("string")
    data = F.from_json(raw, wide, {"columnNameOfCorruptRecord": _RAW})
    rows = records.select(*keep, raw.alias("raw"), data.alias("data"))
    field = lambda name: F.col("data")[name]
    reason = F.when(F.length(F.trim(F.coalesce("raw", F.lit("")))) == 0, NO_VALUE)
    reason = reason.when(F.try_parse_json("raw").isNull(), BROKEN).when(field(_RAW).isNotNull(), WRONG_TYPE)
    for name in required:
        reason = reason.when(field(name).isNull(), MISSING.format(name))
    for name in times:
        reason = reason.when(F.try_to_timestamp(field(name)).isNull(), MISSING.format(name))
    return rows.withColumn("reason", reason)


def _fields(schema: StructType) -> list[Column]:
    return [F.col("data")[name].alias(name) for name in schema.fieldNames()]


def decode_or_reject(
    records: DataFrame,
    schema: StructType,
    path: str,
    required: Sequence[str] = (),
    keep: Sequence[str] = (),
    times: Sequence[str] = (),
) -> Decoded:
    """Write rows and rejects of the messages below ``path``, in one pass over them."""
    marked = with_reason(records, schema, required, keep, times)
    seen = Observation("decoded")
    is_rejected = F.col("reason").isNotNull()
    counted = marked.observe(seen, F.count_if(~is_rejected).alias("accepted"), F.count_if(is_rejected).alias("rejected"))
    # What the other kind needs stays out of the file.
    rows = counted.select(
        *keep, F.when(~is_rejected, F.struct(*_fields(schema))).alias("data"), F.when(is_rejected, F.col("raw")).alias("raw"), "reason",
        F.when(is_rejected, "rejects").otherwise("rows").alias("kind"),
    )
    rows.write.mode("overwrite").partitionBy("kind").parquet(path)
    written = records.sparkSession.read.schema(rows.schema).parquet(path)
    return Decoded(
        written.filter("kind = 'rows'").select(*keep, "data.*"),
        written.filter("kind = 'rejects'").select(*keep, "raw", "reason"),
        seen.get["accepted"],
        seen.get["rejected"],
    )


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected messages by reason."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))
