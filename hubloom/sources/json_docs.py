"""JSON bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


def decode(raw: DataFrame, schema: StructType, body: str = "body") -> DataFrame:
    """Add `decoded` and `status`: 200, or 400 where the body is not one JSON
    object of the schema. Nothing fails the job.

    `decoded` of a 400 row may hold the fields read before the fault. A filter
    on `status` is pushed down to the scan and reads the JSON once more there,
    so prefer `when` on it where the rows can stay together.
    """
    with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    decoded = F.from_json(F.col(body), with_corrupt, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    readable = F.col("decoded").isNotNull() & F.col(f"decoded.{CORRUPT}").isNull()
    return (raw.withColumn("decoded", decoded)
            .withColumn("status", F.when(readable, F.lit(200)).otherwise(F.lit(400))))


def decode_json(raw: DataFrame, schema: StructType,
                body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Decode JSON bodies into `(good, rejects)`.

    Names are matched with their case, one value of a wrong type rejects the
    whole body, and a bare `null` is rejected.
    """
    both = decode(raw, schema, body)
    kept = [c for c in raw.columns if c != body]
    good = both.where(F.col("status") == 200).select(
        *kept, *(F.col("decoded")[f.name].alias(f.name) for f in schema.fields))
    rejects = both.where(F.col("status") == 400).select(*raw.columns, "status")
    return good, rejects
