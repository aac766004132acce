"""Clean-up of an exported audit log so that it fits the table of the live log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficlake.functions import nested
from trafficlake.operators import columns as C

# Parts of the export the live log does not have, and the renamed record.
RECORD = "protoPayload"
RECORD_AS_STORED = "protopayload_auditlog"
NOT_IN_LIVE_LOG = (
    "@type",
    "serviceData",
    "request",
    "metadata",
    "requestMetadata.destinationAttributes",
    "requestMetadata.requestAttributes.auth",
)
NOT_IN_AUTHORIZATION = ("resourceAttributes",)


def clean_export(raw: DataFrame) -> DataFrame:
    """Drop the surplus nested fields and rename the record column."""
    df = nested.drop_nested(raw, RECORD, *NOT_IN_LIVE_LOG)
    if "authorizationInfo" in df.schema[RECORD].dataType.names:
        granted = df.withColumn("__granted", F.col(f"{RECORD}.authorizationInfo"))
        granted = nested.drop_in_array(granted, "__granted", *NOT_IN_AUTHORIZATION)
        whole = F.col(RECORD).withField("authorizationInfo", F.col("__granted"))
        df = granted.withColumn(RECORD, whole).drop("__granted")
    return C.rename(df, {RECORD: RECORD_AS_STORED})


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line, in as many files as the frame has partitions."""
    df.write.mode("overwrite").json(path)
