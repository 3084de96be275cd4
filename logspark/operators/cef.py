"""Common Event Format records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logspark.functions.binding import with_fields
from logspark.functions.ip import canon_ip

CEF_COLUMNS = ("DeviceVendor", "DeviceProduct", "DeviceVersion", "SignatureID", "Name", "Severity")

# key=value pairs; a value runs until the next " key=". A backslash hides an equals sign.
PAIRS = r"(?s)(?:^|(?<= ))([^ =]+)(?<!\\)=(.*?)(?= [^ =]+(?<!\\)=|$)"


def parse_cef(df: DataFrame, col: str = "syslog_message", error: str = "_error") -> DataFrame:
    """Add the six header columns, ``Extensions`` and ``_warn``; reject short or empty records.

    Values are not unescaped. An empty value is kept except at the end, a lone one-character
    key is dropped, and the last of repeated keys wins. An unescaped ``=`` inside a value
    stays part of it and sets ``_warn``.
    """
    body = F.ltrim(
        F.when(
            F.startswith(F.col(col), F.lit("CEF: ")), F.regexp_replace(F.col(col), r"^[CEF: ]+", "")
        ).otherwise(F.col(col))
    )
    out = with_fields(df, [F.split(body, r"\|", 8).alias("__c")])
    text = F.get("__c", F.lit(7))
    out = with_fields(
        out,
        [F.regexp_extract_all(text, F.lit(PAIRS), F.lit(i)).alias(name) for i, name in ((1, "__k"), (2, "__v"))],
    )
    last = F.size("__k") - 1
    lone = F.size("__k") == 1

    def kept(key: Column, i: Column) -> Column:
        value = F.get("__v", i)
        repeated = F.exists(F.slice("__k", i + 2, F.size("__k")), lambda later: later == key)
        return ~repeated & ~((i == last) & (value == "")) & ~(lone & (F.length(key) == 1))

    # positions that survive, then both arrays in that order
    keep = F.filter(
        F.transform("__k", lambda key, i: F.when(kept(key, i), i)), lambda i: i.isNotNull()
    )
    out = with_fields(out, [keep.alias("__i")])
    keys, values = F.transform("__i", lambda i: F.get("__k", i)), F.transform("__i", lambda i: F.get("__v", i))
    out = with_fields(out, [F.map_from_arrays(keys, values).alias("__x")])
    reason = F.when(F.size("__c") != 8, F.lit("CEF field count")).when(
        F.coalesce(F.size("__x"), F.lit(0)) < 1, F.lit("CEF without extensions")
    )
    out = with_fields(out, [reason.alias("__e")])
    ok = F.col("__e").isNull()
    # a header part may itself be empty; it stays empty
    stray = F.exists("__v", lambda v: v.rlike(r"(?<!\\)="))
    columns = [
        *[F.when(ok, F.get("__c", F.lit(i + 1))).alias(name) for i, name in enumerate(CEF_COLUMNS)],
        F.when(ok, F.col("__x")).alias("Extensions"),
        F.when(ok & stray, F.lit("unescaped equals sign in a value")).alias("_warn"),
        F.col("__e").alias(error),
    ]
    return with_fields(out, columns, [c for c in df.columns if c != error])


def cef_endpoints(df: DataFrame) -> DataFrame:
    """Source and destination address of a honeypot record, null when absent or invalid."""
    return df.withColumn("src_ip", canon_ip(F.col("Extensions")["src"])).withColumn(
        "dst_ip", canon_ip(F.col("Extensions")["dst"])
    )
