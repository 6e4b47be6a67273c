"""ISO dates kept as text: a date without a zone and one with a zone are different contents."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def iso_text(value: str | None) -> str | None:
    """The ISO form of a date in any ISO spelling, null otherwise; Z is +00:00."""
    try:
        return datetime.fromisoformat(value.strip().replace("Z", "+00:00")).isoformat() if value and value.strip() else None
    except ValueError:
        return None


@F.pandas_udf(StringType())
def iso_date(values: pd.Series) -> pd.Series:
    return values.map(iso_text)


def exported(value: Column) -> Column:
    """UTC is Z in exports; other offsets and dates without a zone stay."""
    return F.regexp_replace(value, r"\+00:00$", "Z")


def duration_seconds(start: Column, end: Column) -> Column:
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1e6).cast("bigint")


def instant(value: Column) -> Column:
    """A stored ISO text as an instant; a text that is none fails the job, as a damaged store should."""
    strict = F.try_to_timestamp(F.regexp_replace(value, "Z$", "+00:00"))
    return F.when(value.isNull() | strict.isNotNull(), strict).otherwise(F.raise_error(F.concat(F.lit("no ISO date: "), value)).cast("timestamp"))
