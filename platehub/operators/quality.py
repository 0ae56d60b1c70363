"""Data-quality operators: required-field split (P7), alias resolution (P8),
optional-field defaults (P6) and sentinel masking (P11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_required(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, quarantine).  Quarantined rows get
    ``missing``: the comma-joined names of their NULL required columns.

    Where the original aborted the whole read on one bad row, we keep
    going and route the row aside, so a single bad record cannot fail a
    100 TB job; callers that want the abort use :func:`assert_required`.
    """
    missing = F.concat_ws(
        ",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    )
    tagged = df.withColumn("missing", missing)
    return tagged.where(F.col("missing") == "").drop("missing"), tagged.where(F.col("missing") != "")


def assert_required(df: DataFrame, required: list[str]) -> DataFrame:
    """Fail the job on the first row with a NULL required column."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    # inside a filter, so column pruning cannot remove the check
    # (assert_true yields NULL when the condition holds)
    return df.where(F.assert_true(cond, "required field is NULL").isNull())


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Optional fields: NULL -> default ('' for text, 0 for numbers)."""
    return df.select(
        *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns]
    )


def resolve_aliases(df: DataFrame, aliases: dict[str, tuple[str, ...]], by: str = "value") -> DataFrame:
    """Resolve each target column from a list of candidate source names.

    ``by="header"``: the first alias present in the schema wins.
    ``by="value"``: per row, the first present alias holding a non-NULL value
    wins (``coalesce``).  A target with no present alias is an error.
    """
    out = []
    for target, names in aliases.items():
        present = [n for n in names if n in df.columns]
        if not present:
            raise KeyError(f"no column found for any alias of {names!r}")
        if by == "header":
            out.append(F.col(present[0]).alias(target))
        else:
            out.append(F.coalesce(*[F.col(n) for n in present]).alias(target))
    return df.select(*out)


# Fixed value: the "still active" date sentinel.
SENTINEL = _dt.datetime(1900, 1, 1)
DISPLAY_FMT = "yyyy-MM-dd HH:mm:ss"


def mask_sentinel(df: DataFrame, as_text: bool = True, placeholder: str = "--") -> DataFrame:
    """Replace the 1900-01-01 sentinel in every timestamp/date column.

    ``as_text``: render timestamps as text with the sentinel shown as
    ``placeholder``; otherwise the sentinel becomes NULL and types stay.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.col(f.name)
            is_sent = c.cast("timestamp_ntz") == F.lit(SENTINEL).cast("timestamp_ntz")
            if as_text:
                cols.append(
                    F.when(is_sent, F.lit(placeholder)).otherwise(F.date_format(c, DISPLAY_FMT)).alias(f.name)
                )
            else:
                cols.append(F.when(is_sent, F.lit(None)).otherwise(c).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
