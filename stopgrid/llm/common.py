"""What the operators share: normalisation and row identity."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows that a Python worker gets at once at most, as texts may be long.
BATCH_ROWS = 2000
#: Bytes of a batch that holds more than one row.
BATCH_BYTES = "8m"


def small_batches() -> None:
    """Lowers the session's limits of an Arrow batch, for functions over whole texts."""
    spark, name = SparkSession.active(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Pure ASCII texts take the cheap way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
