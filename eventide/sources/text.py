"""Text sources: one record per line, delimited parsing into readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.scalar import java_split


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """``value string`` per line; ``stream=True`` gives a file stream that
    picks up new files in ``path`` (the socket source's test stand-in)."""
    if stream:
        return spark.readStream.format("text").load(path)
    return spark.read.text(path)


def text_lines(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Cut a text column into lines the way a line-oriented file reader
    does: split on ``\\n``, drop one trailing ``\\r``, and no empty record
    after a final newline."""
    t = F.col(text_col)
    body = F.when(t.endswith("\n"), F.expr(f"substring(`{text_col}`, 1, length(`{text_col}`) - 1)")).otherwise(t)
    lines = F.split(body, "\n", -1)
    out = df.select(*[F.col(k) for k in keep], F.posexplode(lines).alias("line_no", "line"))
    line = F.col("line")
    return out.withColumn("line", F.when(line.endswith("\r"), F.expr("substring(line, 1, length(line) - 1)"))
                          .otherwise(line))


def parse_readings(lines: DataFrame, value_col: str = "value",
                   epoch_unit: str = "seconds", strict: bool = True,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``"id,epoch,temperature"`` lines → ``(id, ts, temperature)``.

    Whitespace around fields is kept off; with ``strict`` a bad number fails
    the job (ANSI cast) as a typed parser would, otherwise it becomes NULL.
    """
    parts = java_split(F.col(value_col), ",")
    cast = (lambda c, t: c.cast(t)) if strict else (lambda c, t: c.try_cast(t))
    epoch = cast(F.trim(parts.getItem(1)), "bigint")
    if epoch_unit == "seconds":
        ts = F.timestamp_seconds(epoch)
    elif epoch_unit == "millis":
        ts = F.timestamp_millis(epoch)
    else:
        raise ValueError(epoch_unit)
    return lines.select(
        *keep,
        F.trim(parts.getItem(0)).alias("id"),
        ts.cast("timestamp_ntz").alias("ts"),
        cast(F.trim(parts.getItem(2)), "double").alias("temperature"),
    )
