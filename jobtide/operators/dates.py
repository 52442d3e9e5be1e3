"""Dates in a format that is inferred for each source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.functions.text import nonempty, strip

#: Formats that are tried, in this order.
FORMATS = (
    "yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd.MM.yyyy", "yyyy/MM/dd", "dd-MM-yyyy", "d MMMM yyyy", "d MMM yyyy",
    "MMMM d, yyyy", "MMM d, yyyy",
)


def infer_dates(
    df: DataFrame, text: str, source: str, formats: Sequence[str] = FORMATS, out: str = "parsed"
) -> DataFrame:
    """The rows with a date, read in the one format that reads most texts of their source.

    All rows of a source vote, in one aggregate.  Formats that read equally many are told apart only if
    they disagree on some text: then the source is undecidable, and its dates are null.  A text that the
    format of its source does not read is null.  Rows without a source are one source.
    """
    trimmed = nonempty(strip(text))
    read = [F.try_to_timestamp(trimmed, F.lit(f)).cast("date") for f in formats]
    rows = df.withColumn("_dates", F.array(*read))
    date = [F.get("_dates", F.lit(i)) for i in range(len(formats))]
    pairs = [(i, j) for i in range(len(formats)) for j in range(i + 1, len(formats))]
    votes = rows.groupBy(source).agg(
        F.array(*[F.count(d) for d in date]).alias("_votes"),
        F.array(*[F.count_if(date[i] != date[j]) for i, j in pairs]).alias("_conflicts"),
    )
    most = F.array_max("_votes")
    wins = [(F.get("_votes", F.lit(i)) == most) & (most > 0) for i in range(len(formats))]
    torn = F.lit(False)
    for k, (i, j) in enumerate(pairs):
        torn = torn | (wins[i] & wins[j] & (F.get("_conflicts", F.lit(k)) > 0))
    chosen = F.coalesce(*[F.when(win, F.lit(i)) for i, win in enumerate(wins)])
    votes = votes.select(F.col(source).alias("_source"), F.when(~torn, chosen).alias("_format"))
    found = rows.join(votes, F.col(source).eqNullSafe(F.col("_source")), "left")
    return found.withColumn(out, F.get("_dates", F.col("_format"))).drop("_dates", "_source", "_format")
