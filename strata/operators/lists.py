"""Text lists of a group (AGG8) in pieces of bounded size.

``string_agg`` makes one row per group, however many entries it has.  Here equal entries
are counted first, so a hot group is a few (value, number) runs; runs are placed by the
characters before them, cut where a piece is full, and a piece's text is made from its
runs only when it is written.  Pieces in order, joined by the separator, are the list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import running_sum


def list_pieces(df: DataFrame, key: str, value: str, separator: str = ", ", piece_chars: int = 1 << 20, n_parts: int | None = None) -> DataFrame:
    """(key, piece, runs): the non-NULL values of each key in order, as runs of (value, n).

    An entry is in the piece in which it begins, so a piece's text is at most
    ``piece_chars`` and one entry long.  A key without values has no row.
    """
    runs = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    width = (F.length(value) + F.lit(len(separator))).cast("long")
    placed = running_sum(runs.withColumn("_chars", F.col("_n") * width), [key], [(value, True)], "_chars", "_at", n_parts)
    first, last = F.col("_at"), F.col("_at") + (F.col("_n") - 1) * width
    pieces = F.sequence(F.floor(first / piece_chars), F.floor(last / piece_chars))
    cut = placed.select("*", F.explode(pieces).alias("piece"))
    # entries of the run that begin before the piece, and before the next one
    begun = lambda piece: F.least(F.greatest(F.ceil((piece * piece_chars - F.col("_at")) / width), F.lit(0)), F.col("_n"))
    counted = cut.withColumn("_held", (begun(F.col("piece") + 1) - begun(F.col("piece"))).cast("long")).filter("_held > 0")
    listed = F.sort_array(F.collect_list(F.struct(F.col(value).alias("value"), F.col("_held").alias("n"))))
    return counted.groupBy(key, "piece").agg(listed.alias("runs"))


def rendered(pieces: DataFrame, separator: str = ", ") -> DataFrame:
    """``pieces`` with their text in place of the runs."""
    entries = F.flatten(F.transform("runs", lambda r: F.array_repeat(r["value"], r["n"].cast("int"))))
    return pieces.withColumn("text", F.array_join(entries, separator)).drop("runs")
