"""CSV out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F


def export_csv(
    df: DataFrame,
    path: str,
    *,
    single_file: bool = False,
    order_by: Sequence[str] = (),
    unnamed: str | None = None,
    known_rows: bool = False,
) -> int:
    """Writes rows under a header line and returns their number.

    Nothing is written for an empty result. Blanks around values survive and
    quotes are doubled. ``single_file`` puts everything into one task, so it is
    only for results known to be small; ``order_by`` sorts that file. The
    header of column ``unnamed`` is left empty. ``known_rows`` says that there are
    rows, which saves looking for one first.
    """
    if not known_rows and df.isEmpty():
        return 0
    written = Observation()
    out = df
    if single_file:
        out = out.repartition(1)
        if order_by:
            out = out.sortWithinPartitions(*order_by)
    out = out.observe(written, F.count(F.lit(1)).alias("rows"))
    if unnamed is not None:
        out = out.withColumnRenamed(unnamed, "")
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return written.get["rows"]
