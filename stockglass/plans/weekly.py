"""Weekly summary of a day's extracts."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession
from pyspark.sql.types import StructType

from stockglass.functions.weeks import DAY_OF_WEEK
from stockglass.operators.retail import weekly_summary
from stockglass.schemas import INVENTORY, SALES, as_text
from stockglass.sinks.publish import publish_archive, publish_current, register_table
from stockglass.sources.landing import landing_path, misfits, read_landing


def _counted(rows: Observation) -> int | None:
    """How many misfits were counted; None if the plan ended before the extract was read
    through, as adaptive execution sees to where the other table turns out empty."""
    try:
        return rows.get["misfits"]
    except Py4JJavaError:  # there is no count to be had
        return None


def _keep_misfits(
    spark: SparkSession, landing: str, name: str, date: str, schema: StructType, result: str, seen: int | None
) -> None:
    """Writes the misfits of an extract of which ``seen`` were counted. Only an extract that
    has some is read again, or one that was not counted: with an empty table beside it Spark
    may have had no need to read it."""
    if seen == 0:
        return
    bad = misfits(read_landing(spark, landing, name, date), schema)
    if seen or not bad.isEmpty():
        bad.write.mode("overwrite").parquet(landing_path(f"{result.rstrip('/')}/misfits", name, date))


def run_weekly(
    spark: SparkSession,
    landing: str,
    date: str,
    archive: str,
    result: str,
    *,
    files: int | None = None,
    table: str | None = None,
    week_end: str = DAY_OF_WEEK,
    compare_as_text: bool = False,
) -> str:
    """Reads inventory and sales of ``date``, archives the summary and makes it current.

    The summary is computed once: the current snapshot is read back from the
    archive. The rows whose values do not fit are counted by the same reading. ``compare_as_text`` reads the extracts as text, so that keys and
    the low-stock flag compare character by character. Else rows with a value
    that its type can't hold, which becomes null, are written to
    ``{result}/misfits/{table}_{date}.csv`` as Parquet; without any, none is. Returns
    the path of the current snapshot, registered as ``table`` if that is given.
    """
    given = {"landing": landing, "date": date, "archive": archive, "result": result}
    missing = [name for name, value in given.items() if not value]
    if missing:
        raise ValueError(f"missing: {', '.join(missing)}")
    schemas = {"sales": SALES, "inventory": INVENTORY}
    counted = {} if compare_as_text else {name: Observation() for name in schemas}
    rows = {
        name: read_landing(
            spark, landing, name, date, as_text(schema) if compare_as_text else schema, checked=counted.get(name)
        )
        for name, schema in schemas.items()
    }
    summary = weekly_summary(
        rows["sales"], rows["inventory"], compare_as_text=compare_as_text, week_end=week_end
    )
    publish_archive(summary, archive, date, files)
    for name, count in counted.items():
        _keep_misfits(spark, landing, name, date, schemas[name], result, _counted(count))
    path = publish_current(spark, archive, date, result, files)
    if table:
        register_table(spark, table, path)
    return path
