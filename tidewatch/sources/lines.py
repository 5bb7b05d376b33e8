"""Text lines (``value``) to records: used behind files, sockets and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.event_time import with_event_time

# Field positions and time format of the web log.
LOG_FIELDS = {"ip": 0, "user_id": 1, "time": 3, "method": 5, "url": 6}
LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def parse_csv_lines(lines: DataFrame, layout: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per line; ``keep`` names source columns carried along."""
    ddl = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in layout)
    record = F.from_csv("value", ddl)
    return with_event_time(lines.select(*keep, record.alias("r")).select(*keep, "r.*"))


def rejected_csv_lines(lines: DataFrame, layout: StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """The CSV lines whose fields are too few or too many, or do not have the types of the layout, whole. What can be read
    of such a line is in ``parse_csv_lines`` all the same; blank and absent lines are rejected too."""
    broken = "_broken"
    ddl = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in layout)
    record = F.from_csv("value", f"{ddl}, {broken} string", {"columnNameOfCorruptRecord": broken})
    blank = F.coalesce(F.trim("value") == "", F.lit(True))
    rejected = lines.select(*keep, "value", record.alias("r")).where(blank | F.col(f"r.{broken}").isNotNull())
    return rejected.select(*keep, "value")


def parse_web_log(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Space separated access log; times are read in the session zone. What a
    broken line lacks is NULL; ``rejected_lines`` has such lines whole."""
    parts = F.split("value", " ")
    field = {name: F.get(parts, F.lit(at)) for name, at in LOG_FIELDS.items()}
    return lines.select(
        *keep,
        field["ip"].alias("ip"),
        field["user_id"].alias("user_id"),
        F.try_to_timestamp(field["time"], F.lit(LOG_TIME)).alias("ts"),
        field["method"].alias("method"),
        field["url"].alias("url"),
    )


def rejected_lines(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The access-log lines without a url or a time that can be read."""
    return parse_web_log(lines, (*keep, "value")).where("ts is null or url is null").select(*keep, "value")


def to_csv_lines(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Records back to lines, e.g. to publish them to a topic."""
    return df.select(*keep, F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("value"))
