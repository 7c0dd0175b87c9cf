"""Reading a log position out of a dump comment line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the two statement names a dump may use
STATEMENTS = ("CHANGE MASTER TO", "CHANGE REPLICATION SOURCE TO")


def is_coordinate_line(line: Column) -> Column:
    return F.contains(line, F.lit(STATEMENTS[0])) | F.contains(line, F.lit(STATEMENTS[1]))


def coordinate(line: Column) -> Column:
    """``struct(log_file, log_pos)``, or NULL when the line lacks either part."""
    name = F.regexp_extract(line, r"LOG_FILE\s*=\s*'?([^',;]*)", 1)
    pos = F.regexp_extract(line, r"LOG_POS\s*=\s*(\d+)", 1)
    found = F.struct(F.trim(name).alias("log_file"), F.try_to_number(pos, F.lit("9" * 19)).cast("bigint").alias("log_pos"))
    return F.when((F.trim(name) != "") & (pos != ""), found)
