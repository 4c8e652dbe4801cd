"""Landing of raw slices: one delimited file per survey table and year, under the names the readers know."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municipia import schemas


def slice_lines(rows: DataFrame, line: Column | None = None, keys: Sequence[str] = ("survey_table", "slice_year")) -> DataFrame:
    """The lines of every slice, its header first: ``keys``, position, line. ``rows`` has the raw columns as text; ``line`` may replace a row's text."""
    names = schemas.RAW_SLICE_SCHEMA.names
    text = F.concat_ws(";", *[F.coalesce(F.col(c), F.lit("")) for c in names]) if line is None else line
    body = rows.select(*keys, F.lit(1).alias("position"), text.alias("line"))
    heads = rows.select(*keys).distinct().select(*keys, F.lit(0).alias("position"), F.lit(";".join(names)).alias("line"))
    return heads.unionByName(body)


def land_slices(lines: DataFrame, folder: str, suffix: str = "", age_seconds: int = 0) -> int:
    """Write slices as ``ppm_<table>_<year><suffix>.csv`` into ``folder`` and return their number; ``age_seconds`` dates the files back.

    A slice is what the survey's service sends in one answer, so one task writes it. Files get their names at the end, one by one, when all are complete.
    """
    spark = lines.sparkSession
    staged = f"{folder}-landing-{uuid.uuid4().hex}"
    ordered = lines.repartition("survey_table", "slice_year").sortWithinPartitions("survey_table", "slice_year", "position", "line")
    ordered.select("survey_table", "slice_year", "line").write.partitionBy("survey_table", "slice_year").text(staged)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(folder)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target)
    landed = files.globStatus(hadoop.Path(f"{staged}/survey_table=*/slice_year=*/part-*"))
    for status in landed:
        path = status.getPath()
        year, table = (p.split("=")[1] for p in (path.getParent().getName(), path.getParent().getParent().getName()))
        named = hadoop.Path(target, f"ppm_{table}_{year}{suffix}.csv")
        if not files.rename(path, named):
            raise FileExistsError(named.toString())
        if age_seconds:
            files.setTimes(named, status.getModificationTime() - 1_000 * age_seconds, -1)
    return len(landed)
