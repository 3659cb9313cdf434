"""Tasks of schedules: the task sheet joined with the breakdown structure, with dates and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DATE_ALIASES, date_fields, first_in_cells, parse_time
from ..functions.text import column_name, extract_project_code
from .workbook import sheet_rows

TASK_SHEET, WBS_SHEET = "TASK", "PROJWBS"
WBS_COLUMNS = ("wbs_id", "wbs_name", "wbs_short_name")


def normalised_cells(cells: Column) -> Column:
    """The cells under normalised names; of equal names the last in order counts."""
    pairs = F.transform(F.map_entries(cells), lambda e: F.struct(column_name(e["key"]).alias("key"), e["value"].alias("value")))
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))


def tasks(sheet: DataFrame, wbs: DataFrame | None) -> DataFrame:
    """One row for each task row of ``(timeline, row_idx, cells)``, with its structure's name.

    A breakdown id that occurs twice counts once, by its least name, so that a task stays one row and its
    id is its place in the file. Without a breakdown sheet, or without an id, the name is empty.
    """
    rows = sheet.where("cells is not null").withColumn("n", normalised_cells(F.col("cells")))
    get = lambda name: F.try_element_at("n", F.lit(name))
    rows = rows.select(
        F.col("timeline").alias("TimelineName"), extract_project_code(F.col("timeline")).alias("ProjectCode"), F.col("row_idx").alias("TaskRowId"),
        get("task_code").alias("TaskCode"), get("task_name").alias("TaskName"), get("wbs_id").alias("_wbs"),
        *(first_in_cells(F.col("n"), a).alias(f"_{t}") for t, a in DATE_ALIASES.items()), date_fields(F.col("cells")).alias("TaskDateFieldsJson"),
    )
    if wbs is not None:
        w = F.col("cells")
        names = wbs.where("cells is not null").groupBy(F.col("timeline").alias("TimelineName"), F.try_element_at(w, F.lit("wbs_id")).alias("_wbs")).agg(F.min(F.try_element_at(w, F.lit("wbs_name"))).alias("WbsName"))
        rows = rows.join(names, ["TimelineName", "_wbs"], "left")
    else:
        rows = rows.withColumn("WbsName", F.lit(None).cast("string"))
    date = lambda name: parse_time(F.col(f"_{name}"))
    return rows.select(
        "TimelineName", "ProjectCode", "TaskRowId", "TaskCode", "TaskName", F.coalesce("WbsName", F.lit("")).alias("WbsName"),
        date("task_start_date").alias("TaskStartDate"), date("task_finish_date").alias("TaskFinishDate"),
        date("task_actual_start_date").alias("TaskActualStartDate"), date("task_actual_finish_date").alias("TaskActualFinishDate"), "TaskDateFieldsJson",
    )


def load_tasks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(tasks, problems) of all workbooks in a folder; files that can't be read are problems, not failures."""
    sheet = sheet_rows(spark, folder, TASK_SHEET)
    named = F.exists(F.map_keys("cells"), lambda k: column_name(k) == "task_name")
    has = sheet.where("cells is not null").groupBy("timeline").agg(F.max(named).alias("named"))
    lacking = has.where(~F.col("named")).select("timeline", F.lit("the sheet TASK has no column task_name").alias("error"))
    good = sheet.join(has.where("named").select("timeline"), "timeline", "left_semi")
    problems = sheet.where("error is not null").select("timeline", "error").unionByName(lacking)
    return tasks(good, sheet_rows(spark, folder, WBS_SHEET, WBS_COLUMNS)), problems
