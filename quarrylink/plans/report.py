"""The report: two sheets, as frames and as a workbook; diagnostics as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cell_text, cell_time
from ..operators.relational import numbered
from ..sources.workbook import write_workbook

#: The columns of the two sheets and their widths.
CLASSIFY = ("TimelineName", "TaskRowId", "TaskCode", "TaskName", "WbsName", "TaskClass", "TaskClassConfidence", "TaskClassReason")
LINKED = (*CLASSIFY, "LinkRank", "LinkReason", "MdrDocumentTitle", "DocumentRaciTitle", "TaskStartDate", "TaskFinishDate", "TaskActualStartDate", "TaskActualFinishDate")
CLASSIFY_WIDTHS = (6, 30, 10, 16, 58, 40, 12, 14, 60)
LINKED_WIDTHS = (6, 28, 10, 16, 44, 30, 12, 14, 42, 9, 52, 42, 38, 18, 18, 18, 18)
SHEETS = ("Task + Classify", "ENG_DOC Full")
FILLS = {"ENG_DOC": "E2EFDA", "OTHER": "F2F2F2"}
TASK = ("TimelineName", "TaskRowId")


def _cells(df: DataFrame, columns) -> DataFrame:
    kinds = dict(df.dtypes)
    shown = {"string": cell_text, "timestamp_ntz": cell_time, "timestamp": cell_time}
    return df.select("#", *(shown.get(kinds[c], lambda x: x)(F.col(c)).alias(c) for c in columns))


def task_sheet(view: DataFrame) -> DataFrame:
    """One row for each task, numbered."""
    first = view.select(*CLASSIFY).dropDuplicates(list(TASK))
    return _cells(numbered(first, [F.asc_nulls_last(c) for c in TASK]), CLASSIFY)


def link_sheet(view: DataFrame) -> DataFrame:
    """Tasks that progress documents, one row for each link, or one without any."""
    rows = view.where("TaskClass = 'ENG_DOC'")
    return _cells(numbered(rows, [F.asc_nulls_last(c) for c in (*TASK, "LinkRank")]), LINKED)


def totals(view: DataFrame) -> DataFrame:
    """Link rows, tasks, tasks of each class, and tasks with links."""
    one = view.groupBy(*TASK).agg(F.first("TaskClass").alias("kind"), F.max("ResolverLinkCount").alias("n"), F.count("*").alias("own"))
    return one.agg(
        F.count("*").alias("tasks"), F.count_if(F.col("kind") == "ENG_DOC").alias("eng_doc"), F.count_if(F.col("kind") == "OTHER").alias("other"),
        F.count_if(F.col("n") > 0).alias("linked"), F.coalesce(F.sum("own"), F.lit(0)).alias("rows"),
    )


def write(view: DataFrame, path: str) -> None:
    """The workbook of both sheets; its rows come to the driver, as a person is to read them."""
    sheets = {}
    for name, frame, widths in zip(SHEETS, (task_sheet(view), link_sheet(view)), (CLASSIFY_WIDTHS, LINKED_WIDTHS), strict=True):
        sheets[name] = (frame.columns, [tuple(r) for r in frame.orderBy("#").collect()], widths)
    write_workbook(path, sheets, FILLS)


def write_by_timeline(view: DataFrame, folder: str) -> None:
    """The task sheet as CSV, a folder for each timeline, written by the executors."""
    task_sheet(view).write.mode("overwrite").partitionBy("TimelineName").option("header", True).csv(folder)


def write_csv(rows: DataFrame, folder: str) -> bool:
    """Rows as CSV with a header; nothing is written for no rows."""
    if rows.isEmpty():
        return False
    rows.write.mode("overwrite").option("header", True).csv(folder)
    return True
