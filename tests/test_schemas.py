from quarrylink.sources import schemas

COUNTS = {"TimelineTasksClassified": 20, "TimelineTaskEmbeddings": 11, "TimelineMdrCandidateEmbeddings": 23, "TimelineTaskToMdrCandidates": 22, "TimelineTaskToMdrLinks": 28}


def test_columns():
    assert {t: len(schemas.columns(t)) for t in schemas.TABLES} == COUNTS


def test_ddl_creates_comments_defaults_and_missing_columns(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS ddl_test LOCATION '{tmp_path}/db'")
    try:
        spark.sql("CREATE TABLE ddl_test.TimelineTaskToMdrLinks (TimelineName string) USING parquet")
        schemas.create(spark, "ddl_test")
        schemas.create(spark, "ddl_test")
        for table, n in COUNTS.items():
            assert len(spark.table(f"ddl_test.{table}").columns) == n
        comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE ddl_test.TimelineTaskEmbeddings").collect()}
        assert comments["TextHash"] == "Text hash"
        spark.sql("INSERT INTO ddl_test.TimelineTaskEmbeddings (TimelineName, TaskRowId) VALUES ('t', 1)")
        row = spark.table("ddl_test.TimelineTaskEmbeddings").first()
        assert row.CreatedAt is not None and row.TextHash is None
    finally:
        spark.sql("DROP SCHEMA ddl_test CASCADE")


def test_conform_casts_and_fills(spark):
    df = spark.createDataFrame([("t", "7", "01-Jan-24 A", "2024-01-02")], "TimelineName string, TaskRowId string, TaskStartDate string, TaskFinishDate string")
    row = schemas.conform(df, "TimelineTasksClassified").first()
    assert (row.TaskRowId, row.TaskStartDate, row.TaskFinishDate.day, row.TaskCode) == (7, None, 2, None)
