from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest

from compare import bag
from loamflow import apply_drop_columns, apply_rename_columns, apply_snake_case, sql_transform
from loamflow.operators.transforms import mentions, resolve_sql


def test_snake_case_renames_all(spark):
    df = spark.createDataFrame([(1, 2.0, 3)], ["CustomerName", "CustomerAmount", "customer_id"])
    assert apply_snake_case(df).columns == ["customer_name", "customer_amount", "customer_id"]


def test_snake_case_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["customerID", "customer_id"])
    with pytest.raises(ValueError, match="customer_id"):
        apply_snake_case(df)


def test_rename_skips_missing_with_warning(spark, caplog):
    df = spark.createDataFrame([(1, 2, 3)], ["cust_id", "int_rate", "other"])
    renamed = apply_rename_columns(df, {"cust_id": "customer_id", "int_rate": "rate", "nope": "x"})
    assert renamed.columns == ["customer_id", "rate", "other"]
    assert "nope" in caplog.text


def test_drop_ignores_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["customer_id", "_corrupt_record", "name"])
    assert apply_drop_columns(df, ["_corrupt_record", "_rescued_data"]).columns == ["customer_id", "name"]
    assert apply_drop_columns(df, ["nope"]).columns == df.columns


def test_sql_file_before_query_before_default(tmp_path):
    (tmp_path / "q.sql").write_text("SELECT 1 AS file\n")
    assert resolve_sql({"sql_file": "q.sql", "query": "SELECT 2"}, str(tmp_path)) == "SELECT 1 AS file"
    assert resolve_sql({"sql_file": "", "query": " SELECT 2 "}) == "SELECT 2"
    assert resolve_sql({"sql_file": None, "query": None}) == "SELECT * FROM source"
    with pytest.raises(FileNotFoundError):
        resolve_sql({"id": "a", "sql_file": "missing.sql", "query": "SELECT 2"}, str(tmp_path))


def test_sql_text_forms(spark):
    source = spark.range(5)
    for sql in (
        "SELECT count(*) AS n FROM source;",
        "WITH x AS (SELECT * FROM source) SELECT count(*) AS n FROM x -- done",
        "SELECT count(*) AS n FROM source UNION ALL SELECT 7 WHERE false",
    ):
        assert bag(sql_transform(spark, sql, {"source": source})) == [(5,)]


def test_parallel_runs_do_not_share_source(spark):
    def count(n):
        return sql_transform(spark, "SELECT count(*) AS n FROM source", {"source": spark.range(n)}).first()["n"]

    with ThreadPoolExecutor(8) as pool:
        assert list(pool.map(count, range(1, 17))) == list(range(1, 17))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("__in_")]


def test_sql_without_source_uses_the_session(spark):
    spark.range(3).createOrReplaceTempView("plain_view")
    assert sql_transform(spark, "SELECT * FROM plain_view").count() == 3
    spark.catalog.dropTempView("plain_view")


def test_qualified_names_in_the_text(spark):
    inputs = {"raw.s.a": spark.range(3), "raw.s.ab": spark.range(5), "b": spark.range(7)}
    sql = """
    SELECT (SELECT count(*) FROM raw.s.a) AS x, (SELECT count(*) FROM `raw`.`s`.`AB`) AS y,
           (SELECT count(*) FROM RAW.S.ab) AS z, (SELECT count(*) FROM b) AS w
    """
    assert bag(sql_transform(spark, sql, inputs)) == [(3, 5, 5, 7)]
    assert mentions("FROM raw.s.a)", "raw.s.a") and not mentions("FROM raw.s.ab", "raw.s.a")
    assert not mentions("FROM x.raw.s.a", "raw.s.a") and not mentions("FROM banner", "ann")


def test_names_in_quoted_text_and_comments_stay(spark):
    source = spark.createDataFrame([(1,)], "k INT")
    sql = """SELECT k, 'raw.s.t' AS src, "it's raw.s.t" AS quoted, r'raw.s.t\\' AS raw_text -- raw.s.t
             /* raw.s.t */ FROM `raw`.s.T t WHERE t.k = 1 AND 'a\\'raw.s.t' <> ''"""
    row = sql_transform(spark, sql, {"raw.s.t": source}).first()
    assert tuple(row) == (1, "raw.s.t", "it's raw.s.t", "raw.s.t\\")
    assert sql_transform(spark, "SELECT raw.s.t.k FROM raw.s.t", {"raw.s.t": source}).first()[0] == 1


def test_every_form_of_the_current_time_is_pinned(spark):
    sql = ("SELECT current_timestamp AS a, NOW( ) AS b, current_date() AS c, Current_Date AS d, localtimestamp() AS e, curdate() AS f, "
           "k AS current_timestamp, k AS current_date, source.k, 'now()' AS now FROM source -- now()")
    row = sql_transform(spark, sql, {"source": spark.range(1).withColumnRenamed("id", "k")}, as_of=datetime(2024, 5, 6, 7, 8, 9)).first()
    assert row["a"] == row["b"] == row["e"] == datetime(2024, 5, 6, 7, 8, 9)
    assert row["c"] == row["d"] == row["f"] == datetime(2024, 5, 6).date()
    assert (row["current_timestamp"], row["current_date"], row["now"]) == (0, 0, "now()")
