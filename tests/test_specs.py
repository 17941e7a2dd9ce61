import csv

import pytest

from loamflow.schemas import SPEC_COLUMNS
from loamflow.sources import specs


def write_csv(path, rows, columns=SPEC_COLUMNS):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.DictWriter(handle, columns)
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


ROW = {
    "id": " a1 ", "source_catalog": "raw", "source_schema": "s", "source_table": "t", "target_catalog": "c",
    "target_schema": "s", "target_table": "t", "pk": "a| b |", "load_strategy": "MERGE", "load_type": "weekly",
    "query": 'SELECT a, concat(b, \',\', "x") AS b, c\nFROM source', "run_optimize": "TRUE ", "processed": "",
}


def test_csv_rows_are_normalised(spark, tmp_path):
    path = write_csv(tmp_path / "specs.csv", [ROW, {"id": "a2", "load_type": "Full_Refresh", "processed": "true"}])
    first, second = specs.load_specs(spark, path).orderBy("id").collect()
    assert first["id"] == "a1" and first["pk"] == ["a", "b"] and first["load_strategy"] == "merge"
    assert first["load_type"] == "incremental" and first["run_optimize"] is True and first["processed"] is False
    assert first["query"] == ROW["query"] and first["sql_file"] == ""
    assert (first["source_name"], first["target_name"]) == ("raw.s.t", "c.s.t")
    assert second["load_type"] == "full_refresh" and second["pk"] == [] and second["source_name"] == ""
    assert second["load_strategy"] == "merge" and second["processed"] is True
    assert [r["id"] for r in specs.load_specs(spark, path, ids=["a2"]).collect()] == ["a2"]


def test_config_table_before_csv(spark, tmp_path):
    path = write_csv(tmp_path / "specs.csv", [ROW])
    table = spark.createDataFrame([("stored", " a|b")], "id STRING, pk STRING")
    (row,) = specs.load_specs(spark, path, config=table).collect()
    assert row["id"] == "stored" and row["pk"] == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        specs.load_specs(spark, str(tmp_path / "missing.csv"))


def spec(**changes):
    base = {
        "id": "x", "target_table": "t", "load_strategy": "append", "pk": [], "run_data_quality": False,
        "dq_config_path": "", "load_type": "incremental", "watermark_column": "", "source_name": "a.b.c",
    }
    return {**base, **changes}


@pytest.mark.parametrize(
    "changes, problem",
    [
        ({}, None),
        ({"load_strategy": "merge", "pk": ["a"]}, None),
        ({"load_strategy": "merge"}, "requires pk"),
        ({"load_strategy": "scd2"}, "requires pk"),
        ({"load_strategy": "replace"}, "unknown load_strategy"),
        ({"run_data_quality": True}, "dq_config_path"),
        ({"load_strategy": "overwrite", "watermark_column": "ts"}, "newest part"),
        ({"load_strategy": "overwrite", "watermark_column": "ts", "load_type": "full_refresh"}, None),
        ({"target_table": ""}, "target_table"),
    ],
)
def test_spec_problems(changes, problem):
    found = specs.spec_problems(spec(**changes))
    assert found == [] if problem is None else any(problem in f for f in found)
