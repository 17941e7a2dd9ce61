from compare import bag
from loamflow import BulkTransformEngine, incremental_stream
from test_runner import quality_spec, rows, spec
from test_specs import write_csv


def start(eng, spark, spec_id, folder):
    (wanted,) = eng.load_transforms([spec_id])
    stream = spark.readStream.schema("k INT, v STRING, ts TIMESTAMP_NTZ").parquet(str(folder))
    incremental_stream(eng, wanted, stream, str(folder) + f"-checkpoint-{spec_id}").awaitTermination()


def test_stream_equals_batch(spark, tmp_path):
    specs = [spec("m"), spec("a", load_strategy="append")]
    path = write_csv(tmp_path / "specs.csv", specs)
    eng = BulkTransformEngine(spark, str(tmp_path / "lake"), csv_path=path)
    folder = tmp_path / "in"
    rows(spark, (1, "a", 1), (2, "b", 2)).write.mode("append").parquet(str(folder))
    for id_ in ("m", "a"):
        start(eng, spark, id_, folder)
    rows(spark, (2, "b2", 3), (3, "c", 1)).write.mode("append").parquet(str(folder))
    for id_ in ("m", "a"):
        start(eng, spark, id_, folder)
        start(eng, spark, id_, folder)  # nothing new: no batch, no rows
    assert bag(eng.warehouse.read("lake.trusted.m").select("k", "v")) == [(1, "a"), (2, "b2"), (3, "c")]
    assert bag(eng.warehouse.read("lake.trusted.a").select("k", "v")) == [(1, "a"), (2, "b"), (2, "b2"), (3, "c")]


def test_new_checkpoint_loads_again(spark, tmp_path):
    path = write_csv(tmp_path / "specs.csv", [spec("a", load_strategy="append")])
    eng = BulkTransformEngine(spark, str(tmp_path / "lake"), csv_path=path)
    folder = tmp_path / "in"
    rows(spark, (1, "a", 1)).write.parquet(str(folder))
    (wanted,) = eng.load_transforms()
    for checkpoint in ("one", "one", "two"):
        stream = spark.readStream.schema("k INT, v STRING, ts TIMESTAMP_NTZ").parquet(str(folder))
        incremental_stream(eng, wanted, stream, str(tmp_path / checkpoint)).awaitTermination()
    assert eng.warehouse.read("lake.trusted.a").count() == 2


def test_repeated_batch_is_published_once(spark, tmp_path):
    path = write_csv(tmp_path / "specs.csv", [spec("a", load_strategy="append")])
    eng = BulkTransformEngine(spark, str(tmp_path / "lake"), csv_path=path)
    (wanted,) = eng.load_transforms()
    batch = rows(spark, (1, "a", 1))
    for _ in range(2):
        assert eng.run_spec(wanted, "a-batch-0", source=batch).status == "SUCCESS"
    assert eng.warehouse.read("lake.trusted.a").count() == 1


def test_halted_batch_stops_the_stream(spark, tmp_path):
    import pytest
    from test_runner import RULES

    path = write_csv(tmp_path / "specs.csv", [quality_spec("q", load_strategy="append")])
    eng = BulkTransformEngine(spark, str(tmp_path / "lake"), csv_path=path, documents={"rules.json": RULES})
    folder = tmp_path / "in"
    rows(spark, (1, None, 1)).write.parquet(str(folder))
    with pytest.raises(Exception, match="failed the rules"):
        start(eng, spark, "q", folder)
    assert not eng.warehouse.exists("lake.trusted.q") and eng.warehouse.read("quality.rejects").count() == 1
