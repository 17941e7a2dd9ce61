"""The benchmark is read block by block, without its repeated rows."""

from loamflow.llm import decontaminate


def test_repeated_items_are_read_once_and_a_block_at_a_time(spark, monkeypatch):
    items = [(i, f"item {i} " + "word " * 30) for i in range(8) for _ in range(50)]
    found = list(decontaminate.blocks(spark.createDataFrame(items, "item_id long, text string"), 400))
    assert sorted(i for block, _ in found for i, _ in block) == sorted(str(i) for i in range(8))
    assert [last for _, last in found] == [False] * (len(found) - 1) + [True]

    log, real, settled = [], decontaminate.blocks, decontaminate.settle
    monkeypatch.setattr(decontaminate, "blocks", lambda *a: ((log.append("block"), x)[1] for x in real(*a)))
    monkeypatch.setattr(decontaminate, "settle", lambda df, name: (log.append(name), settled(df, name))[1])
    docs = spark.createDataFrame([(1, items[0][1]), (2, "clean")], "doc_id long, text string")
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), 400)
    assert [r.doc_id for r in kept.collect()] == [2]
    assert log == ["benchmark", *["block", "decontaminated"] * (len(found) - 1), "block"]
