"""Sharding and chat formatting, against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamflow.llm import chat, sharding
from loamflow.llm.queries import QUERIES


def test_sharding_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op2_sharding"](spark, sf_dir).collect()
    slots = defaultdict(list)
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots[r.shard].append(r.slot)
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_sharding_keeps_every_row_and_column(awkward):
    out = sharding.shuffle_into_shards(awkward, shards=4, bucket_bytes=1000)
    rows = out.collect()
    assert sorted(repr(r.doc) for r in rows) == sorted(map(repr, awkward.collect()))
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(4) for k in range(3)][:11]


def test_sharding_is_seeded_and_mixes(documents):
    docs = documents(*[(i, f"text {i}") for i in range(400)])
    a, b, c = [
        [r.doc.doc_id for r in sharding.shuffle_into_shards(docs, 2, seed, 2000).orderBy("shard", "slot").collect()]
        for seed in (1, 1, 2)
    ]
    assert a == b != c and a != sorted(a)
    assert 60 < sum(x < 200 for x in a[:200]) < 140


def test_sharding_of_nothing(documents, tmp_path):
    assert sharding.shuffle_into_shards(documents((1, "x")).limit(0)).count() == 0


def test_written_shards(documents, tmp_path, spark):
    docs = documents(*[(i, "t") for i in range(50)])
    sharding.write_shards(sharding.shuffle_into_shards(docs, 3), f"{tmp_path}/out")
    assert [r["count"] for r in spark.read.parquet(f"{tmp_path}/out").groupBy("shard").count().orderBy("shard").collect()] == [17, 17, 16]


TURNS = "conv_id long, turn long, role string, text string"


def expected_row(turns):
    turns = sorted(turns, key=lambda t: ((t[0] is not None, t[0] or 0), t[1] or "", t[2] or ""))
    told = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in turns)
    learnt = "".join(t or "" for _, r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(told), len(learnt), sha(learnt)


def test_chat_query(spark, sf_dir):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text))
    turns[-7] = [(k, role, "\\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))]
    rows = {r.conv_id: tuple(r)[1:5] for r in QUERIES["op4_chat_format"](spark, sf_dir).collect()}
    assert rows == {k: expected_row(v) for k, v in turns.items()}


def read(spark, rows):
    frame = spark.createDataFrame(rows, TURNS).withColumn("formatted", F.lit(1)).withColumn("blocks", F.lit(2))
    return chat.read_back(chat.format_conversations(frame)).collect()


def test_same_role_turns_share_a_header(spark):
    out = read(spark, [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d")])[0]
    assert out.formatted == "### user:\na</part>b</part>c</turn>\n### assistant:\nd</turn>\n"
    assert [tuple(t) for t in out.turns] == [("user", "a"), ("user", "b"), ("user", "c"), ("assistant", "d")]
    assert out.loss_texts == ["d"]


NASTY = ["\\", "#", "###", "</turn>", "</part>", ":", "\n", "\\b", "\\t", "e", "é", "\U0001f600", "", "### assistant:\n"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from(["user", "assistant", "a:\n#"])),
    st.one_of(st.none(), st.lists(st.sampled_from(NASTY), max_size=6).map("".join)),
), min_size=1, max_size=15))
def test_any_text_reads_back(spark, rows):
    turns = defaultdict(list)
    for conv_id, *turn in rows:
        turns[conv_id].append(tuple(turn))
    for out in read(spark, rows):
        own = sorted(turns[out.conv_id], key=lambda t: ((t[0] is not None, t[0] or 0), t[1] or "", t[2] or ""))
        assert [tuple(t) for t in out.turns] == [(r or "", t or "") for _, r, t in own]
        assert out.loss_texts == [t or "" for _, r, t in own if r == "assistant"]


def test_null_conversation_and_empty_table(spark):
    assert len(read(spark, [(None, 0, None, None), (None, None, "user", "x"), (2, 0, "user", "y")])) == 2
    assert read(spark, [(1, 0, "u", "x")] * 0) == []


def test_native(spark, sf_dir):
    for name in ("op2_sharding", "op4_chat_format", "op10_quality_rules"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas")), name


@pytest.mark.parametrize("text", ["", "a", "\\", "\\\\h", "</turn></part>###:"])
def test_escape_round_trip(spark, text):
    row = spark.range(1).select(chat.escape(F.lit(text)).alias("e"), chat.unescape(chat.escape(F.lit(text))).alias("u")).first()
    assert row.u == text and not any(raw in row.e for raw, _ in chat.ESCAPES[1:])
