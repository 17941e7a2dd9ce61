"""The registered queries of this package, with DuckDB oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamflow.llm import (
    chat,
    decontaminate,
    langid,
    merge_pieces,
    merkle,
    packing,
    quality_rules,
    runs,
    sharding,
    simhash,
    token_store,
    toxicity,
    unit_dedup,
)
from loamflow.llm.base import scratch, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of at most 4096 tokens; a row for each piece."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer())


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt into 16 shards by a two-pass shuffle; a row for each document."""
    shuffled = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"))
    return shuffled.select(
        "doc.doc_id", "size", F.crc32(F.coalesce("doc.text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_token_store")
def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written as byte planes, and read back; a row for each document."""
    path = scratch(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, tokenizer())
    return token_store.read_store(spark, path)


#: A conversation that holds the template's own kind of control strings.
HOSTILE = r"""SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, r'\### Assistant: </turn> ok' AS text
FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"""


@query("op4_chat_format")
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as template text; digests of what reads back from it."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    read = chat.read_back(chat.format_conversations(turns.unionByName(spark.sql(HOSTILE))))
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def fold(modulus: int) -> Column:
    """Remainder of the crc32 of the id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query("op5_language_spans")
def op5_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt without the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(4) == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out))
    return langid.identify(docs, model, held_out.alias("held_out"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_unit_dedup")
def op7_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with later occurrences of repeated passages cut out, and where they lay."""
    return unit_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Trained without the held-out fold."""
    return toxicity.fit(docs, labels.filter(fold(5) != 0))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"))


@query("op9_winnowing")
def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in a window of a benchmark item."""
    found = decontaminate.match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents judged by quality rules with risk-controlled cutoffs."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_merge_pieces")
def op11_merge_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as SentencePiece ids, and decoded again; digests of both."""
    done = merge_pieces.encode_documents(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))
    return done.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees",
    )


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
#: 3988292384: fixed value, the reversed polynomial of crc32.
_CRC32 = """xor(list_reduce(
    list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
    lambda c, b: list_reduce(range(8), lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)),
    4294967295::BIGINT), 4294967295::BIGINT)"""
_RISE = """SELECT tree, lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
        FROM {level} WHERE n > 1 GROUP BY tree, lvl, n, pos // 8"""
OP12 = f"""
WITH RECURSIVE digests AS (
    SELECT doc_id, lang, sha256({_HEAD} || {_field("text")}) AS digest,
        CASE WHEN {_CRC32} % 3 = 0 THEN sha256({_HEAD} ||
            {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS altered
    FROM documents
), leaves AS (
    SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM digests
), inside(tree, lvl, pos, digest, n) AS (
    SELECT tree, 0, pos, digest, n FROM leaves
    UNION ALL {_RISE.format(level="inside")}
), subroots AS (
    SELECT tree, digest FROM inside WHERE n = 1
), above(tree, lvl, pos, digest, n) AS (
    SELECT -1, 0, tree, digest, count(*) OVER () FROM subroots
    UNION ALL {_RISE.format(level="above")}
), runs AS (
    SELECT tree, lvl, pos // 8 AS up, n, list(digest ORDER BY pos) AS members
    FROM (SELECT * FROM inside UNION ALL SELECT * FROM above) GROUP BY tree, lvl, pos // 8, n
), climb(leaf_tree, leaf_pos, tree, lvl, pos, folded, proof) AS (
    SELECT tree, pos, tree, 0, pos, coalesce(altered, digest), '' FROM leaves
    UNION ALL
    SELECT leaf_tree, leaf_pos, CASE WHEN r.n = 1 THEN -1 ELSE c.tree END, CASE WHEN r.n = 1 THEN 0 ELSE c.lvl + 1 END,
        CASE WHEN r.n = 1 THEN c.tree ELSE c.pos // 8 END,
        CASE WHEN r.n = 1 THEN folded ELSE sha256(array_to_string(members[:c.pos % 8], '') || folded
            || array_to_string(members[c.pos % 8 + 2:], '')) END,
        proof || CASE WHEN r.n = 1 THEN '' ELSE array_to_string(members[:c.pos % 8], '')
            || array_to_string(members[c.pos % 8 + 2:], '') END
    FROM climb c JOIN runs r ON r.tree = c.tree AND r.lvl = c.lvl AND r.up = c.pos // 8
    WHERE r.n > 1 OR c.tree >= 0
)
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, a.digest AS root, sha256(c.proof) AS proof_sha256,
    c.folded AS folded_root, c.folded = a.digest AS verified
FROM climb c JOIN above a ON a.n = 1 AND c.tree = -1 AND c.lvl = a.lvl
JOIN leaves l ON l.tree = c.leaf_tree AND l.pos = c.leaf_pos JOIN subroots s ON s.tree = l.tree
"""


@query("op12_merkle", OP12)
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as leaves of a Merkle tree; each proved against the root, a part of them tampered with."""
    proved = merkle.prove(table(spark, sf_dir, "documents"))
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


WORDS = r"[^\x20\x09-\x0D]+"


def with_planted_run(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten, by the crc32 of its id, repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size("words").cast("long")
    cut = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORDS), F.lit(0))).alias("words"))
    a = (g % n).cast("int")
    period = (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")
    placed = cut.withColumn("a", F.when(n > 0, a)).withColumn("p", period)
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    words = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), (n - F.col("a")).cast("int")))
    return placed.select("doc_id", F.coalesce(F.array_join(words, " "), F.col("text")).alias("text"))


@query("op13_runs")
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic stretches of words of all documents, a part of them planted, and the texts without the repetitions."""
    found = runs.find_runs(with_planted_run(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # Exact comparison of fractions: the greater one has the greater product across.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda m, r: F.when(
        r["length"] * m["period"] > m["length"] * r["period"], r).otherwise(m))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
