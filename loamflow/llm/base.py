"""What the operators share: settled tables, running offsets, token ids of whole texts."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import zipfile
from array import array
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamflow.session import shared_folder

#: Texts are cut at a blank after this many characters before they are worked on, so that one
#: very long text does not need a list of all its words at once.
PIECE_CHARS = 1 << 20

#: Folders that ``scratch`` has named and nobody has released.
SCRATCH: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share; it is deleted when the driver ends.

    Where ``spark.checkpoint.dir`` is unset (local tests) a temporary folder is used.
    """
    folder = shared_folder(spark, "")
    if not folder:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = jvm_dir.get() if jvm_dir.isDefined() else ""
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="loamflow-")
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    SCRATCH.append(path)
    return path


def release(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders of ``scratch`` that nothing reads any more, and let Spark drop what finished jobs shuffled."""
    for path in set(paths):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        SCRATCH.remove(path)
    gc.collect()
    spark._jvm.System.gc()  # Spark's cleaner removes shuffle files once their plans are collected


def folders(df: DataFrame) -> list[str]:
    """The folders of ``scratch`` that ``df`` reads."""
    read = {part for f in df.inputFiles() for part in f.split("/")}
    return [p for p in SCRATCH if p.rsplit("/", 1)[-1] in read]


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: evaluated once, lineage cut."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_offsets(counts: DataFrame, order: str, size: str, out: str, block: int = 4096) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over all rows with a smaller ``order`` (a whole number, unique).

    In two levels, so that no task sees more than the rows of a block or one row per block.
    """
    blocked = counts.withColumn("_block", F.floor(F.col(order) / F.lit(block)).cast("long"))
    sums = blocked.groupBy("_block").agg(F.sum(size).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inner = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = blocked.withColumn("_within", F.coalesce(F.sum(size).over(inner), F.lit(0)))
    return within.join(sums, "_block").withColumn(out, F.col("_before") + F.col("_within")).drop(
        "_block", "_within", "_before"
    )


def text_key() -> Column:
    """Hash that, with ``doc_id``, names a document: rows equal in both are one document."""
    return F.xxhash64(F.col("text"))


def whole_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, in any letter case; others, whatever their names, are left behind."""
    known = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n not in known]
    if missing:
        raise ValueError(f"column(s) {missing} not found among {df.columns}")
    return df.select(*[F.col(f"`{known[n]}`").alias(n) for n in names])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it new to the columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut after blanks or line ends only."""
    start = 0
    while len(text) - start > size:
        cuts = [c for c in (text.find(" ", start + size), text.find("\n", start + size)) if c >= 0]
        if not cuts:
            break
        yield text[start:min(cuts) + 1]
        start = min(cuts) + 1
    yield text[start:] if start else text


def count_ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Sums of 255 rows fit in a byte.
    return np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, n: int) -> int:
    """SimHash of ``n`` hashes as an unsigned number: the bits that over half of them have set."""
    bits = (2 * ones > n).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


#: Letters beyond ASCII that need no normalising beyond lower case, which is among these or in the block behind (of three it is not).
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0239\u023b-\u023d\u023f-\u024f"
_PLAIN = re.compile(f"[!-~{_LETTERS}]+")
_PLAIN_LINE = re.compile(f"[ !-~{_LETTERS}]*")
#: The tokenizer's own split pattern, as it reads for plain characters in lower case.
_PARTS = re.compile(rf"[a-z{_LETTERS}\u0250-\u02af]+|[0-9]|'(?:[stmd]|re|ve|ll)|[!-/:-@\[-`{{-~]+")
#: The letters that stand for bytes in a byte-level vocabulary: visible Latin-1 characters as they are, others from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = dict(zip(sorted({*range(256)}.difference(_VISIBLE)), range(256, 512)))


class TokenIds:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and never merges across it, so the ids of a text are those
    of its chunks between blanks and line ends. Texts and chunks of plain letters and signs go to the library's model
    word by word, all other chunks through its whole chain. Each is encoded once by the library while it is remembered;
    at most ``chunk_limit`` chunks and ``limit`` words are.
    """

    def __init__(self, path: str, limit: int = 300_000, chunk_limit: int = 100_000, longest: int = 48):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of the special tokens are ordinary text inside a document.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.limit, self.chunk_limit = limit, chunk_limit
        self.words = _Remembered(self._word, limit, longest)
        self.chunks = _Remembered(self._chunk, chunk_limit, longest)
        self.chunks[""] = b""

    def __call__(self, text: str | None) -> bytes:
        return b"".join([self._piece(p) for p in pieces(text or "")])

    def _piece(self, text: str) -> bytes:
        text = text.replace("\n", " ")
        # Cleared between pieces only: within one, what is beyond the limits is encoded without being remembered.
        if len(self.words) >= self.limit:
            self.words.clear()
        if _PLAIN_LINE.fullmatch(text):
            return b"".join(map(self.words.__getitem__, _PARTS.findall(text.lower())))
        if len(self.chunks) >= self.chunk_limit:
            self.chunks.clear()
            self.chunks[""] = b""
        return b"".join(map(self.chunks.__getitem__, text.split(" ")))

    def _chunk(self, chunk: str) -> bytes:
        if not _PLAIN.fullmatch(chunk):
            return _le(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        chunk = chunk.lower()
        if chunk.isalpha():
            return self.words[chunk]
        return b"".join(map(self.words.__getitem__, _PARTS.findall(chunk)))

    def _word(self, word: str) -> bytes:
        text = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return _le([t.id for t in self.model.tokenize(text)])


class _Remembered(dict):
    """What ``encode`` gives for texts of at most ``longest`` characters, up to ``limit`` of them."""

    def __init__(self, encode: Callable[[str], bytes], limit: int, longest: int):
        super().__init__()
        self.encode, self.limit, self.longest = encode, limit, longest

    def __missing__(self, text: str) -> bytes:
        ids = self.encode(text)
        if len(text) <= self.longest and len(self) < self.limit:
            self[text] = ids
        return ids


def _le(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


_ENCODERS: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """The worker's encoder for the file at ``path``; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenIds(path)
    return _ENCODERS[path]


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Hand texts to Python in Arrow batches of about ``size`` bytes (a longer text is a batch of its own).

    Spark's own 64 MB, held by Java and Python on the way in and out in each task, are much for an executor
    whose memory is mostly heap. A limit that the session has set already stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.conf._jconf.contains(key):
        spark.conf.set(key, str(size))


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_loamflow_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="loamflow-")) / "loamflow.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._loamflow_shipped = True
