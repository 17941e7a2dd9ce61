import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, lang) rows."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture
def awkward(documents):
    """Null and empty texts, blanks, a null id, repeated rows, a repeated id, an extra column whose name clashes."""
    frame = documents(
        (1, "one two three"), (1, "one two three"), (1, "another text"), (2, None), (3, ""), (4, " \n\t "),
        (None, "no id here"), (None, None), (5, "Ünïcödé \U0001f600 текст 文字 <|endoftext|> \x1c x"), (6, "word " * 30_000),
        (7, None, None),
    )
    return frame.withColumns({name: F.lit(1) for name in CLASHING})


#: Names that the operators use themselves.
CLASHING = [
    "start", "length", "shard", "slot", "size", "bucket", "removed", "score", "fp", "root", "unit", "words", "kept",
    "stratum", "level", "hits", "items", "window", "part", "nth", "text_key", "fingerprint", "doc", "at", "_of", "_key",
    "gone_id", "gone_key",
]
