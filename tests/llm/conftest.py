import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
CLASHING = ["id", "text_hash", "row", "_id", "_hash", "key", "content", "score", "kept", "ids", "n_tokens", "host", "_w", "path", "start"]


@pytest.fixture(scope="session")
def odd(spark):
    """NULL ids and texts, empty and very long texts, repeated rows, and columns named like those inside the operators."""
    rows = [
        (1, "A short text of a few words only."), (1, "A short text of a few words only."), (2, None), (2, None), (3, ""), (None, "No id here but words."),
        (None, None), (4, LONG), (5, LONG), (6, " \t\n  "), (7, "ünïcödé 漢字 \U0001F600 é <|endoftext|> </s>"),
    ]
    df = spark.createDataFrame([(i, t, "en" if t else None) for i, t in rows], "doc_id long, text string, lang string")
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])
