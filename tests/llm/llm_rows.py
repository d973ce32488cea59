"""Edge rows that every operator is given."""

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while many other animals look on and wonder what it is all about"

TEXTS = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, None, None), (4, "", "en", ""), (5, " \t\n\x0b\x0c\r ", "en", "b"),
    (6, LONG, "de", "b"), (7, "one", "xx", None), (8, "é ñ 日本 \U0001f600 Straße", "ja", "c"), (None, PROSE + " again", "en", "a"),
    (None, None, None, None), (1, PROSE, "en", "a"), (9, "a b\nc d\na b\n\nc d", "fr", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


def docs(spark, rows=TEXTS):
    return spark.createDataFrame(rows, SCHEMA)


def clash(df, *names):
    """``df`` with further columns of the given names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(f"mine-{n}") for n in names})
