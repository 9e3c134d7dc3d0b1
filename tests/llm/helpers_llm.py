"""Inputs shared by the tests of the training-data operators."""

from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as extra columns.
CLASHES = ["_id", "_row", "_doc", "_host", "_text", "_key", "key", "node", "root", "kept", "host", "line", "item", "vector", "_size", "_n", "size",
           "n_words", "target", "copies", "_found", "_all", "rule", "_rule", "anchor", "x"]


def prose(words, n, rnd):
    return " ".join(rnd.choice(words) for _ in range(n))


def awkward_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing column names."""
    rows = [(1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 60), (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 60),
            (2, None, None, None, None), (None, "some text without an id that is long enough to be kept by the rules", "en", "b", 10), (3, "", "en", "a", 0),
            (4, " \n\t\r\x0b\x0c ", "en", "b", 6), (5, "word " * 30000, "en", "a", 150000), (6, "x" * 50000, "en", None, 50000),
            (7, "\n".join(f"line {i} of a text with e-mail u{i}@ex{i}.example.com and number {i}" for i in range(500)), "en", "a", 1),
            (None, None, None, None, None), (8, "日本語 🙂 é́   <|endoftext|> '' \"\"", "xx", "c", 5)]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHES])


def no_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
