"""Small tables with the awkward rows: nulls, empty and long texts, ties, repeats, clashing names."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BASE = " ".join(f"word{k % 97} alpha{k % 31}" for k in range(120))
ODD = [
    (1, BASE, "en", "a", 1), (2, BASE, "en", "a", 1), (2, BASE, "en", "a", 1), (3, None, None, None, None), (4, "", "en", "b", 0), (5, " \n\t ", "en", None, 3), (None, "no id here at all", "en", "a", 1),
    (7, "x" * 200_000, "en", "c", 1), (8, "long " * 60_000, "en", "c", 1), (9, BASE.replace("word5 ", "changed "), "en", "b", 1), (10, "été ß İ 日本 😀 don't <|endoftext|> 're", "fr", "ü", 1), (11, "one two three", "en", "", 1),
]


def odd(spark: SparkSession) -> DataFrame:
    """The awkward rows with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    extra = ("label", "size", "stats", "leak", "fp", "start", "toxicity", "quality", "a", "b", "salt", "kept", "_w", "_l", "_row", "bucket")
    return spark.createDataFrame(ODD, SCHEMA).select("*", *(F.lit(n).alias(n) for n in extra))


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, sf: str) -> list:
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
