"""Documents that every operator has to take: nulls, empty and long texts, repeated rows, clashing columns."""

LONG = "".join(f"word{i % 977} " for i in range(60_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a", 10, 0),
    (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a", 10, 0),
    (2, None, "en", None, None, 1),
    (3, "", None, "a", 0, 1),
    (4, " \n\t ", "de", "a", 4, 1),
    (5, LONG, "en", "b", len(LONG), 2),
    (None, "a text without any id at all", "en", "b", 28, 2),
    (6, "ünïcödé wörds 漢字 😀 \x1c end", "de", "b", 27, 3),
    (7, "12345 !!! ### 67890", None, "b", 19, 3),
]
#: Names that operators use for results or inside clash with columns that documents may have.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, fingerprint int"
)


def documents(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def extended(spark):
    """The same with more clashing columns."""
    from pyspark.sql import functions as F

    names = ["score", "component_id", "ids", "spans", "hits", "items", "row", "mark", "places", "ranges", "n_words"]
    return documents(spark).select("*", *[F.lit(9).alias(name) for name in names])


def by_id(rows, column="doc_id"):
    return sorted(rows, key=lambda row: (row[column] is None, row[column] or 0))
