"""Small document tables for the tests of the training-data operators."""

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside, as columns of the caller.
CLASHES = (
    "id part origin blob hash flag words word language fp component_id found_id candidates hits "
    "item item_words shift place bit rest feature bucket rows fences outliers spans kept_text "
    "kept decoded ids draw share score slot n"
).split()


def documents(spark, rows, clashes=False):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows, in several partitions."""
    full = [
        (r[0], r[1], r[2] if len(r) > 2 else "en", f"src{i % 2}", len(r[1] or "")) for i, r in enumerate(rows)
    ]
    df = spark.createDataFrame(full, SCHEMA).repartition(3)
    if clashes:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(name) for name in CLASHES])
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def odd_rows():
    """Nulls, empty and white-space texts, repeated rows, equal texts, control characters."""
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two three four five"),
        (5, "one two three four five"), (6, "one two three four five"), (None, "one two three four"),
        (None, None), (7, "\x00 \x1c    Ünïcode \U0001f600 İıſK"), (8, "12345 !?"),
        (-9, "x" * 500), (9, "la " * 700), (2**40, "One TWO three\nfour\n\nfour\nfive"),
    ]
