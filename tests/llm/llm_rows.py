"""Small inputs for the tests of the operators on documents."""

from conftest import DATA
from pyspark.sql import functions as F


def read(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


def documents(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, source), with columns named like inner ones of operators."""
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "src0") for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long"), "row": F.lit(1),
                           "size": F.lit("x"), "score": F.lit(0.5), "rest": F.lit(None).cast("string")})
