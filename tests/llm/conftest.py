import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def frame(spark, texts, ids=None, **extra):
    """documents-like rows; extra: constant columns."""
    from pyspark.sql import functions as F

    ids = range(len(texts)) if ids is None else ids
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    df = df.withColumns({"lang": F.lit("en"), "source": F.concat(F.lit("s"), F.col("doc_id") % 3), "n_chars": F.length("text").cast("long")})
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})
