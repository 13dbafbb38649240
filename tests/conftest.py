import os
import sys

import pytest
from pyspark.sql import SparkSession
from small_tables import SF

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def texts(spark):
    """Adversarial documents: blanks, contractions, digits, scripts, repeats."""
    return [
        "",
        "   ",
        "trail   ",
        "  lead",
        "a  b   c",
        "a  9",
        "a  !",
        "a\t\t!",
        "a \t!",
        "\t 9",
        " \n \n  foo 12345 '  7",
        "\r\n\r\n  x",
        "a\n  \n  9",
        "...\r\n\r\n..",
        "x\u0085\u0085y  z\u000b\u000bq　　w",
        "a\u001c\u001db​c᠎d",
        "I'LL we'Ve don't 'S'ſ x",
        "é café Ⅷ ½ 1234567",
        "\U0001f600\U0001f601 \U00020000 中文 é",
        "aa aaa aaaa aaaaa abab",
        "the cat sat on the mat, the other cat sat there " * 5,
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4, "doc_id")


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
