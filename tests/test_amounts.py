from pyspark.sql import functions as F

from tidemill.functions import texts
from tidemill.plans import reference_queries as R


def test_amounts(spark):
    rows = [
        ("500USDT, 5 usdt or 5\u00a0USDT and 5  USDT", ["500USDT", "5 usdt", "5 USDT"]),
        ("$5 K, $ 7, €1,200.50, ¥300 and $2m", ["$5 K", "$ 7,", "€1,200.50,", "¥300", "$2m"]),
        ("3 USDC 0.5 btc 2ETH 10 WXT 4 stable 1 EDGE 9 XYZ", ["3 USDC", "0.5 btc", "2ETH", "10 WXT", "4 stable", "1 EDGE"]),
        ("", []),
        (None, None),
    ]
    got = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(texts.amounts(F.col("t")).alias("m")).collect()
    assert [r.m for r in got] == [m for _, m in rows]


def test_shown_titles(spark, tmp_path):
    titles = [("a", "<b>Fee &amp;\u00a0Rate</b>&nbsp;"), ("b", "&nbsp;"), ("c", None), ("d", "STRASSE"), ("e", " stra\u00dfe\u2003")]
    spark.createDataFrame(titles, "uid string, title string").write.parquet(f"{tmp_path}/announcements.parquet")
    got = {r.uid: (r.title, r.same_as) for r in R.QUERIES["shown_titles"](spark, str(tmp_path)).collect()}
    assert got == {
        "a": ("Fee &\u00a0Rate", "<b>fee &amp; rate</b>&nbsp;"), "b": (texts.UNTITLED, "&nbsp;"), "c": (texts.UNTITLED, ""),
        "d": ("STRASSE", "strasse"), "e": ("stra\u00dfe", "strasse"),
    }
