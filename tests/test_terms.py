from pyspark.sql import functions as F

from tidemill.functions import texts
from tidemill.operators import retrieval
from tidemill.plans import reference_queries as R


def test_telling_terms(spark):
    rows = [("The Fee for USERS on X is fee 2x",), ("新币上线BTC，的 充值-delay",), ("the of and",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(texts.telling_terms(F.col("t")).alias("t")).collect()
    assert [r.t for r in got] == [["fee", "2x"], ["新币上线btc", "充值", "delay"], [], None]


def test_stop_words_displace_no_match(spark, tmp_path):
    titles = [(f"{n}", "what is new on the platform with you") for n in range(6)] + [("match", "withdrawal delay"), ("zh", "充值 公告"), ("none", "公 告")]
    spark.createDataFrame(titles, "uid string, title string").write.parquet(f"{tmp_path}/announcements.parquet")
    items = [(1, "Is the withdrawal on the platform with a delay new to you?"), (2, "关于 充值 的"), (3, "the new platform")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/eval_items.parquet")
    got = sorted(tuple(r) for r in R.QUERIES["telling_term_recall"](spark, str(tmp_path)).collect())
    assert got == [(1, "match", 2, 1), (2, "zh", 1, 1)]
    plain = retrieval.recall(spark.createDataFrame(items, "i long, t string"), "i", "t", spark.createDataFrame(titles, "k string, title string"), "k", "title", 4)
    assert plain.where("k = 'match'").count() == 0
