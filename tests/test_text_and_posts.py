"""Cleaning rules on literal rows (FIXTURES.md goldens)."""

from pyspark.sql import functions as F

from needlens.functions import post as P
from needlens.functions import text as T


def test_strip_removes_python_whitespace_set(spark):
    df = spark.createDataFrame([("　\t abc  \n",), ("\xa0x\x85",)], "s string")
    assert [r[0] for r in df.select(T.strip(F.col("s"))).collect()] == ["abc", "x"]


def test_assemble_text(spark):
    df = spark.createDataFrame([("DeFi yields", "are hard"), ("Title", ""), (None, " only desc "), (None, None)],
                               "t string, d string")
    got = [r[0] for r in df.select(T.assemble_text(F.col("t"), F.col("d"))).collect()]
    assert got == ["DeFi yields are hard", "Title", "only desc", ""]


def test_length_filter_20_vs_21(spark):
    df = spark.createDataFrame([("a" * 20,), ("a" * 21,), ("  " + "b" * 20 + "  ",)], "s string")
    assert [r[0] for r in df.select(T.long_enough(F.col("s"))).collect()] == [False, True, False]


def test_latin_share(spark):
    # 6 ASCII + 4 non-ASCII letters -> 0.6 keeps; digits only -> no letters -> drop
    df = spark.createDataFrame([("abcdef éèêë",), ("1234567890",), ("абвгд abc",)], "s string")
    assert [r[0] for r in df.select(T.is_latin(F.col("s"))).collect()] == [True, False, False]


def test_network_rules(spark):
    df = spark.createDataFrame([("tweet",), ("reddit-post",), ("youtube-video-post",), (None,)], "s string")
    got = [r[0] for r in df.select(P.network(F.col("s"))).collect()]
    assert got == ["tweet", "reddit", "youtube_video", "unknown"]
    got_b = [r[0] for r in df.select(P.network_b(F.lit(""), F.col("s"))).collect()]
    assert got_b == ["tweet", "reddit", "youtube", "unknown"]


def test_sentiment_rescale_zero_is_falsy(spark):
    df = spark.createDataFrame([(0.0,), (None,), (5.0,), (2.0,)], "x double")
    assert [r[0] for r in df.select(P.sentiment_rescale(F.col("x"))).collect()] == [50.0, 50.0, 100.0, 40.0]


def test_epoch_timestamp_defaults(spark):
    df = spark.createDataFrame([(0,), (None,), (1705312800,)], "e long")
    got = [str(r[0]) for r in df.select(P.epoch_timestamp(F.col("e"))).collect()]
    assert got == ["2024-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-15 10:00:00"]


def test_interactions_fall_through(spark):
    df = spark.createDataFrame([(0, 7), (3, 7), (None, None)], "a long, b long")
    assert [r[0] for r in df.select(P.interactions(F.col("a"), F.col("b"))).collect()] == [7, 3, 0]


def test_topic_normaliser(spark):
    df = spark.createDataFrame([("Rate_Cuts",), (" rate-cuts ",)], "s string")
    assert [r[0] for r in df.select(T.normalize_topic(F.col("s"))).collect()] == ["rate cuts", "rate cuts"]


def test_tokens_and_stop_words(spark):
    df = spark.createDataFrame([("The DeFi yield_farm a 42 été",)], "s string")
    assert df.select(T.tokens(F.col("s"))).first()[0] == ["the", "defi", "yield_farm", "42", "été"]
    assert len(T.english_stop_words()) == 318 and "the" in T.english_stop_words()
