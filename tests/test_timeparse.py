from tagpulse.functions.timeparse import parse_event_time, register_sql_function


def test_time_rows(spark):
    rows = [("Wed Jun 16 123456 CEST 2021", 1623839696), ("Wed Jun 16 123456 UTC 2021", 1623846896),
            ("garbage", 0), (None, 0),
            ("Xyz Jun 16 123456 UTC 2021", 0), ("Wednes Jun 16 123456 UTC 2021", 0), ("Jun 16 123456 UTC 2021", 0)]
    df = spark.createDataFrame(rows, "time string, expected long")
    for r in df.select("expected", parse_event_time("time").alias("ts")).collect():
        assert r["ts"] == r["expected"]


def test_sql_function(spark):
    register_sql_function(spark)
    assert spark.sql("SELECT toTimestamp('Xyz Jun 16 123456 UTC 2021') AS a").first()["a"] == 0
    row = spark.sql("SELECT toTimestamp('Wed Jun 16 123456 UTC 2021') AS a, toTimestamp('x') AS b").first()
    assert (row["a"], row["b"]) == (1623846896, 0)
