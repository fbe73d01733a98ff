from pyspark.sql import functions as F

from agorascope import config
from agorascope.sources import scan


def test_scan(spark):
    rows = spark.range(50).select(F.format_string("%02d", "id").alias("post_id"), F.col("id").alias("n"))
    assert [r.post_id for r in scan.scan(rows, ["post_id", "absent"], F.col("n") > 9, skip=2, limit=3).collect()] == ["12", "13", "14"]
    assert scan.scan(rows, sample=7, limit=1).count() == 7


def test_listing(spark):
    rows = spark.createDataFrame([("a", 5, 1000), ("b", 9, 10), ("c", 1, 900_000)], "post_id string, score long, created_utc long")
    ids = lambda *a: [r.post_id for r in scan.listing(rows, *a).collect()]
    assert ids("top", 2, 1000, "all") == ["b", "a"] and ids("new", 1, 0) == ["c"] and ids("hot", 1, 0) == ["c"] and ids("odd", 9, 0) == []


def test_exports(spark):
    posts = spark.createDataFrame([("1", None, 0)], "id string, title string, created_utc long")
    assert tuple(scan.export_posts(posts).first()) == ("1", None, "", "", 0, 0, "1970-01-01T00:00:00Z")
    assert scan.violations(posts, ["post_id", "created_utc"]).first().lacks == ["post_id"]


def test_table(spark):
    rows = spark.createDataFrame([("a", "2020-W01"), ("b", "2020-W02")], "post_id string, snapshot_week string")
    scan.write_table(rows, "posts_by_week", "post_id", 2)
    assert spark.table("posts_by_week").where("snapshot_week = '2020-W01'").count() == 1
    spark.sql("DROP TABLE posts_by_week")


def test_config(tmp_path):
    (tmp_path / "s.json").write_text('{"embedding": {"batch": 8}}')
    assert config.load(f"{tmp_path}/s.json")["embedding"] == {"batch": 8, "max_tokens": 512, "overlap": 50}
    assert config.load(f"{tmp_path}/none.json") == config.DEFAULTS
    model = config.paced(lambda p: p * 2, 0.01)
    assert [model("a"), model("b")] == ["aa", "bb"]
