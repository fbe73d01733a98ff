from agorascope.operators.filters import parse
from agorascope.plans import dashboard
from agorascope.sources import tables
from agorascope.streaming import incremental


def test_trends_equal_batch(spark, small, tmp_path):
    rows = tables.comments(spark, small)
    rows.repartition(3).write.parquet(f"{tmp_path}/c")
    stream = incremental.trends(incremental.comment_stream(spark, f"{tmp_path}/c", rows.schema), late="36500 days")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("trend").trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(str(r.bucket)[:10], r.label): r["count"] for r in spark.table("trend").collect()}
    f = parse("90d", now=tables.AS_OF)
    batch = dashboard.trends(tables.bare_posts(spark, small), rows, f.__class__(days=90))
    assert got == {(str(r.bucket)[:10], r.label): r["count"] for r in batch.collect()}


def test_post_sums(spark, small):
    sums = incremental.post_sums(tables.comments(spark, small))
    assert sums.count() == tables.comments(spark, small).select("post_id").distinct().count()
