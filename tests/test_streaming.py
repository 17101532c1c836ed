"""The stateless labels run unchanged on a streaming source."""

from pyspark.sql import functions as F

from sourcelens.streaming.labels import label_records, stream_labels


def test_stream_labels_match_batch(spark, tmp_path, rules):
    landing = tmp_path / "landing"
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url",
                                                                              F.col("html").alias("text"))
    pages.write.parquet(str(landing / "batch1"))
    stream = stream_labels(spark, str(landing / "*"), pages.schema, rules)
    q = (stream.select("page_id", "canon_url", "ownership", "nonprod_url")
         .writeStream.format("memory").queryName("labels_out").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "chk")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {tuple(r) for r in spark.sql("select * from labels_out").collect()}
    want = {tuple(r) for r in label_records(pages, rules).select("page_id", "canon_url", "ownership",
                                                                 "nonprod_url").collect()}
    assert got == want and len(got) == pages.count()


def test_label_stream_to_files_is_incremental(spark, tmp_path, rules):
    from sourcelens.streaming.labels import start_label_stream
    landing, out, chk = tmp_path / "landing", str(tmp_path / "out"), str(tmp_path / "chk")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url",
                                                                              F.col("html").alias("text"))
    pages.where("page_id % 2 = 0").write.parquet(str(landing / "b1"))
    q = start_label_stream(spark, str(landing / "*"), pages.schema, rules, out, chk, available_now=True)
    q.awaitTermination(120)
    first = spark.read.parquet(out).count()
    pages.where("page_id % 2 = 1").write.parquet(str(landing / "b2"))
    q = start_label_stream(spark, str(landing / "*"), pages.schema, rules, out, chk, available_now=True)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert first == pages.where("page_id % 2 = 0").count()
    assert got.count() == pages.count() and got.select("page_id").distinct().count() == pages.count()
