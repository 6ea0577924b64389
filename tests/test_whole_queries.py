import __spark_entry__ as e


def test_rare_terms_are_in_the_statistics(spark, tmp_path):
    spark.createDataFrame([(1, "một cây"), (2, "cây cây")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["term"], r["df"], r["cf"]) for r in e.queries()["postings_all_terms"](spark, str(tmp_path)).collect()}
    assert got == {("mot", 1, 1), ("cay", 2, 3)}


def test_every_text_of_a_frame_has_a_video(spark):
    data = "/root/testdata/sf0.001"
    got = e.queries()["caption_video_all"](spark, data).where("caption_id LIKE 'f:%'")
    want = spark.read.parquet(f"{data}/ocr.parquet").where("frame_id IS NOT NULL").select("frame_id", "n").distinct().count()
    assert got.count() == want == got.select("caption_id").distinct().count()
