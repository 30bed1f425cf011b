import os
import uuid

from clinilake.streaming import land_stream


def test_land_stream_copies_each_file_once(spark, scratch):
    src, out, ck = (os.path.join(scratch, x) for x in ("src", "out", "ck"))
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string").write.json(os.path.join(src, "p1"))
    q = land_stream(spark, "json", os.path.join(src, "*"), spark.createDataFrame([], "id int, v string").schema,
                    out, "landing_test", checkpoint=ck)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([(3, "c")], "id int, v string").write.json(os.path.join(src, "p2"))
    q = land_stream(spark, "json", os.path.join(src, "*"), spark.createDataFrame([], "id int, v string").schema,
                    out, "landing_test", checkpoint=ck)
    q.awaitTermination()
    landed = spark.read.parquet(out)
    assert landed.count() == 3 and "_source_file" in landed.columns


def test_land_stream_checkpoint_defaults_to_shared_folder(spark, scratch):
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    spark.createDataFrame([(1, "a")], "id int, v string").write.json(os.path.join(src, "p1"))
    schema = spark.createDataFrame([], "id int, v string").schema
    # The shared checkpoint folder outlives the test run, and a stream name
    # resumes its own progress there, so each run takes a new name.
    name = f"landing_default_{uuid.uuid4().hex[:12]}"
    q = land_stream(spark, "json", os.path.join(src, "*"), schema, out, name)
    q.awaitTermination()
    base = spark.conf.get("spark.checkpoint.dir")
    assert os.path.isdir(os.path.join(base.removeprefix("file:"), "landing", name))
    assert spark.read.parquet(out).count() == 1
