import pytest
from pyspark.sql import functions as F

from clinilake import schemas, session


def test_get_returns_active_session(spark):
    assert session.get("other-name") is spark
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_reused_persists_then_unpersists(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    with session.reused(df) as d:
        assert d.is_cached and d.count() == 100
    assert not df.is_cached


def test_checkpoint_dir_and_checkpointed(spark):
    assert session.checkpoint_dir(spark)
    df = session.checkpointed(spark.range(10))
    assert df.count() == 10


def test_empty_and_conform(spark):
    e = schemas.empty(spark, "fact_attention")
    assert e.count() == 0 and e.schema == schemas.FACT_ATTENTION
    raw = spark.createDataFrame([("1", "x", "5")], "DIAG_ID string, CIE10_CODE string, DESCRIPTION string")
    out = schemas.conform(raw, schemas.DIM_DIAGNOSIS).first()
    assert out["DIAG_ID"] == 1 and out["DESCRIPTION"] == "5"
    # A nullable column loses what does not convert, a key fails the job.
    late = spark.createDataFrame([("1", "10", "not a day")], "PACID string, PACDOC string, PACINGDAT string")
    for name in ("FIRST_NAME", "SECOND_NAME", "LAST_NAME", "PACCITY"):
        late = late.withColumn(name, F.lit("x"))
    assert schemas.conform(late, schemas.DIM_PATIENT).first()["PACINGDAT"] is None
    bad = spark.createDataFrame([("x1", "A", None)], "DIAG_ID string, CIE10_CODE string, DESCRIPTION string")
    with pytest.raises(Exception, match="DIAG_ID does not fit"):
        schemas.conform(bad, schemas.DIM_DIAGNOSIS).collect()


def test_reused_fill_materialises(spark):
    df = spark.range(50).withColumn("x", F.col("id") + 1)
    with session.reused(df, fill=True) as d:
        assert d.storageLevel.useDisk and d.count() == 50
    assert not df.is_cached
