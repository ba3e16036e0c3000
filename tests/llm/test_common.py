import pytest

from tallyline.llm import common


@pytest.mark.parametrize("given, left", [("64m", str(4 << 20)), ("1m", "1m"), ("4194304b", "4194304b"), ("1g", str(4 << 20)), ("5000000", str(4 << 20))])
def test_small_batches(spark, given, left):
    """Larger batches are made smaller, smaller ones are left as they are."""
    before = spark.conf.get(common.BATCH_SETTING)
    try:
        spark.conf.set(common.BATCH_SETTING, given)
        common.small_batches(spark)
        assert spark.conf.get(common.BATCH_SETTING) in (left, f"{left}b")
    finally:
        spark.conf.set(common.BATCH_SETTING, before)


def test_batches_have_the_bytes(spark):
    common.small_batches(spark)

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    rows = spark.range(300, numPartitions=1).selectExpr("repeat('x', 100000) AS text")
    most = rows.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0]
    assert 0 < most <= common.BATCH_BYTES + 200_000
