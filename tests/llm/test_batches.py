"""Batches of long texts are bounded by bytes."""

import pyarrow as pa

from rankwatch.llm.common import small_batches


def test_batches_of_long_texts(spark):
    small_batches(spark)
    df = spark.range(300).selectExpr("id", "repeat('0123456789', 100000) AS text").repartition(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    got = df.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in got) == 300
    assert max(r["bytes"] for r in got) < 24 << 20
