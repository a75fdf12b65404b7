"""What a task hands to Python at a time."""

import pyarrow as pa

from slatecast.llm.line_chunks import BATCH_BYTES, dedup_lines

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_line_dedup_lowers_the_bytes_of_a_batch(spark):
    old = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, "64m")
        docs = spark.createDataFrame([(1, "a b\nc d\ne"), (2, "a b\nc d\nf")], "doc_id long, text string")
        assert dedup_lines(docs).count() == 2
        wide = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', 10000) as t")

        def sizes(parts):
            for part in parts:
                yield pa.RecordBatch.from_arrays([pa.array([part.nbytes])], names=["b"])

        assert max(r["b"] for r in wide.mapInArrow(sizes, "b long").collect()) < 1.1 * BATCH_BYTES
        spark.conf.set(LIMIT, "4m")     # a lower limit stays
        dedup_lines(docs)
        assert spark.conf.get(LIMIT) == "4m"
    finally:
        spark.conf.set(LIMIT, old)
