import pyarrow as pa
from pyspark.sql import functions as F

from samplyard.llm.tables import BATCH, BATCH_BYTES, FREE_SHUFFLES, staged


def test_python_gets_whole_texts_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    before = [spark.conf.get(key, None) for key in (BATCH, FREE_SHUFFLES)]
    texts = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("abcdefghij"), 1000).alias("text"))
    found = staged(texts.mapInArrow(sizes, "n long, size long"), "sizes").collect()
    assert sum(r["n"] for r in found) == 4000
    assert max(r["size"] for r in found) < 1.1 * BATCH_BYTES
    assert [spark.conf.get(key, None) for key in (BATCH, FREE_SHUFFLES)] == before
