import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from linkwright.llm import media


def test_forms_by_one_worker(docs):
    """The same columns as by two operators, in one pass through Python."""
    few = docs.select("doc_id", "text")
    made, want = media.add_forms(few), media.stored(media.add_media(few))
    assert made.columns == want.columns and sorted(map(str, made.collect())) == sorted(map(str, want.collect()))
    size = F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes")
    plan = media.media_features(media.add_forms(docs.select("doc_id", size, "text")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2


def test_runs_are_small(spark):
    """A worker takes texts in runs whose samples and sums stay small, and Spark sends few of them at once."""
    text = np.full(100_000, 65, np.uint8).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 40)], names=["body"])
    runs = [len(data) for _, data, _ in media.slabs([batch], "body", media.RUN_BYTES)]
    assert sum(runs) == 40 * len(text) and max(runs) <= 1 << 18
    media.add_forms(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 64
