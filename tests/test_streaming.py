"""The text functions on a Structured Streaming DataFrame (file source,
memory sink, processAllAvailable)."""

import os
import tempfile

from tessera.streaming import normalize_stream


def test_normalize_stream(spark):
    src = tempfile.mkdtemp(prefix="tessera-stream-")
    spark.createDataFrame([(1, "Hi @Bob_1!!!! see HTTP://x.y #Tag??? ok"), (2, None)],
                          "doc_id long, text string").write.mode("overwrite").parquet(os.path.join(src, "in"))
    stream = spark.readStream.schema("doc_id long, text string").parquet(os.path.join(src, "in"))
    q = (normalize_stream(stream).writeStream.format("memory").queryName("tessera_norm")
         .option("checkpointLocation", os.path.join(src, "ckpt")).outputMode("append").start())
    try:
        q.processAllAvailable()
        rows = {r.doc_id: r for r in spark.sql("SELECT * FROM tessera_norm").collect()}
    finally:
        q.stop()
    assert rows[1].text_norm == "hi USER !! see URL tag ?? ok"
    assert rows[1].sanitized_text == "Hi @USER!!!! see HTTP://x.y #Tag??? ok"
    assert rows[2].text_norm == "" and rows[2].sanitized_text == ""
