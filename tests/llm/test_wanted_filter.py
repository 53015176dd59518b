"""The filter before the n-gram join's fetch of whole texts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tessera.llm.ngram_join import only_wanted


def test_keeps_every_wanted_row_and_few_others(spark):
    rows = spark.range(-20_000, 20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    rows = rows.union(spark.createDataFrame([(7, None), (7, "again"), (None, "no id"), (2 ** 62, "far")], "doc_id long, text string"))
    want = rows.where("doc_id % 7 = 0 or doc_id = 4611686018427387904").select("doc_id")
    got = only_wanted(rows, want).collect()
    wanted = [tuple(r) for r in rows.join(want.distinct(), "doc_id").collect()]
    key = lambda r: (r[0], r[1] or "")
    kept = sorted((tuple(r) for r in got if r[0] is not None and (r[0] % 7 == 0 or r[0] == 2 ** 62)), key=key)
    assert kept == sorted(wanted, key=key)
    assert len(got) < len(wanted) + 50  # 40,000 ids over 2 ** 26 bits
    assert only_wanted(rows, want.where("false")).count() == 0


def test_one_python_step_in_the_task_that_reads_texts(spark, capsys):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    want = rows.where("doc_id < 10").select("doc_id")
    small = only_wanted(rows, want).join(F.broadcast(want), "doc_id")  # as Spark joins a small table
    small.mapInArrow(lambda batches: batches, small.schema).explain()
    assert len(re.findall("InArrow|InPandas|InPython|ArrowEval|BatchEval", capsys.readouterr().out)) == 1
