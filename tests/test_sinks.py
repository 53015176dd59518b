"""Landing with content ids, CSV sinks and canonical JSON."""

import collections
import json
import tempfile

from pyspark.sql import functions as F

from tessera.plans import experiments as ex
from tessera.plans.fixtures import SINK_EDGES, sink_edge_frame
from tessera.sources import corpus as co
from tessera.sources import sinks


def _path(name):
    return f"{tempfile.mkdtemp(prefix='tessera-sink-')}/{name}"


def test_ids_do_not_depend_on_the_layout(spark):
    rows = [(f"text {i % 50}", i % 2, "train") for i in range(300)] + [("the same", 1, "test")] * 2000 + [("", 0, "validation")]
    df = spark.createDataFrame(rows, "text string, label int, split string")
    want = None
    for parts in (1, 3, 16):
        landed = co.land_corpus(df.repartition(parts), _path("landed"))
        got = sorted(tuple(r) for r in landed.select("doc_id", "text", "label", "split").collect())
        assert len({r[0] for r in got}) == len(rows)
        want = want or got
        assert got == want
    assert collections.Counter(r[1:] for r in want) == collections.Counter(rows)
    copies = sorted(int(r[0].split("-")[1]) for r in want if r[1] == "the same")
    assert copies == list(range(2000))


def test_landed_ids_are_kept_and_splits_pruned(spark):
    path = _path("landed")
    landed = co.land_corpus(sink_edge_frame(spark), path)
    again = co.load_parquet_splits(spark, path)
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, again.collect()))
    plan = again.where("split = 'test'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    other = _path("plain")
    sink_edge_frame(spark).write.parquet(other)
    assert {r.doc_id for r in co.load_parquet_splits(spark, other).collect()} == {r.doc_id for r in landed.collect()}


def test_csv_scan_of_many_files_equals_one(spark):
    ids = set()
    for parts in (1, 4):
        root = _path("csv")
        for split in co.SPLITS:
            sinks._csv(sink_edge_frame(spark).where(F.col("split") == split).repartition(parts).write, True).csv(f"{root}/{split}.csv")
        got = co.load_split_csvs(spark, root).collect()
        assert collections.Counter((r.text, r.label, r.split) for r in got) == collections.Counter(SINK_EDGES)
        ids.add(frozenset(r.doc_id for r in got))
    assert len(ids) == 1


def test_result_csv_keeps_nulls_and_doubles(spark):
    rows = [("a,b", 0.1 + 0.2, None), ('q"', None, 3), (None, 1e-300, -1)]
    schema = "experiment string, val double, rank int"
    path = _path("result")
    sinks.write_result_csv(spark.createDataFrame(rows, schema), path)
    got = sinks.read_csv(spark, path, schema).collect()
    assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)


def test_payload_blocks(spark):
    pred = spark.createDataFrame([(e, s, i, i % 2, int(i % 3 == 0)) for e in ("a", "ens") for s in ("train", "validation", "test") for i in range(9)],
                                 "experiment string, split string, doc_id long, label int, prediction int")
    folds = spark.createDataFrame([("a", 1, 0.25), ("a", 0, 0.75)], "experiment string, fold int, macro_f1 double")
    who = spark.createDataFrame([("ens", [("a", 0.6), ('b"', 0.4)])], "experiment string, members array<struct<experiment:string,weight:double>>")
    config = ex.experiment_config(spark, [ex.BASE[0]]).withColumn("experiment", F.lit("a"))
    got = {r.experiment: r.payload for r in sinks.metrics_payload(pred, folds, config, who).collect()}
    a, ens = json.loads(got["a"]), json.loads(got["ens"])
    assert list(a) == ["config", "cross_validation", "ensemble", "test", "validation"] == sorted(a)
    assert a["cross_validation"] == {"cv_mean": 0.5, "cv_scores": [0.75, 0.25], "cv_std": 0.25}
    assert a["config"]["model"]["C"] == 4.0 and a["config"]["vectorizers"][0]["max_features"] == 8000
    assert ens["ensemble"] == {"component_models": ["a", 'b"'], "weights": [0.6, 0.4]} and ens["config"] is None
    assert sum(map(sum, a["test"]["confusion_matrix"])) == 9 and a["ensemble"] is None
    bare = json.loads(sinks.metrics_payload(pred).first().payload)
    assert bare["cross_validation"] is None and bare["validation"]["classification_report"]["0"]["support"] == 5
