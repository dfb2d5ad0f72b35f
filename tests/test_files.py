"""Readers on tiny files, sinks, and the streaming form of scoring and resampling."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from oddrows.operators import stats, thresholds
from oddrows.sources import readers, writers
from oddrows.streaming.scoring import stream_outlier_regions, stream_resample, stream_score


def put(folder, name, body):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(body)
    return path


def test_csv(spark, folder):
    path = put(folder, "a.csv", "t,x\n1,2.5\n2,\n3,NaN\n")
    assert [tuple(r) for r in readers.read_csv_table(spark, path, "t int, x double").orderBy("t").collect()] == [(1, 2.5), (2, None), (3, None)]


def test_tsv(spark, folder):
    path = put(folder, "a.tsv", "start_time\ttitle\n2019-03-01 10:05\tgame\nbroken\tshow\n")
    out = readers.read_tsv_events(spark, path, "start_time string, title string").orderBy("title").collect()
    assert out[0]["date"] == "2019-03-01" and out[1]["start_time"] is None


def test_arff(spark, folder):
    head = "% c\n@relation r\n\n@attribute 'a 1' real\n@attribute b NUMERIC\n@attribute class {'1','2'}\n@data\n"
    one, two = put(folder, "a.arff", head + "1.5,2,1\n?,3,2\n"), put(folder, "b.arff", head + "% x\n7,8,1\n")
    out = readers.read_arff(spark, [one, two])
    assert out.columns == ["a 1", "b", "class"]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == [(1.5, 2.0, "1"), (None, 3.0, "2"), (7.0, 8.0, "1")]


def test_label_map(spark, folder):
    path = put(folder, "a.json", '{"a.csv": ["2014-02-19 00:22:00", "2014-02-24 18:37:00"], "b.csv": []}')
    out = readers.read_label_map(spark, path).collect()
    assert {(r["series"], str(r["ts"])) for r in out} == {("a.csv", "2014-02-19 00:22:00"), ("a.csv", "2014-02-24 18:37:00")}


def test_line_numbers_over_splits(spark, folder):
    for name, n in (("a.txt", 5000), ("b.txt", 300)):
        put(folder, name, "".join(f" {i}.0\t{i * 2} \n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        out = readers.read_numeric_lines(spark, folder, drop_first=True)
        assert out.count() == 5300
        assert out.filter(F.col("channels")[0] != F.col("line") * 2).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_headerless_and_vectors(spark, folder):
    path = put(folder, "t.csv", "2014-07-01 00:00:00,10844\n2014-07-01 00:30:00,8127\n")
    assert [r["value"] for r in readers.read_headerless_csv(spark, path, "ts string, value double").collect()] == [10844.0, 8127.0]
    path = put(folder, "v.txt", "the 0.1 -0.2\nof 0.5 0.25\n")
    assert {r["word"]: len(r["vec"]) for r in readers.read_word_vectors(spark, path).collect()} == {"the": 2, "of": 2}


def test_splits_are_pruned(spark, folder):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 6, "train").otherwise("test"))
    writers.write_labeled_splits(df, folder + "/s")
    back = spark.read.parquet(folder + "/s").filter("split = 'train'")
    assert back.count() == 6 and len(back.inputFiles()) >= 1
    assert sorted(d for d in os.listdir(folder + "/s") if d.startswith("split")) == ["split=test", "split=train"]


@pytest.fixture()
def events(spark, folder):
    t = pd.date_range("2024-01-01", periods=200, freq="15min")
    df = spark.createDataFrame(pd.DataFrame({"event_id": range(200), "ts": t, "value": [float(i % 17) for i in range(200)]}))
    df.repartition(4).write.parquet(folder + "/in")
    return df


def read(spark, folder, df):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(folder + "/in")


def test_stream_score_equals_batch(spark, folder, events):
    fences = thresholds.fit_iqr_fence(events, "value", reach=0.2)
    score = lambda df: thresholds.score_iqr_fence(df, fences, "value")
    stream_score(read(spark, folder, events), score, folder + "/out", folder + "/cp").awaitTermination(120)
    got = {(r["event_id"], r["is_outlier"]) for r in spark.read.parquet(folder + "/out").collect()}
    assert got == {(r["event_id"], r["is_outlier"]) for r in score(events).collect()}


def run_to_end(spark, df, folder, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option(
        "checkpointLocation", folder + "/" + name).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_stream_resample_equals_batch(spark, folder, events):
    out = run_to_end(spark, stream_resample(read(spark, folder, events), "ts", "value", delay="3 days"), folder, "res")
    got = {str(r["bucket"]): (round(r["mean"], 9), r["n"]) for r in out.collect()}
    want = {str(r["bucket"]): round(r["value_mean"], 9) for r in stats.calendar_resample(events, "ts", ["value"]).collect()}
    assert set(got) <= set(want) and all(got[b][0] == want[b] for b in got)


def test_stream_regions(spark, folder, events):
    flagged = read(spark, folder, events).withColumns({"is_outlier": (F.col("value") >= 12).cast("int"), "s": F.lit("a")})
    regions = stream_outlier_regions(flagged, "ts", "value", "s", gap="20 minutes", delay="12 hours")
    out = run_to_end(spark, regions, folder, "reg")
    assert out.count() > 0 and all(r["points"] == 5 and r["lo"] == 12.0 and r["hi"] == 16.0 for r in out.collect())
