"""A third of the table one and the same row, and tables without ids."""

import random

import pytest
from pyspark.sql import functions as F

from labelkiln.llm import exact_dedup, mixing, shards, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, ids: bool):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("abcdefg", k=5))
    rows = [(i if ids else None, " ".join(word() for _ in range(rnd.randint(3, 40))), "en", f"s{i % 3}", 0) for i in range(2000)]
    rows += [(7 if ids else None, "the very same row " * 4, "en", "s1", 0)] * 1000
    return spark.createDataFrame(rows, SCHEMA).repartition(6).cache()


@pytest.mark.parametrize("ids", [True, False])
def test_shards_of_equal_rows(spark, ids):
    got = shards.shard_report(table(spark, ids))
    sizes = [r["sum(size)"] for r in got.groupBy("shard").sum("size").collect()]
    most = got.agg(F.max("size")).first()[0]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * most + 0.001 * sum(sizes)
    assert got.groupBy("shard").agg(F.max("slot").alias("m"), F.count("*").alias("n"), F.countDistinct("slot").alias("d")).filter(
        "m <> n - 1 OR d <> n").count() == 0


@pytest.mark.parametrize("ids", [True, False])
def test_one_row_of_equal_rows_stays(spark, ids):
    df = table(spark, ids)
    got = exact_dedup.exact_groups(df)
    assert got.filter("kept").count() == df.select("text").distinct().count()
    assert got.groupBy("text_sha256").agg(F.count_if("kept").alias("k"), F.count("*").alias("n"), F.max("group_size").alias("g")
                                          ).filter("k <> 1 OR n <> g").count() == 0


def test_targets_without_ids(spark):
    df = table(spark, False).filter("text NOT LIKE 'the very same%'")
    got = mixing.mix_report(df)
    by = got.groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert by and all(abs(r.t - r.target) <= 0.06 * r.target for r in by)


def test_repeated_label_rows_change_nothing(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        words = ["".join(rnd.choices("abcdefgh", k=6)) for _ in range(30)]
        if bad:
            words[5:8] = ["horrible", "nasty", "rotten"]
        rows.append((i, " ".join(words), "en", "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    lab = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    repeated = lab.unionByName(lab.filter("doc_id = 4").crossJoin(spark.range(2500).drop("id")))
    scores = lambda labels: {r.doc_id: r.score for r in toxicity.toxicity_report(docs, labels).collect()}
    assert scores(lab) == scores(repeated)
