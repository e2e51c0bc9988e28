"""The pipeline stage by stage against plain statements of each stage."""

from collections import defaultdict

from brute import exact_classes, near_classes, repeated_words, words
from conftest import SF
from pyspark.sql import functions as F
from test_text import check_packing

import corpus_pipeline
from quayload.llm import quality_rules
from quayload.llm.workspace import stage


def pairs(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    good = stage(steps["quality_rules"](spark, docs, SF), "t")
    verdicts = {r.doc_id for r in quality_rules.judge(docs).where("kept").collect()}
    assert good.columns == columns and {d for d, _ in pairs(good)} == verdicts

    before = pairs(good)
    once = stage(steps["exact_dedup"](spark, good, SF), "t")
    assert sorted(pairs(once)) == sorted((d, t) for (d, t), k in zip(before, exact_classes(before), strict=True) if k[1] == d)

    before = pairs(once)
    alone = stage(steps["ngram_join"](spark, once, SF), "t")
    assert sorted(pairs(alone)) == sorted((d, t) for (d, t), k in zip(before, near_classes(before), strict=True) if k[2] == d)

    before = pairs(alone)
    cut = stage(steps["substring_dedup"](spark, alone, SF), "t")
    want = {d: (n - gone, digest) for d, n, gone, digest in repeated_words(before)}
    from brute import sha

    assert cut.columns == columns
    assert {d: (len(words(t)), sha(" ".join(words(t)))) for d, t in pairs(cut)} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    packed = steps["packing"](spark, cut, SF).collect()
    check_packing(packed, pairs(cut))


def test_run_and_empty_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    tokens = defaultdict(int)
    for r in corpus_pipeline.run(spark, SF).collect():
        tokens[r.doc_id] += r.length
    assert tokens and all(n > 0 for n in tokens.values())


def test_release_drops_shuffles_of_written_steps(spark):
    """What Python has dropped reaches the JVM before it collects."""
    import time

    from quayload.llm.workspace import release, stage

    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))

    release(spark)
    time.sleep(2)
    before = shuffles()
    stage(spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count(), "released")
    assert shuffles() > before
    release(spark)
    time.sleep(2)
    assert shuffles() <= before
