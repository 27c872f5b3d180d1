"""Scratch tables, shared values and settings end with their block."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import jaccard, lines, repeats
from shelfspark.llm.common import for_tasks, kept_table, scratch, table_writes, written
from shelfspark.session import checkpoint_dir

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _tables(spark) -> set[str]:
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def _counts(spark):
    return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()


def test_tables_of_a_block_go_and_what_stays_is_whole(spark):
    before = _tables(spark)
    with scratch(spark):
        inner = kept_table(_counts(spark), "inner")
        with scratch(spark):
            passing = kept_table(inner.filter("k < 5"), "passing")
            up = kept_table(passing, "up", stays=True)
            out = written(passing.select("k"))
        assert up.count() == 5  # until the block around ends
        kept = kept_table(up, "kept", stays=True)
    assert {t.rsplit("-", 1)[0] for t in _tables(spark) - before} == {"kept"}
    assert sorted(r["k"] for r in out.collect()) == sorted(r["k"] for r in kept.collect()) == [0, 1, 2, 3, 4]


def test_blocks_end_after_an_error(spark):
    before, clean = _tables(spark), spark.conf.get(_CLEAN)
    with pytest.raises(ValueError), scratch(spark):
        kept_table(_counts(spark), "lost")
        value = for_tasks(spark, list(range(10)))
        raise ValueError
    assert _tables(spark) == before and spark.conf.get(_CLEAN) == clean
    with pytest.raises(Exception):
        spark.sparkContext.parallelize([1]).map(lambda x: value.value[x]).collect()


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with table_writes(spark):
        assert spark.conf.get(_CLEAN) == "true"
        with table_writes(spark):
            pass
        assert spark.conf.get(_CLEAN) == "true"
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_operators_leave_only_what_their_result_reads(spark):
    text = " ".join(f"word{i}" for i in range(120))
    docs = spark.createDataFrame([(1, text), (2, text), (3, text + " more"), (4, "a line\nof its own"), (5, None)], "doc_id long, text string")
    for run, left in [(lines.drop_lines, set()), (jaccard.keep_one, {"classes", "repeated"}),
                      (lambda d: repeats.drop_repeats(d, words=repeats.PASSAGE_WORDS), {"spans"})]:
        before = _tables(spark)
        out = run(docs)
        assert {t.rsplit("-", 1)[0] for t in _tables(spark) - before} == left
        assert out.count() > 0
