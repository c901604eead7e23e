import pytest
from pyspark.sql import functions as F

from txstream.session import SHUFFLE_CLEANUP, materialize, settled, temporary_tables


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {blocks.apply(i).name() for i in range(blocks.size()) if blocks.apply(i).isShuffle()}


def there(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def folder(df):
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_a_written_tables_shuffles_are_gone(spark):
    before = shuffle_files(spark)
    grouped = spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(r["count"] for r in materialize(grouped, "t").collect()) == [1428] * 3 + [1429] * 4
    assert shuffle_files(spark) <= before
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    # a frame that was collected keeps its shuffle and can be written and collected again
    first = grouped.collect()
    materialize(grouped, "t")
    assert grouped.collect() == first
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    materialize(grouped, "t")
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.unset(SHUFFLE_CLEANUP)


def test_settled_leaves_its_own_table_only(spark):
    outside, made = materialize(spark.range(5), "t"), []

    def make():
        made.append(materialize(outside.where("id > 0"), "t"))
        made.append(settled(spark, lambda: materialize(made[0].where("id > 1"), "t"), "t"))
        return made[1].where("id > 2")

    with temporary_tables(spark):
        out = settled(spark, make, "t")
        paths = [folder(x) for x in made]
        assert sorted(r.id for r in out.collect()) == [3, 4]
        assert not any(there(spark, p) for p in paths)
        inner = folder(out)
        assert there(spark, inner)
    assert not there(spark, inner)
    assert outside.count() == 5


def test_an_error_leaves_the_tables_and_the_scope(spark):
    made = []

    def make():
        made.append(materialize(spark.range(3), "t"))
        raise ValueError("no result")

    with pytest.raises(ValueError):
        settled(spark, make, "t")
    assert made[0].count() == 3
    with temporary_tables(spark):
        pass
    assert made[0].count() == 3
