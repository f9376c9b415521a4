import pytest
from pyspark.sql import functions as F

from tallyroll.llm import common, lines, minhash
from tallyroll.session import shared_folder


def folders(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(path)}


def test_a_scratch_keeps_what_it_is_told_to(spark):
    before = folders(spark)
    with common.scratch() as keep:
        with common.scratch() as keep_inside:
            a = common.written(spark.range(3))
            b = keep_inside(common.written(a.where("id > 0")))
        c = keep(common.written(b.where("id > 1")))
    assert [r.id for r in c.collect()] == [2]
    assert len(folders(spark) - before) == 1
    with pytest.raises(Exception, match="exist"):
        b.collect()
    common.drop_written(c)
    assert folders(spark) == before


def test_operators_leave_only_what_their_result_reads(spark, docs_of):
    base = " ".join(f"word{i}" for i in range(40))
    docs = docs_of([(i, base.replace(f"word{i} ", f"other{i} ")) for i in range(12)])
    for operator, left in ((lines.line_report, 1), (minhash.near_duplicates, 2)):
        before = folders(spark)
        result = operator(docs)
        assert result.count() == 12
        read = [f for f in folders(spark) - before if any(f in file for file in result.inputFiles())]
        assert len(folders(spark) - before) == len(read) == left


def test_several_totals_at_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id", F.lit(1).cast("long").alias("one"))
    rows = common.running_totals(df, ["g"], ["id"], ["id", "one"], ["ids", "n"]).collect()
    for r in rows:
        of_group = range(r["g"], r["id"] + 1, 3)
        assert (r["ids"], r["n"]) == (sum(of_group), len(of_group))
