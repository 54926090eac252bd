from pyspark.sql import Window
from pyspark.sql import functions as F

from marketframe.operators.sequence import halo_blocks, number_rows


def test_number_rows_matches_row_number(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 7).cast("string").alias("k"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    got = number_rows(df, "k", "d", F.year("d"), total="n")
    want = df.select("k", "d", F.row_number().over(Window.partitionBy("k").orderBy("d")).alias("w"),
                     F.count(F.lit(1)).over(Window.partitionBy("k")).alias("nn"))
    j = got.join(want, ["k", "d"])
    assert j.count() == 3000
    assert j.filter((F.col("bar_no") != F.col("w")) | (F.col("n") != F.col("nn"))).count() == 0



def test_halo_blocks(spark):
    df = spark.range(1, 101).select(F.lit("a").alias("k"), F.col("id").alias("i"))
    out = halo_blocks(df, "i", block_size=30, before=5, after=2).toPandas()
    own = out[out.halo == 0]
    assert len(own) == 100 and sorted(own.i) == list(range(1, 101))
    back = out[out.halo == -1]
    # rows 26..30 serve block 1, 56..60 block 2, 86..90 block 3
    assert sorted(back.i) == [26, 27, 28, 29, 30, 56, 57, 58, 59, 60, 86, 87, 88, 89, 90]
    assert (back.block == (back.i - 1) // 30 + 1).all()
    ahead = out[out.halo == 1]
    assert sorted(ahead.i) == [31, 32, 61, 62, 91, 92]


def test_a_row_without_a_place_is_an_error(spark):
    import pytest
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from marketframe.operators.sequence import number_rows
    df = spark.createDataFrame([("A", 1), (None, 2), ("A", None)], "k string, i int")
    for bad in ("k is null", "i is null"):
        with pytest.raises(PySparkException):
            number_rows(df.where(f"{bad} or (k = 'A' and i = 1)"), "k", "i", F.floor(F.col("i") / 10)).collect()
    assert number_rows(df.where("k = 'A' and i = 1"), "k", "i", F.lit(0)).first().bar_no == 1
