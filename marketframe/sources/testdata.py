"""Inputs derived from the generated test tables (see FIXTURES.md).

Ticks are ``lineitem`` rows joined to ``part``: the symbol is the part brand
(stocks) or the part type (ETF-like composites), the price is extended price
per unit and the size is the quantity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.functions.numeric import div
from marketframe.schema import ReportParams, StudyParams
from marketframe.sources.bars import resample_bars
from marketframe.sources.universe import members, restrict_to_universe


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark, sf_dir: str, by: str = "p_brand") -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", F.col(by).alias("symbol"))
    return li.join(part, li.l_partkey == part.p_partkey).select(
        "symbol",
        F.col("l_shipdate").cast("date").alias("day"),
        div("l_extendedprice", "l_quantity").alias("px"),
        F.col("l_quantity").alias("qty"),
        order_key().alias("k"),
    )


#: Digits of each part of a tick's order key, 38 in all; prices in cents.
ORDER_DIGITS = {"l_orderkey": 11, "l_linenumber": 1, "l_partkey": 8, "l_suppkey": 7, "l_quantity": 2,
                "l_extendedprice": 9}


def order_key() -> Column:
    """The six columns that order ticks of a day, as one decimal: a fixed-width
    key lets ``min_by`` and ``max_by`` run as hash aggregates (a struct key
    would have Spark sort all ticks before the partial aggregate)."""
    out, left = None, sum(ORDER_DIGITS.values())
    for name, digits in ORDER_DIGITS.items():
        left -= digits
        value = F.round(F.col(name) * 100) if name == "l_extendedprice" else F.col(name)
        part = value.cast(f"decimal({digits},0)").cast("decimal(38,0)")
        if left:
            part = (part * F.lit(str(10 ** left)).cast(f"decimal({left + 1},0)")).cast("decimal(38,0)")
        out = part if out is None else (out + part).cast("decimal(38,0)")
    return out


def bars(spark, sf_dir: str, by: str = "p_brand") -> DataFrame:
    return resample_bars(ticks(spark, sf_dir, by), F.col("day"), order=F.col("k"))


BASKET_MAX_BRAND = 10
BASKET_TYPES = 2


def basket_bars(spark, sf_dir: str, universes: DataFrame) -> DataFrame:
    """Bars of the basket's symbols, from the ticks by brand and by type."""
    both = ticks(spark, sf_dir, "p_brand").unionByName(ticks(spark, sf_dir, "p_type"))
    return resample_bars(restrict_to_universe(both, members(universes, "BASKET")), F.col("day"), order=F.col("k"))


def universes(spark, sf_dir: str) -> DataFrame:
    """SP_500 = every brand, ETF = every part type, BASKET = Brand#1..Brand#10
    and the first two part types, which are no stocks."""
    part = table(spark, sf_dir, "part")
    brands = part.select(F.col("p_brand").alias("symbol")).distinct()
    basket = brands.filter(
        F.substring_index("symbol", "#", -1).try_cast("int").between(1, BASKET_MAX_BRAND))
    etf = part.select(F.col("p_type").alias("symbol")).distinct()
    basket = basket.unionByName(etf.orderBy("symbol").limit(BASKET_TYPES))
    return (brands.select(F.lit("SP_500").alias("universe"), "symbol")
            .unionByName(basket.select(F.lit("BASKET").alias("universe"), "symbol"))
            .unionByName(etf.select(F.lit("ETF").alias("universe"), "symbol")))


# Fixture thresholds: test volumes are small and the years differ.
REPORT_PARAMS = ReportParams(min_adv=20.0)
STUDY_PARAMS = StudyParams(
    min_adv=20.0, start_exclusive="1996-01-20", end_exclusive="1998-01-01",
    symbols=tuple(f"Brand#{i}" for i in range(11, 17)))
