"""Assembling inputs for the plans from a folder of test tables.

``Inputs`` builds (lazily) the bars and feature tables of the three
universes the reference loads; every query in ``__spark_entry__`` starts
here, so that its work grows with the source tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from marketframe.operators.features import build_features
from marketframe.schema import FeatureParams
from marketframe.sources import testdata as td
from marketframe.sources.universe import members, restrict_to_universe


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str, params: FeatureParams = FeatureParams()):
        self.spark, self.sf_dir, self.params = spark, sf_dir, params

    @cached_property
    def universes(self) -> DataFrame:
        return td.universes(self.spark, self.sf_dir)

    @cached_property
    def stock_bars(self) -> DataFrame:
        return td.bars(self.spark, self.sf_dir, "p_brand")

    @cached_property
    def etf_bars(self) -> DataFrame:
        return td.bars(self.spark, self.sf_dir, "p_type")

    @cached_property
    def stocks(self) -> DataFrame:
        return build_features(self.stock_bars, self.params)

    @cached_property
    def etfs(self) -> DataFrame:
        return build_features(self.etf_bars, self.params)

    @cached_property
    def basket_bars(self) -> DataFrame:
        return td.basket_bars(self.spark, self.sf_dir, self.universes)

    @cached_property
    def basket(self) -> DataFrame:
        # A load of its own: the basket holds symbols that are not stocks.
        return build_features(self.basket_bars, self.params)

    @cached_property
    def basket_stocks(self) -> DataFrame:
        """Stocks that are in the basket; the bars are restricted first."""
        return build_features(restrict_to_universe(self.stock_bars, members(self.universes, "BASKET")), self.params)

    def table(self, name: str) -> DataFrame:
        return td.table(self.spark, self.sf_dir, name)


def feature_column(inputs: Inputs, col: str) -> DataFrame:
    """One feature of the stocks; only the stages it needs are planned."""
    return build_features(inputs.stock_bars, inputs.params, columns=["symbol", "date", col])
