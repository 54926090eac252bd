"""Symbol universes: named lists of tickers as a small (universe, symbol) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The named ticker lists of the reference, in its order.
# SP_500 (505 names) is not listed here; supply it as a table or file.
VOLATILITY = ["VIXY", "VXX"]
MAG_7 = ["AAPL", "MSFT", "GOOGL", "AMZN", "NVDA", "TSLA", "META"]
SEMIS = ["NVDA", "TSM", "AMD", "ASML", "INTC", "QCOM", "AVGO", "TXN", "ADI", "LRCX",
         "AMAT", "MRVL", "MU", "KLAC", "NXPI"]
DOW_30 = ["MMM", "AXP", "AMGN", "AAPL", "BA", "CAT", "CVX", "CSCO", "KO", "DIS",
          "DOW", "GS", "HD", "HON", "IBM", "INTC", "JNJ", "JPM", "MCD", "MRK",
          "MSFT", "NKE", "PG", "CRM", "TRV", "UNH", "VZ", "V", "WMT", "WBA"]
ETF = ["SPY", "QQQ", "IWM", "XLK", "SMH", "XLF", "KRE", "XLE", "XLV", "XLI",
       "XLY", "XLP", "XLU", "XLC", "XLB", "XBI", "SPYG", "SPYV", "SPYD", "SPTM",
       "SPLG", "SPSM", "SPDW", "SPAB", "SPMB", "TLT"]
NSDQ_100 = ["AAPL", "ADBE", "ADP", "ADSK", "AEP", "ALGN", "AMAT", "AMD", "AMGN", "AMZN",
            "ANSS", "ASML", "ATVI", "AVGO", "BIDU", "BIIB", "BKNG", "BMRN", "CDNS", "CDW",
            "CERN", "CHKP", "CHTR", "CMCSA", "COST", "CPRT", "CRWD", "CSCO", "CSX", "CTAS",
            "CTSH", "DLTR", "DOCU", "EA", "EXC", "FAST", "FB", "FISV", "GILD", "GOOG",
            "GOOGL", "HON", "IDXX", "ILMN", "INCY", "INTC", "INTU", "ISRG", "JD", "KDP",
            "KLAC", "LRCX", "LULU", "MAR", "MCHP", "MDLZ", "MELI", "MNST", "MRVL", "MSFT",
            "MTCH", "MU", "NFLX", "NTES", "NVDA", "NXPI", "OKTA", "ORLY", "PAYX", "PCAR",
            "PDD", "PEP", "PYPL", "QCOM", "REGN", "ROST", "SBUX", "SGEN", "SIRI", "SNPS",
            "SPLK", "SWKS", "TCOM", "TEAM", "TMUS", "TSLA", "TTWO", "TXN", "UAL", "VRSK",
            "VRSN", "VRTX", "WBA", "WDAY", "WDC", "XEL", "ZM", "ZS"]
BASKET = ["DIS", "SEDG", "FSLR", "OVV", "GME", "AAL", "QCOM", "UAL", "ABNB", "LYFT",
          "AMAT", "CMG", "ROST", "CVX", "DLTR", "LULU", "MSTR", "AAPL", "NRG", "UBER",
          "CVNA", "HOOD", "DAL", "AMC", "RDDT", "ARM", "TSM", "SOFI", "TOST", "COIN",
          "SLV", "LUV", "NNE", "INTC", "ROKU", "NFLX", "NVDA", "TXN", "MSFT", "GM",
          "DELL", "AXP", "SNOW", "JPM", "AMD", "FCX", "XOM", "CRWD", "CCL", "TTWO",
          "RBLX", "BAC", "WFC", "GLD", "JNJ", "TGT", "SBUX", "NKE", "DASH", "V", "F",
          "NVO", "HD", "MU", "WMT", "Z", "BIDU", "PFE", "PDD", "IBIT", "OKTA", "CHWY",
          "AMZN", "META", "GEV", "DKNG", "GS", "BA", "SE", "BABA", "C", "CPNG", "PANW",
          "MRNA", "PYPL", "AFRM", "LLY", "PLTR", "TWLO", "FUTU", "GOOGL", "CSCO", "ZM",
          "CSX", "UNH", "SQ", "CRM", "SNAP", "GE", "FTNT", "LMT", "CAVA", "MARA",
          "SHOP", "JD", "TSLA", "RIOT", "DJT", "SMCI", "RIVN"]

NAMED = {
    "BASKET": BASKET, "NSDQ_100": NSDQ_100, "VOLATILITY": VOLATILITY, "ETF": ETF,
    "DOW_30": DOW_30, "MAG_7": MAG_7, "SEMIS": SEMIS,
}

# Longer lists become a table; shorter ones a filter that reaches the scan.
IN_FILTER_SYMBOLS = 1_000


def universe_table(spark, lists: dict[str, list[str]] | None = None) -> DataFrame:
    """(universe, symbol) table from named lists; duplicates inside a list dropped."""
    lists = NAMED if lists is None else lists
    rows = sorted({(name, s) for name, syms in lists.items() for s in syms})
    return spark.createDataFrame(rows, "universe string, symbol string")


def members(universes: DataFrame, name: str) -> DataFrame:
    return universes.filter(F.col("universe") == name).select("symbol").distinct()


def restrict_to_universe(df: DataFrame, symbols, symbol_col: str = "symbol") -> DataFrame:
    """Keep rows whose symbol is in ``symbols`` (a Python list or a DataFrame
    with a ``symbol`` column).  A list becomes an IN filter that reaches the
    Parquet scan; a table becomes a left-semi join whose build side Spark
    broadcasts only when its measured size is under the broadcast threshold."""
    if isinstance(symbols, (list, tuple, set, frozenset)):
        syms = sorted(set(symbols))
        if len(syms) <= IN_FILTER_SYMBOLS:
            return df.filter(F.col(symbol_col).isin(syms))
        symbols = df.sparkSession.createDataFrame([(x,) for x in syms], "symbol string")
    right = symbols.select(F.col("symbol").alias("_u_symbol")).distinct()
    return df.join(right, F.col(symbol_col) == F.col("_u_symbol"), "left_semi")


def universe_counts(universes: DataFrame) -> DataFrame:
    """Number of distinct symbols per universe."""
    return universes.groupBy("universe").agg(F.countDistinct("symbol").alias("n_symbols"))
