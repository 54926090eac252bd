"""The sixteen reports as SQL text.

``register`` names the feature tables in the session and creates temporary SQL
table functions over them; a report is then one short SELECT, which users can
change or join like any other.  The functions are SQL themselves, so Spark
plans through them: nothing is computed before a SELECT asks for it.

* ``<book>_latest()``: the newest session of the stocks, in that book's table;
* ``<book>_breadth()``: closes over and under each average on that session;
* ``<book>_top(column, n)``: the n highest rows of the session by a column, or
  the lowest for ``-column``;
* ``<book>_movers(sessions)``: each symbol's newest bar and its change in
  percent against the close so many bars earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketframe.plans.publish import register_tables
from marketframe.plans.reports import MA_COLUMNS, MOVER_COLUMNS
from marketframe.schema import FEATURE_COLUMNS, ReportParams

BOOKS = {"stocks": "daily_stocks", "etfs": "daily_etfs", "basket": "daily_basket"}
RANKED = ["rvol", "tr_comp", "pct_open_to_close", "pct_change", "pct_gap", "volume"]
TOP = ["close", *RANKED]


def _kinds(columns: list[str]) -> str:
    kinds = {"symbol": "STRING", "date": "DATE"}
    return ", ".join(f"{c} {kinds.get(c, 'DOUBLE')}" for c in columns)


def function_sql(book: str, table: str, newest_table: str) -> list[str]:
    """CREATE statements of a book's table functions."""
    make = "CREATE OR REPLACE TEMPORARY FUNCTION"
    ranked = " ".join(f"WHEN '{c}' THEN {c} WHEN '-{c}' THEN -{c}" for c in RANKED)
    sides = [(f"{word}_{label}", f"close {op} {average}") for average, label in MA_COLUMNS
             for word, op in (("over", ">"), ("under", "<"))]
    newest = ", ".join(MOVER_COLUMNS)
    return [
        f"""{make} {book}_latest() RETURNS TABLE ({_kinds(FEATURE_COLUMNS)})
RETURN SELECT {', '.join(FEATURE_COLUMNS)} FROM {table} WHERE date = (SELECT max(date) FROM {newest_table})""",
        # Over no rows the counts are null.
        f"""{make} {book}_breadth() RETURNS TABLE ({', '.join(f'{name} BIGINT' for name, _ in sides)})
RETURN SELECT {', '.join(f'sum(int(({test}) IS TRUE))' for _, test in sides)} FROM {book}_latest()""",
        # A null is last among the highest and first among the lowest.
        f"""{make} {book}_top(ranking STRING, n INT) RETURNS TABLE (symbol STRING, {_kinds(TOP)}, place INT)
RETURN SELECT * FROM (
  SELECT symbol, {', '.join(TOP)}, CAST(row_number() OVER (ORDER BY ranking LIKE '-%' AND value IS NULL DESC,
    value DESC NULLS LAST, symbol) AS INT) AS place
  FROM (SELECT *, CASE ranking {ranked} END AS value FROM {book}_latest())) WHERE place <= n""",
        f"""{make} {book}_movers(sessions INT) RETURNS TABLE (symbol STRING, change DOUBLE, {_kinds(MOVER_COLUMNS)})
RETURN SELECT symbol, try_divide(bar.close, earlier) - 1, {', '.join('bar.' + c for c in MOVER_COLUMNS)}
FROM (SELECT symbol, max(bar) AS bar, max(earlier) AS earlier
      FROM (SELECT symbol, IF(place = 1, struct({newest}), NULL) AS bar, IF(place = sessions + 1, close, NULL) AS earlier
            FROM (SELECT symbol, {newest}, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS place FROM {table})
            WHERE place <= sessions + 1)
      GROUP BY symbol)""",
    ]


def register(spark: SparkSession, tables: dict[str, DataFrame], newest: str = "stocks") -> None:
    """Name the books' tables and create their functions in this session;
    ``newest`` is the book whose last session counts as the newest."""
    register_tables({BOOKS[book]: df for book, df in tables.items()})
    for book in tables:
        for statement in function_sql(book, BOOKS[book], BOOKS[newest]):
            spark.sql(statement)


def report_texts(p: ReportParams = ReportParams()) -> dict[str, str]:
    """The SQL text of each report."""
    features = ", ".join(FEATURE_COLUMNS)
    closers = f"""SELECT {features} FROM {{book}}_latest()
WHERE (range_pct > {p.closer_high} OR range_pct < {p.closer_low}) AND rvol > {p.min_rvol} AND adv > {p.min_adv}
ORDER BY rvol DESC, symbol"""
    out = {
        "closers_with_rvol": closers.format(book="stocks"),
        "etf_closers_with_rvol": closers.format(book="etfs"),
        "advance_vs_decline": """SELECT sum(int((pct_change > 0) IS TRUE)) AS advances, sum(int((pct_change < 0) IS TRUE)) AS declines,
  sum(int((pct_change = 0) IS TRUE)) AS no_change FROM stocks_latest()""",
        "above_below_ma": "SELECT * FROM stocks_breadth()",
    }
    for report, ranking in (("top_rvol", "rvol"), ("top_tr_comp", "tr_comp"), ("gainers", "pct_open_to_close"),
                            ("losers", "-pct_open_to_close")):
        out[report] = f"SELECT symbol, {', '.join(TOP)} FROM stocks_top('{ranking}', {p.top_n}) ORDER BY place"
    for prefix, book in (("", "stocks"), ("basket_", "basket")):
        for name, sessions, moved, order in (("up_20_in_5", 5, "> 0.20", "DESC"), ("down_20_in_5", 5, "< -0.20", "ASC"),
                                             ("up_50_in_40", 40, "> 0.50", "DESC"), ("down_50_in_40", 40, "< -0.50", "ASC")):
            pct = f"pct_change_{sessions}"
            out[prefix + name] = f"""SELECT symbol, rint(change * 100 * 10) / 10 AS {pct}, {', '.join(MOVER_COLUMNS)}
FROM {book}_movers({sessions}) WHERE change {moved}D ORDER BY {pct} {order}, symbol"""
    return out
