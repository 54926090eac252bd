from marketframe.plans import sizing as Z
from marketframe.schema import TRADE_IDEAS_SCHEMA


def test_sizing_cases(spark):
    ideas = spark.createDataFrame([
        (1, "100000", "0.01", 50.0, 48.0, 56.0),   # 500 shares, cost 25,000
        (2, "100000", "0.01", 50.0, 49.99, 60.0),  # capped by the portfolio: 2,000 shares
        (3, "abc", "0.01", 50.0, 48.0, 56.0),      # bad text
        (4, "100000", "0.01", 50.0, 50.0, 56.0),   # zero risk per share
        (5, "100000", "0.01", 50.0, 52.0, 44.0),   # short: stop above entry
    ], TRADE_IDEAS_SCHEMA)
    s = {r.idea_id: r for r in Z.size_positions(ideas).collect()}
    assert s[1].shares == 500 and s[1].total_cost == 25000.0 and s[1].rr_ratio == 3.0
    assert s[1].total_profit == 3000.0 and s[1].total_risk == 1000.0
    assert abs(s[2].shares - 2000) < 1e-9
    assert s[3].valid is False and s[3].shares is None
    assert s[4].valid is False and s[4].shares is None and s[4].rr_ratio is None
    assert s[5].shares == 500 and s[5].rr_ratio == 3.0
    lab = {r.idea_id: r for r in Z.position_labels(ideas).collect()}
    assert lab[1].shares_label == "500" and lab[1].total_cost_label == "25,000.00"
    ra = {r.idea_id: r for r in Z.risk_amount(ideas).collect()}
    assert ra[3].risk_amount_label == "Invalid input." and ra[1].risk_amount == 1000.0


def test_ideas_are_numbered_in_symbol_order(spark):
    symbols = [f"B{i:03d}" for i in range(57)]
    df = spark.createDataFrame([(x, 1.0, 1.0, 1.0) for x in reversed(symbols)], "symbol string, close double, low double, high double")
    ids = Z.ideas_from_session(df.withColumn("close", df.close + df.symbol.substr(2, 3).cast("int"))).collect()
    assert sorted((r.idea_id, r.entry) for r in ids) == [(i + 1, 1.0 + i) for i in range(57)]
