"""Print compact physical-plan outlines of the headline operators.

usage: python tools/plans.py [sf_dir]   (default /root/testdata/sf0.01)
Keeps only the lines that matter for scale: exchanges, sorts, windows,
aggregates, joins, limits and scans with their pushed filters.
"""

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

import marketframe.operators.features as FE  # noqa: E402
import marketframe.operators.scan as SC  # noqa: E402
import marketframe.session as S  # noqa: E402
from marketframe.plans import publish as PB  # noqa: E402
from marketframe.plans import reports as R  # noqa: E402
from marketframe.plans import study as T  # noqa: E402
from marketframe.plans.pipeline import Inputs  # noqa: E402
from marketframe.sources.testdata import REPORT_PARAMS, STUDY_PARAMS  # noqa: E402

KEEP = re.compile(r"(Exchange|Sort \[|Window|Aggregate|Join|TakeOrdered|WindowGroupLimit|Scan|Generate|Broadcast)")


def outline(plan: str) -> str:
    out = []
    for line in plan.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            m = re.search(r"(PushedFilters: \[[^\]]*\])", line)
            line = line[:150] + (f" ... {m.group(1)[:160]}" if m and m.group(1) not in line[:150] else "")
            out.append(line.rstrip())
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = S.get_session()
    captured = []
    orig = S.materialize

    def spy(df):
        captured.append(df._jdf.queryExecution().executedPlan().toString())
        return orig(df)

    S.materialize = spy
    FE.materialize = spy
    SC.materialize = spy
    inp = Inputs(spark, sf)
    sections = [("resample_bars (ticks -> bars)", inp.stock_bars._jdf.queryExecution().executedPlan().toString())]
    feats = inp.stocks
    sections.append(("features: windowed pass, written once (numbering + halo shuffles, one sort)", captured[0]))
    sections.append(("features: carry fold and final per-row pass", feats._jdf.queryExecution().executedPlan().toString()))
    root = tempfile.mkdtemp(prefix="plans-")
    v = PB.publish_features(feats, root, "SP_500", "p")
    pub = PB.read_features(spark, v, "SP_500")
    d = str(pub.agg(F.max("date")).first()[0])
    for name, df in [("gainers (top-k on the published table, literal session)", R.gainers(pub, as_of=d)),
                     ("closers_with_rvol (published table)", R.closers_with_rvol(pub, REPORT_PARAMS, as_of=d)),
                     ("down_20_in_5 (movers)", R.down_20_in_5(pub)),
                     ("label_exits (study, published table)", T.label_exits(pub, STUDY_PARAMS))]:
        sections.append((name, df._jdf.queryExecution().executedPlan().toString()))
    print("# Plan outlines\n")
    print(f"Generated by `python tools/plans.py {sf}` (before AQE re-planning).\n")
    for name, plan in sections:
        print(f"## {name}\n\n```\n{outline(plan)}\n```\n")


if __name__ == "__main__":
    main()
