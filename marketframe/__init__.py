"""marketframe: daily-bar analytics as Spark DataFrame plans.

Layers:
  sources    bars from ticks or Parquet, session dates, symbol universes
  functions  column helpers (rounding, safe division)
  operators  sequence numbering, halo blocks, recursive scan, feature build
  plans      user-level jobs: reports, rule study, position sizing, publish
"""

from marketframe.schema import FEATURE_COLUMNS  # noqa: F401
