from marketframe.sources.bars import (  # noqa: F401
    normalise_bars, resample_bars, scan_bars, session_date, session_date_column,
)
from marketframe.sources.universe import restrict_to_universe, universe_table  # noqa: F401
