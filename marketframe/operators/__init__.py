from marketframe.operators.features import build_features  # noqa: F401
from marketframe.operators.sequence import halo_blocks, number_rows  # noqa: F401
