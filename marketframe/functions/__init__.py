from marketframe.functions.numeric import div, nan_to_null, rnd  # noqa: F401
