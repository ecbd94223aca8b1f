from . import allocate, checks, dedupe, keys, ranking, resolve, rollups  # noqa: F401
