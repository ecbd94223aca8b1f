from . import tables  # noqa: F401
