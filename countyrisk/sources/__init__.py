from . import files, landing  # noqa: F401
