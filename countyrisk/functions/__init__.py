from . import casts, damage, fips, geonames, names, display  # noqa: F401
