from . import audits, contracts, gold, publish, quality, serving, silver  # noqa: F401
