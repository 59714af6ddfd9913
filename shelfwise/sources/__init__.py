from shelfwise.sources.tables import load_sources, read_driver_tables  # noqa: F401
