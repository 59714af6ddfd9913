from shelfwise.functions import codes, dates, text  # noqa: F401
