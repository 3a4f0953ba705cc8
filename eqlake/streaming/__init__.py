from eqlake.streaming.daily_ingest import start_daily_ingest  # noqa: F401
