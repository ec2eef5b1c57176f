from martloom.streaming.ingest import stream_ingest  # noqa: F401
