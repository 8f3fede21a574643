"""DataFrame -> DataFrame operators (scoring, dedupe, brief selection, ingest, link health)."""
