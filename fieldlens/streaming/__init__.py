"""Re-runnable ingest of new scenes."""
