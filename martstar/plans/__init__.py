"""Job-level compositions (load, initial setup, daily update, full run)."""
