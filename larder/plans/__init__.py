"""Session set-up, lineage control and end-to-end jobs."""
