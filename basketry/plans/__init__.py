"""Session set-up, lineage and broadcast guards, and the registered plans."""
