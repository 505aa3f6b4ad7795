"""Plan helpers (iteration, distributed ranking) and the query catalogue."""
