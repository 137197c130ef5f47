"""The three programs: prepare, train, score."""
