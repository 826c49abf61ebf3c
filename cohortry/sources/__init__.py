"""Table schemas, loading, generated users, load checks, and the test tables."""
