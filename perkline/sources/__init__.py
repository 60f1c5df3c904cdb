"""Landing, idempotent table writes and JSON-lines sources."""
