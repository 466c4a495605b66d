"""Sources of the posting engine."""
