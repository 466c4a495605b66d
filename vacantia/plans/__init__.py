"""Plans of the posting engine."""
