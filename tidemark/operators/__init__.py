"""DataFrame operators: history, merge, dimensions, facts, quality, control."""
