"""DataFrame operators: nested data, keys, sides, history, quality, progress."""
