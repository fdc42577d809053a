"""DataFrame transforms of small-area statistics."""
