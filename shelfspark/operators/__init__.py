"""DataFrame transforms of the catalog."""
