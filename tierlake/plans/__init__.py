"""Layer jobs: read the layer below, transform, write."""
