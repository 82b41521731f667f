"""streaming of the screen analysis."""
