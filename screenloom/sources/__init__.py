"""sources of the screen analysis."""
