"""operators of the screen analysis."""
