"""functions of the screen analysis."""
