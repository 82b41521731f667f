"""plans of the screen analysis."""
