"""Named queries over the project's tables."""
