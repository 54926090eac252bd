"""User-level jobs built on the feature table."""
