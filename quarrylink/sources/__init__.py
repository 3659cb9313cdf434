"""quarrylink.sources."""
