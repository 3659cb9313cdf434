"""quarrylink.functions."""
