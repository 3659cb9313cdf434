"""quarrylink.streaming."""
