"""quarrylink.operators."""
