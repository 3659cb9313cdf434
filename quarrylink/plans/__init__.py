"""quarrylink.plans."""
