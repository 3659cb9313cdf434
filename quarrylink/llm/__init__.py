"""Training-data pipeline operators. Nothing else in quarrylink imports this subpackage."""
