"""Sources, sinks and catalog helpers."""
