"""Part of the detection engine."""
