"""Operators on detections, cells and time series."""
