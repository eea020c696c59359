"""Photometric calibration of sky-survey catalogues on Spark."""
