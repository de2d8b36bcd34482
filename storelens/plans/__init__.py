"""Dimension, fact, report, feature, model and forecast plans."""
