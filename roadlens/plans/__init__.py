"""Whole analyses: marts, feature table, severity model."""
