"""Whole pipelines: profile, fit, tune, train, predict, monitor, register."""
