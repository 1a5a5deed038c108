"""Cleaning, baselines, detectors, forecasts and graph scores."""
