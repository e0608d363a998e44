"""Scorers and the Spark ML Estimator/Model interface."""
