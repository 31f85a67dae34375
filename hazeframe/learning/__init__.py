"""Forecasting one hour ahead: features, split, models, evaluation."""
