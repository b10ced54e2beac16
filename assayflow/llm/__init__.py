"""Text operators for training-data preparation; nothing outside this package imports it."""
