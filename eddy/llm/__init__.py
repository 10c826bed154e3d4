"""Training-data pipeline operators (quality, dedup, decontamination, ...)."""
