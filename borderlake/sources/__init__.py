"""Where data comes from and goes to: CSV delivery, lake tables, publication, synthetic data."""
