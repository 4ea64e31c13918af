"""Column functions: text, contract rules, masking, residency."""
