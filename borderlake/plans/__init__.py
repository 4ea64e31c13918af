"""End-to-end builds and the audit trail."""
