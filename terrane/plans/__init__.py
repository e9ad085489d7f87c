"""End-to-end jobs that chain the operators and write their tables."""
