"""End-to-end jobs and reports composed from the operators."""
