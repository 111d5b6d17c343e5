"""Data operators: flatten, claims analytics, quality rules, drift, payments, masking."""
