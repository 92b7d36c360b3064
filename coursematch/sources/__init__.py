"""Readers, schemas, derived test-domain views and the result sink."""
