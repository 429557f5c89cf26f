"""Profiles, findings and result tables composed from the operators."""
