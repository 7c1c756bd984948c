"""Readers, writers and the views that map the shared test tables onto the retail schemas."""
