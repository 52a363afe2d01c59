"""Profiles, readers and tables in a shared folder."""
