"""Readers, writers and the mapping of raw tables to the frames that the reports work on."""
