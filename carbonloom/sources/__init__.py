"""Readers and writers: CSV, JSON payloads, topology files, staging and fact tables."""
