"""Readers, writers, staging and the incremental file ledger."""
