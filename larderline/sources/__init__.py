"""Readers: databases, document stores, files and topics."""
