"""Readers and writers of the documents the engine works on."""
