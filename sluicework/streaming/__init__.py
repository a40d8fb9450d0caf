"""Structured Streaming forms of the batch operators; extensions, since loads are batch otherwise."""
