"""Readers and writers: table specs, day folders, paged sources, versions."""
