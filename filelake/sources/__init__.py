"""Readers and writers: change feeds, objects, archives, sidecars, state tables."""
