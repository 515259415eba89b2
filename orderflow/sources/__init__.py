"""Readers, writers, manifests and the published target."""
