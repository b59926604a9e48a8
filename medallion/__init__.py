"""Medallion: batch and streaming lake jobs for client-registration events."""
