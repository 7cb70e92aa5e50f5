"""Stateless shaping applied to captured responses as they arrive."""
