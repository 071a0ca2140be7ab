"""Capture-to-geometry analytics as DataFrame operators."""
