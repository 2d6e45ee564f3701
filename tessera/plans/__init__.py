"""Reusable plans and the driver-query registry."""
