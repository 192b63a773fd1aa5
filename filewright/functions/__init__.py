"""Filewright subpackage."""
