"""Decorate large claim tables with surgery categories and flags, on Spark."""

from claimloom.plans import Rules, SurgeryDecorator, decorate

__all__ = ["Rules", "SurgeryDecorator", "decorate"]
