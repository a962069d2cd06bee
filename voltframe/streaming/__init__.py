"""Incremental Silver over a landing folder; an extension, as the batch run has no streams."""
from .incremental import compact, silver, start_refinement

__all__ = ["compact", "silver", "start_refinement"]
