"""Exceptions raised by the data-quality and contract checks."""


class ValidationError(RuntimeError):
    """A source, export or prepared table breaks its contract."""


class MissingSourceError(ValidationError):
    """None of the candidate locations of a source exists."""
