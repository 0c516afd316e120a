"""The error that every gate raises."""


class GateError(ValueError):
    """Input or result that must not pass; the message names what is wrong."""
