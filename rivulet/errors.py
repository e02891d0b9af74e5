class ValidationError(RuntimeError):
    """A data-quality rule failed; the run must not go on."""
