"""Errors a caller can act on."""


class SpecError(ValueError):
    """The declarative specification is malformed or inconsistent."""


class UnsatisfiableError(SpecError):
    """The specification is well formed but no data can satisfy it."""


class CodedError(RuntimeError):
    """A failure with a stable code that ends up in the run diagnostics."""

    def __init__(self, code: str, message: str) -> None:
        super().__init__(message)
        self.code = code


class LoadError(CodedError):
    """Loading a table or saving a query result failed."""


class CompareError(CodedError):
    """Two results cannot be compared."""
