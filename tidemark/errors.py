"""Errors that callers may want to tell apart."""


class NothingToMergeError(ValueError):
    """Only one input was found and there is no existing target to merge it with."""


class EmptySourceError(ValueError):
    """The source table has no rows, so there is nothing to extract."""


class ConflictError(FileExistsError):
    """Output or unfinished work exists and the conflict policy is ERROR."""


class MissingTableError(KeyError):
    """The source has no table of that name."""


class UnsupportedTypeError(TypeError):
    """A column has a type that no Spark type stands for."""
