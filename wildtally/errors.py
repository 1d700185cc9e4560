"""Errors that callers may tell apart."""


class InputError(ValueError):
    """The given folder, file or argument can't be used."""


class ModelDependencyError(RuntimeError):
    """A model needs a package that isn't installed."""


class ImageFailedError(RuntimeError):
    """One image can't be processed; it becomes an error of its row."""
