"""Errors raised by quality checks and extraction.

Each also inherits the built-in type that callers of a plain check would
catch, so ``except ValueError`` and ``except KeyError`` keep working.
"""


class QualityError(Exception):
    """A table did not pass a check."""

    def __str__(self) -> str:
        return ", ".join(str(part) for part in self.args)


class EmptyFactError(QualityError, ValueError):
    """The checked period of a fact holds no row."""


class TooFewRowsError(QualityError, ValueError):
    """A table holds fewer rows than the minimum."""


class NullKeyError(QualityError, KeyError):
    """Too large a share of a fact's rows has a null key."""


class DuplicateKeyError(QualityError, KeyError):
    """A dimension holds a key more than once."""


class VersionConflictError(Exception):
    """Another writer has moved a table on from the version that rows were made from."""


class FetchError(Exception):
    """A page could not be fetched within the allowed attempts."""
