"""Typed errors; every one derives from :class:`IngestError`."""


class IngestError(Exception):
    """Base class for errors raised by this package."""


class EmptySourceError(IngestError):
    """The source delivered no rows at all."""


class UnsupportedSourceError(IngestError):
    """The source type or format is not one this package reads."""


class ConstraintError(IngestError):
    """Rows break a constraint of the target table."""


class SequenceOverflowError(IngestError):
    """A batch holds more rows than the sequence id has digits for."""


class ConcurrentCommitError(IngestError):
    """Another writer committed the same table version first."""


class PhaseError(IngestError):
    """A batch phase failed; carries the rows counted so far."""

    def __init__(self, phase, rows, cause):
        super().__init__(f"could not {phase} the batch, {rows} rows in: {cause}")
        self.phase = phase
        self.rows = rows
