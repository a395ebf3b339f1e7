"""Exceptions raised on the driver while compiling or finishing a step."""


class DropgateError(Exception):
    """Base class."""


class RegistryError(DropgateError):
    """A registry names an unknown function or gives bad parameters.

    Raised at compile time, before any data is read.
    """


class TransformError(DropgateError):
    """A transform cannot be applied to a dataset's schema."""


class NoInputFilesError(DropgateError):
    """A step found no input files."""

    def __init__(self, step: str, path: str):
        super().__init__(f"[{step}] no input files found in '{path}'")
        self.step = step
        self.path = path


class AllFilesFailedError(DropgateError):
    """Every file of a step failed."""


class ConcurrentWriteError(DropgateError):
    """A published table changed between the read and the write of one writer."""


class UndeliveredRowsError(DropgateError):
    """The input was not cleared, as not all of its rows are accounted for."""


class TableNotFoundError(DropgateError, FileNotFoundError):
    """A named catalog table does not exist."""
