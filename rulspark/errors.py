"""Errors raised when an input breaks a layer's contract."""


class MissingColumns(ValueError):
    def __init__(self, missing, available):
        self.missing, self.available = list(missing), list(available)
        super().__init__(f"missing columns {self.missing}; available: {self.available}")


class MissingSections(ValueError):
    """A baseline document lacks a required section."""


class NoActuals(ValueError):
    """A join of predictions and labels produced no usable label."""


class NothingFound(FileNotFoundError):
    """A layer holds no data for what was asked."""


class DuplicateKeys(ValueError):
    """Rows that had to be unique on their keys are not."""


class NoPredictions(RuntimeError):
    """No engine was long enough to be scored."""
