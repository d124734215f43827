"""Typed errors raised by the readers, the checks and the single-series façade."""


class StockloomError(Exception):
    """Base of all errors of this package; ``subject`` names what was wrong."""

    reason = "Planning error"
    attribute = "subject"

    def __init__(self, subject: str = "", reason: str | None = None):
        setattr(self, self.attribute, subject)
        self.message = f"{reason or self.reason}: {subject}"
        super().__init__(self.message)


class MissingDatasetError(StockloomError):
    reason = "No dataset at this path"
    attribute = "file_path"


class EmptyDataFrameError(StockloomError):
    reason = "No rows in"
    attribute = "dataset_name"


class DataValidationError(StockloomError):
    reason = "Table does not pass validation"
    attribute = "detail"


class InvalidStoreError(StockloomError):
    reason = "Unknown store"
    attribute = "store_id"


class InvalidSKUError(StockloomError):
    reason = "Unknown product"
    attribute = "item_id"


class ConfigurationError(StockloomError):
    reason = "Session is not configured for this"
    attribute = "setting"
