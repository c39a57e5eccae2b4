"""Error conditions raised while a query is being planned on the driver."""


class LayerError(ValueError):
    """Base class of everything this package raises itself."""


class MissingFieldError(LayerError):
    """A requested field is not part of the layer's schema."""

    def __init__(self, missing, available):
        self.missing = list(missing)
        super().__init__(
            f"field(s) {self.missing} not in layer; available: {list(available)}"
        )


class TruncatedPageError(LayerError):
    """A page reported that its rows were cut off and could not be completed."""


class ServiceError(LayerError):
    """A service answered with an error document or an unusable payload."""
