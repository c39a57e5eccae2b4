"""layerframe: feature-layer data as Spark DataFrames."""

from layerframe.errors import LayerError, MissingFieldError, ServiceError, TruncatedPageError
from layerframe.operators.layer import Layer
from layerframe.schema import Field, fields_of, struct_type

__all__ = [
    "Field",
    "Layer",
    "LayerError",
    "MissingFieldError",
    "ServiceError",
    "TruncatedPageError",
    "fields_of",
    "struct_type",
]
