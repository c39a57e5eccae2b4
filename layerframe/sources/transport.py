"""How a request reaches a service.

A transport is ``fetch(url, form, options) -> text``.  The connector names it as
``module:function`` so executors import it themselves; ``http`` is the default.
"""

from __future__ import annotations

import importlib
import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Mapping

Transport = Callable[[str, Mapping[str, str], Mapping[str, str]], str]

DEFAULT_TIMEOUT = 30.0


class HttpStatusError(OSError):
    """The service answered with an error status."""

    def __init__(self, status: int, url: str):
        self.status = status
        super().__init__(f"status {status} from {url}")


def form_text(value) -> str:
    """Request parameters as services expect them."""
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if isinstance(value, str) else json.dumps(value)


def http(url: str, form: Mapping[str, str], options: Mapping[str, str]) -> str:
    """One form POST; the body is text whatever content type it claims."""
    request = urllib.request.Request(url, data=urllib.parse.urlencode(form).encode())
    try:
        with urllib.request.urlopen(
            request, timeout=float(options.get("timeout", DEFAULT_TIMEOUT))
        ) as response:
            return response.read().decode("utf-8")
    except urllib.error.HTTPError as error:
        raise HttpStatusError(error.code, url) from error


def resolve(name: str | None) -> Transport:
    if not name or name == "http":
        return http
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)
