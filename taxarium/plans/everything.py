"""All registered queries of the library and their SQL."""

from __future__ import annotations

from . import loads, materials, releases, taxa  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
