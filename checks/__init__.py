"""Every operator run over the given tables, beside the SQL that states the same result."""

from checks import (  # noqa: F401
    aggregates, base, columns, joins, landing, model, quality, reads, spatial, streams, windows,
)
from checks.base import CHECKS
