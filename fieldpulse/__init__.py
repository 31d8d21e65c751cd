"""Device telemetry on Spark: decode, validate, deduplicate, store and window readings."""

from fieldpulse.operators.windows import WindowPolicy
from fieldpulse.session import build_session

__all__ = ["WindowPolicy", "build_session"]
