"""Parameters of the tick pipeline."""

from __future__ import annotations

from dataclasses import dataclass

# The defaults every stage of the pipeline agrees on.
BIN_MS = 10
SECOND_MS = 1_000
MINUTE_MS = 60_000
FIVE_MINUTES_MS = 300_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000
MAX_LATE_MS = 500
FLUSH_MINUTES = 5
DEFAULT_SYMBOL = "WDC"
UNKNOWN_SYMBOL = "UNKNOWN"
BARS_PER_SYMBOL = 600
METRICS_WINDOW = 120
IDLE_SETTLE_MS = 120_000
SETTLE_GRACE_MS = 2_000
TOLERANCE = 1e-6


@dataclass(frozen=True)
class Settings:
    """One run's parameters; ``now_ms`` stands in for the wall clock so that runs repeat."""

    bin_ms: int = BIN_MS
    max_late_ms: int = MAX_LATE_MS
    flush_minutes: int = FLUSH_MINUTES
    bars_per_symbol: int = BARS_PER_SYMBOL
    metrics_window: int = METRICS_WINDOW

    def __post_init__(self) -> None:
        if self.bin_ms <= 0:
            raise ValueError("bin_ms must be positive")
        if self.max_late_ms < 0:
            raise ValueError("max_late_ms must not be negative")
        if self.flush_minutes <= 0:
            raise ValueError("flush_minutes must be positive")
