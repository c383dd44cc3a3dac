"""Everything a job can be tuned by, in one place."""

from __future__ import annotations

from dataclasses import dataclass, field

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


@dataclass(frozen=True)
class JobParams:
    """Thresholds, windows and time bounds. Frozen, so one instance can be shared by all queries."""

    # Fixed values of the reference questions; change them only to ask a different question.
    carriers: tuple[str, ...] = ("AA", "DL", "UA", "WN")
    late_minutes: float = 15.0
    severe_minutes: float = 30.0
    min_flights: int = 30
    top_airports: int = 10
    top_flights: int = 20
    quantiles: tuple[tuple[str, float], ...] = (("p25", 0.25), ("p50", 0.50), ("p75", 0.75), ("p90", 0.90))
    sketch_accuracy: float = 0.01
    sketch_max_bins: int = 2048
    dataset_start_ms: int = 1_735_689_600_000  # 2025-01-01 00:00:00 UTC

    # Event-time handling, in minutes.
    watermark_delay: int = 10
    allowed_lateness: int = 5
    lateness_overrides: dict[str, int] = field(default_factory=dict)
    # Of several inputs: the slowest one's watermark counts (min), or the fastest one's (max).
    watermark_policy: str = "min"
    # Tasks over which a stream's state is spread, fixed by its first start; 0: the session's shuffle partitions.
    state_partitions: int = 0

    # How often the since-start results are repeated.
    airport_snapshot_ms: int = HOUR_MS
    delay_snapshot_ms: int = DAY_MS

    def lateness_for(self, query: str) -> int:
        """Allowed lateness of one query (``q1``, ``q2_1h``, ``q2_6h``, ``q3_1d``, ``q3_7d``)."""
        return self.lateness_overrides.get(query, self.allowed_lateness)


@dataclass(frozen=True)
class StreamSettings:
    """Where a stream reads and writes, and how much a micro-batch takes at most."""

    bootstrap_servers: str
    input_topic: str
    output_topics: dict[str, str]
    default_topic: str
    group_id: str = "skyledger"
    # Without a limit the first micro-batch of a long topic would be all of it.
    max_offsets_per_trigger: int = 5_000_000
    max_files_per_trigger: int = 1000
