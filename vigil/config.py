"""Job settings."""

from __future__ import annotations

from dataclasses import dataclass

from vigil import fixed_values as fixed


@dataclass(frozen=True)
class SlidingWindow:
    """Windows of ``size`` seconds starting every ``slide`` seconds, shifted by ``offset``.

    ``clamp`` drops windows that start before the slide step holding the first
    sample. ``origin`` is that sample's epoch second where the caller knows it;
    otherwise it is computed in the same job. ``block`` is the least span of
    window starts that are aggregated together (see ``operators.windows``).
    """

    size: int = fixed.WINDOW_SECONDS
    slide: int = fixed.SLIDE_SECONDS
    offset: int = fixed.OFFSET_SECONDS
    clamp: bool = True
    origin: int | None = None
    block: int = 3600

    def __post_init__(self):
        if self.size < 1 or self.slide < 1 or self.block < 1:
            raise ValueError("size, slide and block must be positive whole seconds")

    @property
    def block_span(self) -> int:
        """Blocks are long beside a window, so that few samples lie in reach of two."""
        return max(self.block, 8 * self.size)


@dataclass(frozen=True)
class AlertRule:
    """What one report measures and how its alert text is chosen.

    ``compares`` names the statistic ("avg" or "max") held against the
    thresholds. ``needs_both`` gives no alert when either side is null.
    ``duplicates`` says what repeated (server, second) samples do in the join:
    "first" keeps the earliest, "multiply" pairs each with each.
    """

    left: str
    right: str
    left_name: str
    right_name: str
    left_threshold: str
    right_threshold: str
    texts: tuple[str, str, str]
    compares: str
    needs_both: bool
    duplicates: str
    timestamps: str


CPU_MEM = AlertRule(
    left="cpu_pct",
    right="mem_pct",
    left_name="cpu",
    right_name="mem",
    left_threshold="cpu_threshold",
    right_threshold="mem_threshold",
    texts=fixed.CPU_MEM_ALERTS,
    compares="avg",
    needs_both=True,
    duplicates="first",
    timestamps="lenient",
)

NET_DISK = AlertRule(
    left="net_in",
    right="disk_io",
    left_name="net_in",
    right_name="disk_io",
    left_threshold="net_in_threshold",
    right_threshold="disk_io_threshold",
    texts=fixed.NET_DISK_ALERTS,
    compares="max",
    needs_both=False,
    duplicates="multiply",
    timestamps="strict",
)
