"""Parameters of the pipelines.

The message field names and action values live outside the original code
base, so they are parameters here (``ActionConfig``). Window geometry is a
``WindowSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must match the behaviour being reproduced.
USER_KEY_TEMPLATE = "USER_CLICK_SHOW_5MIN_%s"   # keyed store key of a user profile
REFERENCE_WINDOW_SECONDS = 5                     # window length of both pipelines
REFERENCE_STEP_SECONDS = 1                       # trigger step of both pipelines
FEED_LENGTHS_SECONDS = (300, 7200, 14400)        # declared feed windows: 5 min, 2 h, 4 h

# Largest number of windows a single row may be copied into (length / step)
# unless a caller sets its own ``max_fanout``: the declared 4 h feed window
# at the 1 s trigger step.
MAX_WINDOW_FANOUT = 14400


@dataclass(frozen=True)
class ActionConfig:
    """JSON keys of a raw message and the two accepted action values."""

    type_key: str = "t"
    user_key: str = "u"
    content_key: str = "contid"
    watch_key: str = "tm"
    duration_key: str = "duration"
    click_value: str = "click"
    show_value: str = "show"


@dataclass(frozen=True)
class WindowSpec:
    """Window geometry in whole seconds.

    ``mode='half_open'`` gives windows ``[T - length, T)``; ``mode='inclusive'``
    gives ``[T - length, T]`` on whole seconds (length + 1 distinct seconds),
    which is what a timeout queue with whole-second stamps keeps live.
    Triggers ``T`` are multiples of ``step`` counted from the epoch.
    ``min_records`` is the per-window gate: a window whose total record count
    (over all keys) is below it yields nothing. 1 disables the gate.
    """

    length: int
    step: int | None = None
    mode: str = "half_open"
    min_records: int = 1
    max_fanout: int = MAX_WINDOW_FANOUT

    def __post_init__(self):
        if self.length <= 0:
            raise ValueError("window length must be positive")
        if self.step is not None and self.step <= 0:
            raise ValueError("window step must be positive")
        if self.mode not in ("half_open", "inclusive"):
            raise ValueError(f"unknown window mode {self.mode!r}")
        if self.min_records < 1:
            raise ValueError("min_records must be >= 1")

    @property
    def slide(self) -> int:
        return self.length if self.step is None else self.step

    @property
    def span(self) -> int:
        """Length of the window as a Spark half-open interval, in seconds."""
        return self.length + 1 if self.mode == "inclusive" else self.length

    @property
    def is_tumbling(self) -> bool:
        """True when every record falls into exactly one window."""
        return self.mode == "half_open" and self.slide == self.length

    @property
    def fanout(self) -> int:
        """Upper bound of the number of windows one record falls into."""
        return -(-self.span // self.slide)

    def check_fanout(self) -> None:
        if self.fanout > self.max_fanout:
            raise ValueError(
                f"window {self.length}s / step {self.slide}s copies each row into "
                f"{self.fanout} windows (limit {self.max_fanout}); raise max_fanout, "
                "use a coarser step or the rolling operator")


REFERENCE_SPEC = WindowSpec(REFERENCE_WINDOW_SECONDS, REFERENCE_STEP_SECONDS,
                            mode="inclusive", min_records=2)
