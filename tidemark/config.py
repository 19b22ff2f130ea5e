"""Job parameters and their domains."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from tidemark.schema import DLQ_TOPIC, SOURCE_TOPIC


def strict_flag(value: str, name: str) -> bool:
    """Read an opt-in switch; anything but the two exact words is an error."""
    flags = {"true": True, "false": False}
    if value not in flags:
        raise ValueError(f"{name} must be exactly 'true' or 'false'")
    return flags[value]


def probability(value: float | str) -> float:
    try:
        number = float(value)
    except (TypeError, ValueError) as exc:
        raise ValueError("must be a number between 0 and 1") from exc
    if not 0.0 <= number <= 1.0:
        raise ValueError("must be between 0 and 1 inclusive")
    return number


def positive_finite(value: float | str) -> float:
    number = float(value)
    if not (math.isfinite(number) and number > 0):
        raise ValueError("must be a positive finite number")
    return number


def non_negative_int(value: int | str) -> int:
    number = int(value)
    if number < 0:
        raise ValueError("must be zero or greater")
    return number


@dataclass(frozen=True)
class PipelineConfig:
    """Settings of the streaming job, checked when it is built."""

    source_topic: str = SOURCE_TOPIC
    dlq_topic: str = DLQ_TOPIC
    parallelism: int = 4
    out_of_order_ms: int = 10_000
    idle_ms: int = 30_000
    trigger: str = "10 seconds"
    max_offsets_per_trigger: int | None = None
    preview_rate: float = 0.05
    tenant_state: bool = False
    idempotent: bool = False
    jdbc_batch_size: int = 1_000
    sink_rows: int = 1_000_000
    sink_interval_ms: int = 60_000
    sink_retries: int = 5

    def __post_init__(self) -> None:
        if self.parallelism < 1 or self.out_of_order_ms < 0 or self.idle_ms < 1:
            raise ValueError("parallelism and idle_ms must be positive, out_of_order_ms zero or more")
        if self.jdbc_batch_size < 1 or self.sink_rows < 1 or self.sink_interval_ms < 1 or self.sink_retries < 0:
            raise ValueError("batch sizes and intervals must be positive and sink_retries zero or more")
        if self.max_offsets_per_trigger is not None and self.max_offsets_per_trigger < 1:
            raise ValueError("max_offsets_per_trigger must be positive")
        probability(self.preview_rate)

    @classmethod
    def from_settings(cls, settings: Mapping[str, str]) -> PipelineConfig:
        """Build from text settings such as a properties file or environment mapping."""
        return cls(
            source_topic=settings.get("source_topic", SOURCE_TOPIC),
            dlq_topic=settings.get("dlq_topic", DLQ_TOPIC),
            parallelism=int(settings.get("parallelism", "4")),
            out_of_order_ms=1_000 * int(settings.get("out_of_order_seconds", "10")),
            idle_ms=1_000 * int(settings.get("idle_seconds", "30")),
            preview_rate=float(settings.get("preview_rate", "0.05")),
            tenant_state=strict_flag(settings.get("tenant_state", "false"), "tenant_state"),
            max_offsets_per_trigger=int(settings["max_offsets_per_trigger"]) if "max_offsets_per_trigger" in settings else None,
            sink_rows=int(settings.get("sink_rows", "1000000")),
            sink_interval_ms=int(settings.get("sink_interval_ms", "60000")),
            sink_retries=int(settings.get("sink_retries", "5")),
        )
