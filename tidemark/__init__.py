"""tidemark: telemetry validation, event-time observation and analytics on Spark."""

from tidemark.config import PipelineConfig
from tidemark.session import build_session, configure

__all__ = ["PipelineConfig", "build_session", "configure"]
