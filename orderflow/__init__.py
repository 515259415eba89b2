"""orderflow: DataFrame operators for order-data pipelines on Spark."""

from orderflow.context import PipelineConfig, RunContext

__all__ = ["PipelineConfig", "RunContext"]
