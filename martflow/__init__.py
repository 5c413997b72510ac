"""Incremental, audited data marts on Spark."""

from .plans import Flow, FlowSpec, retail_spec

__all__ = ["Flow", "FlowSpec", "retail_spec"]
