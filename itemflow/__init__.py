"""itemflow: cleaning and summarising of test-taker responses on Spark."""

from itemflow.plans.clean import CleanConfig, CleanInputs, CleanResult, clean

__all__ = ["CleanConfig", "CleanInputs", "CleanResult", "clean"]
