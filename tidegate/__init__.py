"""Device-telemetry lakehouse operators for PySpark.

Raw JSON envelopes are landed once per distinct message in a *bronze* history,
then fanned out to one typed *silver* dataset per device template.  Every
transform is a plain ``DataFrame -> DataFrame`` function, so the same code runs
in batch and in Structured Streaming.
"""

from tidegate.config import Layout, RunConfig
from tidegate.operators.bronze import to_bronze
from tidegate.operators.merge import MergeSpec, merge_insert
from tidegate.operators.silver import to_silver
from tidegate.sources.templates import Template, compile_templates

__all__ = [
    "Layout",
    "MergeSpec",
    "RunConfig",
    "Template",
    "compile_templates",
    "merge_insert",
    "to_bronze",
    "to_silver",
]
