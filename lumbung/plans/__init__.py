from lumbung.plans.pipeline import LoadSummary, PipelineConfig, run_pipeline
from lumbung.plans.staging import build_staging
from lumbung.plans.warehouse import build_dimensions, build_facts

__all__ = [
    "LoadSummary",
    "PipelineConfig",
    "build_dimensions",
    "build_facts",
    "build_staging",
    "run_pipeline",
]
