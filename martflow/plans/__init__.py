"""Run plans composing the layers: full refresh and day re-run."""
from martflow.plans.pipeline import (  # noqa: F401
    BAD_DAY,
    FAILED,
    OK,
    Layers,
    RunResult,
    build_layers,
    publish_ads,
    run_day,
    run_full,
    write_layers,
)
