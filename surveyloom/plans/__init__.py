"""The household survey as a composition of the operators."""

from .household import (  # noqa: F401
    build_household,
    clean_scenario,
    derive_household,
    final_dataset,
    household_target,
    logical_checks,
    model_views,
    profile_tables,
    scenario_dataset,
    select_region,
)
from .modelling import (  # noqa: F401
    BENCHMARK_CONFIGS,
    Benchmark,
    column_roles,
    explore,
    objectives,
    run_benchmark,
)
