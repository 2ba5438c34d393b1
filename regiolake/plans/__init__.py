"""Composed plans: registered queries over the driver tables, domain models, jobs."""
from .registry import COVERS, ORACLE, QUERIES  # noqa: F401


def load_all() -> None:
    """Import every query module so that its ``@query`` registrations run."""
    from . import q_contracts, q_files, q_functions, q_jobs, q_marts, q_models, q_models_real, q_quality, q_relational, q_series, q_sinks, q_sources  # noqa: F401
