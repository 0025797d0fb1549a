"""Configurable change data capture between full table snapshots, as Spark DataFrame operators."""

from snapledger.config import EntityConfig, load_configs
from snapledger.functions.hashing import with_row_hash
from snapledger.plans.apply import CdcResult, apply_cdc
from snapledger.plans.run import run, run_entity
from snapledger.sources.store import VersionStore

__all__ = [
    "CdcResult",
    "EntityConfig",
    "VersionStore",
    "apply_cdc",
    "load_configs",
    "run",
    "run_entity",
    "with_row_hash",
]
