"""Entity configuration: which snapshot feeds which target, and how changes are applied."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapledger.functions.columns import find_column

CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("config_id", T.LongType(), False),
        T.StructField("entity_name", T.StringType(), False),
        T.StructField("source_table", T.StringType(), False),
        T.StructField("target_table", T.StringType(), False),
        T.StructField("primary_key_column", T.StringType(), False),
        T.StructField("delete_strategy", T.StringType()),
        T.StructField("error_strategy", T.StringType()),
        T.StructField("update_strategy", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

# Columns that a configuration table may have besides; without them the defaults hold.
OPTIONAL_SCHEMA = T.StructType(
    [
        T.StructField("hash_nulls", T.StringType()),
        T.StructField("dup_includes_empty_key", T.BooleanType()),
        T.StructField("length_limits", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("allow_empty_snapshot", T.BooleanType()),
        T.StructField("distinct_update_ts", T.BooleanType()),
        T.StructField("before_images", T.BooleanType()),
    ]
)

_ALLOWED = {
    "update_strategy": ("HISTORY", "OVERWRITE"),
    "delete_strategy": ("SOFT", "HARD"),
    "error_strategy": ("CONTINUE", "STOP"),
    "hash_nulls": ("keep", "drop"),
}


class ConfigError(ValueError):
    """The configuration of an entity is missing or cannot be used."""


@dataclass(frozen=True)
class EntityConfig:
    """One configured entity.

    ``update_strategy``  HISTORY closes the old version and opens a new one, OVERWRITE replaces it.
    ``delete_strategy``  SOFT closes the active row, HARD removes it (closed history stays).
    ``error_strategy``   CONTINUE logs errors and goes on, STOP fails the entity if there is any.
    ``hash_nulls``       whether a NULL column takes part in the row hash.
    ``dup_includes_empty_key``  whether rows with key ``''`` count in the duplicate checks.
    ``length_limits``    column -> most characters the target holds; a longer new value fails the entity.
    ``allow_empty_snapshot``    whether an empty snapshot may delete every active row.
    ``distinct_update_ts``      give every update of a run its own microsecond, in key order; only with
                         HISTORY, where versions follow one another.
    ``before_images``    keep the rows that a run ends as they were, so that readers of the feed need not
                         look them up in older versions; costs a scan of the active rows per run.
    ``target_table``     names the place of the target in the store.
    """

    config_id: int
    entity_name: str
    source_table: str
    target_table: str
    primary_key_column: str
    delete_strategy: str = "SOFT"
    error_strategy: str = "CONTINUE"
    update_strategy: str = "HISTORY"
    is_active: bool = True
    hash_nulls: str = "keep"
    dup_includes_empty_key: bool = True
    length_limits: dict[str, int] = field(default_factory=dict)
    allow_empty_snapshot: bool = True
    distinct_update_ts: bool = False
    before_images: bool = False

    def __post_init__(self) -> None:
        for name in ("update_strategy", "delete_strategy", "error_strategy"):
            value = getattr(self, name)
            object.__setattr__(self, name, value.upper() if isinstance(value, str) else value)

    def validate(self) -> "EntityConfig":
        for name, allowed in _ALLOWED.items():
            value = getattr(self, name)
            if value not in allowed:
                raise ConfigError(
                    f"entity {self.entity_name}: {name} is {value!r}, expected one of {', '.join(allowed)}"
                )
        for name in ("entity_name", "target_table"):
            if getattr(self, name) in (None, "", ".", ".."):
                raise ConfigError(f"entity {self.entity_name!r}: {name} cannot be {getattr(self, name)!r}")
        if not self.primary_key_column:
            raise ConfigError(f"entity {self.entity_name}: no primary key column")
        return self


def with_key_of(cfg: EntityConfig, columns: list[str]) -> EntityConfig:
    """The configuration with its key spelled as in the data."""
    key = find_column(columns, cfg.primary_key_column)
    if key is None:
        raise ConfigError(f"entity {cfg.entity_name}: no key column {cfg.primary_key_column}")
    return replace(cfg, primary_key_column=key)


def load_configs(config_table: DataFrame) -> list[EntityConfig]:
    """Active configurations in order of their id. The table holds one row per entity; a value that
    is NULL, and an optional column that is missing, stand for the default."""
    optional = [n for n in OPTIONAL_SCHEMA.fieldNames() if find_column(config_table.columns, n)]
    rows = (
        config_table.select(*CONFIG_SCHEMA.fieldNames(), *optional)
        .where(F.col("is_active"))
        .orderBy("config_id")
        .collect()
    )
    return [EntityConfig(**{k: v for k, v in row.asDict().items() if v is not None}) for row in rows]


def declared_limits(schema: T.StructType) -> dict[str, int]:
    """The lengths of a declared target: its ``char(n)`` and ``varchar(n)`` columns."""
    limits = {f.name: f.dataType.length for f in schema if isinstance(f.dataType, (T.CharType, T.VarcharType))}
    for f in schema:
        declared = str(f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", ""))
        if declared.endswith(")"):
            limits[f.name] = int(declared[:-1].rpartition("(")[2])
    return limits


def plain_schema(schema: T.StructType) -> T.StructType:
    """The schema with text of any length in place of ``char(n)`` and ``varchar(n)``."""
    kind = lambda t: T.StringType() if isinstance(t, (T.CharType, T.VarcharType)) else t
    return T.StructType([T.StructField(f.name, kind(f.dataType), f.nullable) for f in schema])


def find_config(configs: list[EntityConfig], config_id: int) -> EntityConfig:
    for cfg in configs:
        if cfg.config_id == config_id and cfg.is_active:
            return cfg
    raise ConfigError(f"no active configuration with id {config_id}")
