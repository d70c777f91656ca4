"""Geographic levels: which column identifies a unit, and which columns describe it."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Level:
    name: str
    key: str
    geo_columns: tuple[str, ...]


# Level names, key columns and descriptive columns of the published tables.
SECTOR = Level(
    "setor",
    "cd_setor",
    (
        "cd_setor",
        "cd_dist",
        "nm_dist",
        "cd_subdist",
        "ds_situacao",
        "cd_situacao",
        "cd_tipo",
        "categoria_tipo_setor",
    ),
)
DISTRICT = Level("distrito", "cd_dist", ("cd_dist", "nm_dist", "cd_regiao", "nm_regiao"))


def level_named(level: str | Level) -> Level:
    """Resolve a level by name; an unknown name is an error, never a silent default."""
    if isinstance(level, Level):
        return level
    known = {each.name: each for each in (SECTOR, DISTRICT)}
    if level not in known:
        raise ValueError(f"unknown level {level!r}; expected one of {sorted(known)}")
    return known[level]
