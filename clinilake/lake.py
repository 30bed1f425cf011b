"""Zone-aware table names and paths."""

from __future__ import annotations

from dataclasses import dataclass

ZONES = ("bronze", "silver", "gold")
ENVIRONMENTS = ("dev", "test", "prod")


@dataclass(frozen=True)
class Lake:
    """Resolve ``(zone, table)`` to a storage path or a catalog identifier.

    ``root`` is a shared filesystem URI (``s3a://…``, ``abfss://…``, ``hdfs://…``
    or a local folder in tests).  With ``catalog`` set (a catalog configured
    in the session, one per environment), :meth:`table` returns
    ``<catalog>.<zone>.<table>``; without one it returns ``<env>_<zone>.<table>``
    in the session catalog, whose database :meth:`database` names and
    :meth:`ensure_database` creates under ``root``.
    """

    root: str
    env: str = "dev"
    catalog: str | None = None
    tables: bool = False  # jobs read and write catalog tables instead of zone paths
    snapshots: bool = False  # zone paths hold published snapshots, audited before readers see them

    def __post_init__(self) -> None:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"env must be one of {ENVIRONMENTS}, got {self.env!r}")
        if self.tables and self.snapshots:
            raise ValueError("a lake holds catalog tables or snapshots, not both")

    def path(self, zone: str, name: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"zone must be one of {ZONES}, got {zone!r}")
        return f"{self.root.rstrip('/')}/{self.env}/{zone}/{name}"

    def database(self, zone: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"zone must be one of {ZONES}, got {zone!r}")
        return f"{self.catalog}.{zone}" if self.catalog else f"{self.env}_{zone}"

    def table(self, zone: str, name: str) -> str:
        return f"{self.database(zone)}.{name}"

    def ensure_database(self, spark, zone: str) -> str:
        """Create the zone's database (stored under ``root``) if missing."""
        db = self.database(zone)
        location = f"{self.root.rstrip('/')}/{self.env}/{zone}_tables"
        quoted = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"create database if not exists {db} location '{quoted}'")
        return db
