"""Column roles: one DataFrame carries target, id, group, time and features together.

The audited workflow keeps ``X`` and ``y`` as two frames aligned by position; on a
cluster there is no position, so every operator takes one DataFrame plus a
:class:`Roles` record and never splits rows from their labels.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .functions.numeric import NUMERIC_TYPES
from .functions.tiers import time_named


@dataclass(frozen=True)
class Roles:
    target: str
    id: str | None = None
    group: str | None = None
    time: str | None = None
    row_key: str | None = None
    exclude: tuple = field(default_factory=tuple)

    def with_(self, **kw) -> "Roles":
        return replace(self, **kw)

    # -- schema walk (no job) -------------------------------------------------
    def check(self, df: DataFrame) -> "Roles":
        """Unknown target is an error; an unknown id/group is treated as absent."""
        if self.target not in df.columns:
            raise ValueError(f"Target column '{self.target}' not found.")
        return replace(self,
                       id=self.id if self.id in df.columns else None,
                       group=self.group if self.group in df.columns else None)

    def _protected(self):
        return {c for c in (self.target, self.id, self.row_key, *self.exclude) if c}

    def numeric(self, df: DataFrame, keep_group: bool = True) -> list[str]:
        """Numeric features: integral/float/decimal columns minus target and id.

        The group column stays a feature unless ``keep_group`` is False (the
        detector keeps it; training drops it like the id).
        """
        drop = self._protected()
        if not keep_group and self.group:
            drop.add(self.group)
        return [f.name for f in df.schema.fields
                if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in drop]

    def categorical(self, df: DataFrame) -> list[str]:
        """String columns other than the target (boolean/date/timestamp are neither role)."""
        return [f.name for f in df.schema.fields
                if isinstance(f.dataType, T.StringType) and f.name != self.target]

    def time_named(self, df: DataFrame, by_type: bool = False) -> list[str]:
        cols = time_named(df.columns, exclude=(self.target, self.id))
        if by_type:
            typed = [f.name for f in df.schema.fields
                     if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
                     and f.name not in (self.target, self.id) and f.name not in cols]
            cols = cols + typed
        return cols
