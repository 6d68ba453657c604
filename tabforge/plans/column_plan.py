"""Column-role registry (driver-side metadata, no data).

The reference keeps Python lists of one-hot, numeric, boolean and dropped
columns, prunes them against the drop list and asserts that every raw column
got a role and every declared column exists.  ``ColumnPlan`` is that registry.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tabforge.functions.nullsafe import qcol

ROLES = ("one_hot", "numeric", "boolean", "drop", "drop_dummies")


@dataclass
class ColumnPlan:
    key: str | None = None
    label: str | None = None
    one_hot: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    boolean: list[str] = field(default_factory=list)
    drop: list[str] = field(default_factory=list)
    drop_dummies: list[str] = field(default_factory=list)

    def add(self, role: str, *columns: str) -> "ColumnPlan":
        if role not in ROLES:
            raise ValueError(f"unknown role {role!r}")
        lst = getattr(self, role)
        lst.extend(c for c in columns if c not in lst)
        return self

    def pruned(self) -> "ColumnPlan":
        """Remove dropped columns from every other role (kept order)."""
        gone = set(self.drop)
        return ColumnPlan(self.key, self.label,
                          [c for c in self.one_hot if c not in gone],
                          [c for c in self.numeric if c not in gone],
                          [c for c in self.boolean if c not in gone],
                          list(self.drop), list(self.drop_dummies))

    def features(self) -> list[str]:
        """Declared (pre-encoding) feature columns in role order, dropped ones removed."""
        p = self.pruned()
        out: list[str] = []
        for c in p.one_hot + p.numeric + p.boolean:
            if c not in out:
                out.append(c)
        return out

    def validate(self, df: DataFrame, raw_columns: list[str] | None = None) -> None:
        """The reference's assertions: drop targets exist, every raw column has a
        role, every declared column exists.  Schema-only, no job."""
        cols = set(df.columns)
        missing_drop = [c for c in self.drop if c not in cols]
        if missing_drop:
            raise AssertionError(f"trying to drop columns that are absent: {missing_drop}")
        if raw_columns is not None:
            roles = set(self.one_hot) | set(self.numeric) | set(self.boolean) | set(self.drop)
            untouched = [c for c in raw_columns
                         if c not in roles and c not in (self.key, self.label)]
            if untouched:
                raise AssertionError(f"columns without a role: {untouched}")
        declared = [c for c in self.features() if c not in cols]
        if declared:
            raise AssertionError(f"declared columns absent from the frame: {declared}")

    def apply(self, df: DataFrame) -> DataFrame:
        """Drop the dropped columns and order the rest: key, features, label."""
        self.validate(df)
        df = df.drop(*self.drop)
        head = [c for c in (self.key,) if c]
        tail = [c for c in (self.label,) if c and c in df.columns]
        return df.select(*[qcol(c) for c in head + self.features() + tail])
