"""A table contract: what the source calls its columns and what Silver must hold."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field
from functools import cached_property

from pyspark.sql import SparkSession
from pyspark.sql import types as T

_REQUIRED = "NOT NULL"
PROPERTY = "siltworks.contract"


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Contract:
    """One table's declared shape.

    ``columns`` is a Spark DDL column list. ``defaults`` maps a column to a SQL
    expression; ``source_names`` maps a Silver column to the source header when it
    is not simply the upper-case name. Kept in code (or in the table's properties),
    never inferred from the written data, because Parquet forgets NOT NULL.
    """

    name: str
    columns: str
    defaults: Mapping[str, str] = field(default_factory=dict)
    source_names: Mapping[str, str] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()
    unique_keys: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    comment: str = ""
    source_folder: str = ""

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    def source_name(self, column: str) -> str:
        return self.source_names.get(column, column.upper())

    @property
    def source_schema(self) -> T.StructType:
        """The landed file's columns, in file order, all text."""
        return T.StructType(
            [T.StructField(self.source_name(f.name), T.StringType(), True) for f in self.schema]
        )

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]

    @property
    def folder(self) -> str:
        return self.source_folder or self.name

    def create_table_sql(self, table: str, location: str | None = None) -> str:
        """The table's DDL. Comments state what a Parquet table does not keep itself."""
        columns = []
        for f in self.schema:
            parts = [f"`{f.name}`", f.dataType.simpleString()]
            if f.name in self.defaults:
                parts.append(f"DEFAULT {self.defaults[f.name]}")
            if not f.nullable:
                parts.append("NOT NULL")
            notes = self._notes(f)
            if notes:
                parts.append(f"COMMENT {quote('; '.join(notes))}")
            columns.append(" ".join(parts))
        sql = f"CREATE TABLE IF NOT EXISTS {table} (\n  " + ",\n  ".join(columns) + "\n) USING parquet"
        if self.cluster_by:
            sql += f"\nCLUSTER BY ({', '.join(self.cluster_by)})"
        if location:
            sql += f"\nLOCATION {quote(location)}"
        keys = [f"Unique: {', '.join(key)}." for key in self.unique_keys]
        comment = " ".join([self.comment, *keys]).strip()
        if comment:
            sql += f"\nCOMMENT {quote(comment)}"
        return sql + f"\nTBLPROPERTIES ({quote(PROPERTY)} = {quote(self._facts())})"

    def _facts(self) -> str:
        """What a Parquet table does not keep, in the form ``from_table`` reads. Comments are for people.

        Columns are given by position: Spark hides the value of a property in which a word like "url" occurs.
        """
        at = {name: i for i, name in enumerate(self.schema.names)}
        return json.dumps(
            {
                "required": [at[c] for c in self.required],
                "source_names": {at[c]: name for c, name in self.source_names.items()},
                "cluster_by": [at[c] for c in self.cluster_by],
                "unique_keys": [[at[c] for c in key] for key in self.unique_keys],
                "foreign_keys": [[at[k.column], k.parent, k.parent_column] for k in self.foreign_keys],
                "comment": self.comment,
                "source_folder": self.source_folder,
            }
        )

    def _notes(self, f: T.StructField) -> list[str]:
        notes = [] if f.nullable else [_REQUIRED]
        if f.name in self.source_names:
            notes.append(f"source column {self.source_names[f.name]}")
        notes += [
            f"FK to {fk.parent}.{fk.parent_column}"
            for fk in self.foreign_keys
            if fk.column == f.name
        ]
        return notes

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Contract:
        raw = json.loads(text)
        raw["cluster_by"] = tuple(raw.get("cluster_by", ()))
        raw["unique_keys"] = tuple(tuple(k) for k in raw.get("unique_keys", ()))
        raw["foreign_keys"] = tuple(ForeignKey(**k) for k in raw.get("foreign_keys", ()))
        return Contract(**raw)

    @staticmethod
    def from_table(spark: SparkSession, table: str) -> Contract:
        """Read a contract back from the catalog: columns and defaults from the schema, the rest
        from the table's property. A table declared elsewhere has NOT NULL marks and clustering only.
        """
        schema = spark.table(table).schema
        properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        facts = json.loads(properties.get(PROPERTY, "{}"))
        required, names = set(facts.get("required", ())), schema.names
        columns = [
            f"{f.name} {f.dataType.simpleString()}" + (" NOT NULL" if not f.nullable or i in required else "")
            for i, f in enumerate(schema)
        ]
        return Contract(
            name=table.split(".")[-1].strip("`"),
            columns=", ".join(columns),
            defaults={f.name: f.metadata["CURRENT_DEFAULT"] for f in schema if "CURRENT_DEFAULT" in f.metadata},
            source_names={names[int(i)]: name for i, name in facts.get("source_names", {}).items()},
            cluster_by=tuple(names[i] for i in facts["cluster_by"]) if facts else _clustering(spark, table),
            unique_keys=tuple(tuple(names[i] for i in k) for k in facts.get("unique_keys", ())),
            foreign_keys=tuple(ForeignKey(names[i], *parent) for i, *parent in facts.get("foreign_keys", ())),
            comment=facts.get("comment", ""),
            source_folder=facts.get("source_folder", ""),
        )


def _clustering(spark: SparkSession, table: str) -> tuple[str, ...]:
    """Clustering columns, which the catalog lists after a heading of their own."""
    names = [r["col_name"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    heading = "# Clustering Information"
    out = []
    for name in names[names.index(heading) + 2 :] if heading in names else ():
        if not name or name.startswith("#"):
            break
        out.append(name)
    return tuple(out)


class Registry:
    """Contracts by name; names are matched after trimming and lower-casing."""

    def __init__(self, contracts: Iterable[Contract]):
        self._by_name = {c.name: c for c in contracts}

    def names(self) -> list[str]:
        return sorted(self._by_name)

    def lookup(self, name: str | None) -> Contract:
        key = (name or "").strip().lower()
        if not key:
            raise ValueError("a table name is required")
        if key not in self._by_name:
            raise ValueError(f"unknown table {key!r}; known: {self.names()}")
        return self._by_name[key]

    def __iter__(self):
        return (self._by_name[n] for n in self.names())


def quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
