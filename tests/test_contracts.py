import pytest

from siltworks.contracts import (
    Contract,
    ForeignKey,
    Registry,
    catalog_contracts,
    declared,
    read_contracts,
)
from siltworks.sinks.lake import _declares


def test_declared(spark):
    registry = declared()
    assert registry.names() == sorted(registry.names()) and len(registry.names()) == 19
    fields = [f for c in registry for f in c.schema]
    assert len(fields) == 560
    price = registry.lookup("price_discount")
    assert price.schema["disc_pct"].dataType.simpleString() == "decimal(4,2)"
    assert "mfr_name" in price.required and price.defaults["mfr_name"] == "'blank'"


def test_keys_name_real_columns(spark):
    for c in declared():
        names = set(c.schema.names)
        for key in (*c.unique_keys, c.cluster_by, tuple(c.defaults), tuple(f.column for f in c.foreign_keys)):
            assert set(key) <= names, (c.name, key)


def test_source_schema_is_text_in_contract_order(spark):
    c = Contract(name="t", columns="id INT, none_flag BOOLEAN", source_names={"none_flag": "NONE"})
    assert [(f.name, f.dataType.simpleString()) for f in c.source_schema] == [("ID", "string"), ("NONE", "string")]


def test_lookup():
    registry = declared()
    assert registry.lookup("  Zone_Price ").name == "zone_price"
    for bad in ("", None, "nope"):
        with pytest.raises(ValueError):
            registry.lookup(bad)


def test_contract_files(spark, tmp_path):
    c = Contract(
        name="wide",
        columns="id INT NOT NULL, url STRING",
        defaults={"url": "''"},
        source_names={"url": "LINK"},
        cluster_by=("id",),
        unique_keys=(("id",),),
        foreign_keys=(ForeignKey("id", "p", "pid"),),
        source_folder="WIDE",
    )
    assert Contract.from_json(c.to_json()) == c and c.folder == "WIDE"
    (tmp_path / "wide.json").write_text(c.to_json())
    (tmp_path / "readme.md").write_text("no contract")
    assert read_contracts(spark, str(tmp_path)).lookup("WIDE") == c


def test_catalog_round_trip(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS roundtrip")
    extra = Contract(
        name="renamed",
        columns="none_flag BOOLEAN NOT NULL, note STRING",
        defaults={"note": "'it''s'"},
        source_names={"none_flag": "NONE"},
        comment="A table.",
    )
    for c in [*declared(), extra]:
        table = f"`roundtrip`.`{c.name}`"
        spark.sql(c.create_table_sql(table, f"{tmp_path}/{c.name}"))
        assert _declares(spark, table, c), c.name
        assert not _declares(spark, table, Contract(name=c.name, columns="x INT"))
    found = catalog_contracts(spark, "roundtrip", ["renamed", "sin"])
    assert found.names() == ["renamed", "sin"]
    assert found.lookup("renamed").source_schema.names == ["NONE", "NOTE"]


def test_registry_sorts():
    assert Registry([Contract("b", "x INT"), Contract("a", "x INT")]).names() == ["a", "b"]
