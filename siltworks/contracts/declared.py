"""Declared contracts.

The narrow tables are stated here, the wide ones in ``wide``. An installation can add its own
from a folder of contract files (``read_contracts``) or from a catalog (``catalog_contracts``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from siltworks.contracts.model import Contract, ForeignKey, Registry
from siltworks.contracts.wide import WIDE_DECLARED

# Names, types, NOT NULL marks, defaults, keys and clustering of each table.
DECLARED = (
    Contract(
        name="bpa_item",
        columns="""
            id BIGINT NOT NULL, bpa_id BIGINT NOT NULL, item_num STRING NOT NULL, assnum BIGINT,
            line_number STRING, stock_indicator INT, item_price DECIMAL(18,2) NOT NULL,
            pricing_program BIGINT, status INT, mfr_name STRING""",
        cluster_by=("bpa_id", "item_num", "status"),
        foreign_keys=(
            ForeignKey("status", "bpa_status", "status_id"),
            ForeignKey("bpa_id", "bpa_header", "id"),
            ForeignKey("pricing_program", "bpa_pricing_program", "program_id"),
        ),
    ),
    Contract(
        name="bpa_item_price",
        columns="""
            id BIGINT NOT NULL, item_id BIGINT NOT NULL, start_range INT NOT NULL,
            end_range INT NOT NULL, discount_percent INT, price DECIMAL(18,2)""",
        cluster_by=("item_id", "start_range", "end_range"),
    ),
    Contract(
        name="contract_zone",
        columns="""
            vend_id STRING NOT NULL, contract_num STRING NOT NULL, state STRING NOT NULL,
            sched_num STRING, zone DECIMAL(2,0), mod_date TIMESTAMP""",
        cluster_by=("vend_id", "contract_num", "state"),
        unique_keys=(("vend_id", "contract_num", "state"),),
    ),
    Contract(
        name="gsin_hide_remove",
        columns="""
            gsin DECIMAL(14,0) NOT NULL, status STRING NOT NULL, date_requested TIMESTAMP,
            reason STRING, requested_by STRING""",
        cluster_by=("gsin",),
        unique_keys=(("gsin",),),
    ),
    Contract(
        name="gsin_hide_remove_hist",
        columns="""
            gsin DECIMAL(14,0) NOT NULL, status STRING NOT NULL, contract_num STRING NOT NULL,
            item_num STRING NOT NULL, mfr_name STRING NOT NULL, vend_part STRING, item_name STRING,
            status_date STRING NOT NULL, reason STRING, requested_by STRING""",
        cluster_by=("gsin", "status_date"),
    ),
    Contract(
        name="mp_product",
        columns="""
            mp_type_id INT NOT NULL, gsin DECIMAL(14,0) NOT NULL, product_name STRING,
            description STRING, mfr_name STRING, mfr_name_search STRING, item_num STRING,
            upc_isbn_gtin STRING, photo_group_id STRING, unspsc STRING, source_type_id INT NOT NULL,
            source_product_id INT, status INT, date_created TIMESTAMP NOT NULL,
            last_modified TIMESTAMP, uom STRING, photo_url STRING, del_days1 INT, del_days2 INT,
            unspsc_source TINYINT NOT NULL""",
        defaults={
            "date_created": "current_timestamp()",
            "last_modified": "current_timestamp()",
            "unspsc_source": "0",
        },
        cluster_by=("gsin", "unspsc_source"),
        unique_keys=(("gsin",),),
    ),
    Contract(
        name="price_discount",
        columns="""
            vend_id STRING NOT NULL, contract_num STRING NOT NULL, mfr_part STRING NOT NULL,
            zone DECIMAL(2,0) NOT NULL, dollar_qty INT NOT NULL, seq INT NOT NULL,
            sale STRING NOT NULL, sched_num STRING, vend_part STRING, line_num STRING,
            ass_num DECIMAL(14,0), msg STRING, qty1 INT, qty2 INT, disc_price DECIMAL(18,2),
            disc_pct DECIMAL(4,2), mod_date TIMESTAMP, mfr_name STRING NOT NULL""",
        defaults={"mfr_name": "'blank'"},
        cluster_by=("vend_id", "contract_num", "mfr_part", "zone"),
        unique_keys=(
            (
                "vend_id", "contract_num", "mfr_part", "zone",
                "dollar_qty", "seq", "sale", "mfr_name",
            ),
        ),
    ),
    Contract(
        name="sin_limit",
        columns="""
            vend_id STRING NOT NULL, contract_num STRING NOT NULL, spec_item STRING NOT NULL,
            sched_num STRING, line_num STRING, max_order DECIMAL(18,2), min_order DECIMAL(18,2),
            order_type STRING, mod_date TIMESTAMP, sin_desc STRING""",
        cluster_by=("vend_id", "contract_num", "spec_item"),
        unique_keys=(("vend_id", "contract_num", "spec_item"),),
    ),
    Contract(
        name="suspend_contract",
        columns="contract_num STRING NOT NULL, suspend_type INT NOT NULL",
        defaults={"suspend_type": "1"},
        cluster_by=("contract_num",),
    ),
    Contract(
        name="zone_price",
        columns="""
            vend_id STRING NOT NULL, contract_num STRING NOT NULL, mfr_part STRING NOT NULL,
            zone DECIMAL(2,0) NOT NULL, sched_num STRING, vend_part STRING, line_num STRING,
            unit_price DECIMAL(18,2), list_price DECIMAL(18,2), sched_price DECIMAL(18,2),
            sale BOOLEAN NOT NULL, sale_price DECIMAL(18,2), sale_st_date TIMESTAMP,
            sale_end_date TIMESTAMP, prod_disc BOOLEAN NOT NULL, ass_num DECIMAL(14,0),
            mod_date TIMESTAMP, proj_code STRING, loc_code STRING, prog_code STRING,
            mfr_name STRING""",
        cluster_by=("vend_id", "contract_num", "mfr_part", "zone"),
        unique_keys=(("ass_num", "zone", "loc_code", "mfr_name"),),
    ),
    Contract(
        name="sin",
        columns="""
            sin_identity BIGINT NOT NULL, schedule_number STRING NOT NULL,
            special_item_number STRING NOT NULL, sin_group_title STRING, sin_description1 STRING,
            sin_description2 STRING, sin_order DOUBLE, co_fname STRING, co_lname STRING,
            co_phone STRING, co_email STRING, sin_ancillary STRING, sin_ancra STRING,
            sin_238910 STRING, sin_olm STRING, complimentary_sin STRING NOT NULL,
            hide_in_elib STRING NOT NULL, hide_in_ebuy STRING NOT NULL,
            hide_in_elib_date TIMESTAMP, hide_in_ebuy_date TIMESTAMP""",
        defaults={"complimentary_sin": "'0'", "hide_in_elib": "'N'", "hide_in_ebuy": "'N'"},
        cluster_by=("schedule_number", "special_item_number"),
        unique_keys=(("sin_identity",),),
    ),
    Contract(
        name="order_status",
        columns="""
            unique_id DECIMAL(10,0) NOT NULL, awd_unique_id DECIMAL(9,0), line_num INT,
            bv_order_num DECIMAL(10,0) NOT NULL, contract_num STRING,
            po_number_reqn_num STRING NOT NULL, nsn_mfr_part STRING NOT NULL, line_status STRING,
            process_code STRING, status_date TIMESTAMP NOT NULL, quantity INT NOT NULL, mode STRING,
            mode_url STRING, tracking_num STRING, est_ship_date TIMESTAMP, tcngbl STRING,
            date_created TIMESTAMP, fss19_po_number STRING, display_flag TINYINT NOT NULL""",
        defaults={"date_created": "current_timestamp()", "display_flag": "1"},
        cluster_by=("po_number_reqn_num", "bv_order_num", "awd_unique_id", "date_created"),
    ),
    Contract(
        name="item_xref_attributes",
        columns="""
            contract_num STRING NOT NULL, item_num STRING NOT NULL, url_508 STRING NOT NULL,
            last_updated TIMESTAMP, updated_by STRING, unid STRING, scan_code1 STRING,
            scan_code2 STRING, scan_code3 STRING, true_mfr_part STRING, psc_code STRING,
            mfr_name STRING, cage_code STRING, eula_ind BOOLEAN NOT NULL""",
        defaults={"last_updated": "current_timestamp()", "eula_ind": "false"},
        cluster_by=("contract_num", "item_num", "mfr_name"),
        unique_keys=(("contract_num", "item_num", "mfr_name"),),
    ),
)


def declared() -> Registry:
    return Registry([*DECLARED, *WIDE_DECLARED])


def read_contracts(spark: SparkSession, folder: str) -> Registry:
    """Contracts kept as one JSON file each (the form ``Contract.to_json`` writes)."""
    # Contract files are configuration: a handful of small texts, read on the driver.
    rows = spark.read.option("wholetext", "true").text(folder, pathGlobFilter="*.json").collect()
    return Registry(Contract.from_json(r["value"]) for r in rows)


def catalog_contracts(spark: SparkSession, schema: str, names: Iterable[str]) -> Registry:
    """Contracts of tables that already exist in a catalog schema."""
    return Registry(Contract.from_table(spark, f"`{schema}`.`{name}`") for name in names)
