"""The wide declared contracts, in the order of their files' columns."""

from __future__ import annotations

from siltworks.contracts.model import Contract

# Names, types, NOT NULL marks, defaults, keys and clustering of each table.
WIDE_DECLARED = (
    Contract(
        name="bpa_header",
        columns="""
            id BIGINT NOT NULL, bpa_category_id INT, bpa_number STRING NOT NULL,
            contract_number STRING NOT NULL, creation_time TIMESTAMP NOT NULL,
            created_by STRING NOT NULL, description STRING, store_id INT NOT NULL,
            poc_first_name STRING, poc_last_name STRING, poc_phone STRING,
            start_date TIMESTAMP NOT NULL, end_date TIMESTAMP NOT NULL, url STRING,
            last_mod_time TIMESTAMP, updated_by STRING, schedule_discount INT,
            status INT NOT NULL, batch_number BIGINT, vendor_name STRING, service BOOLEAN NOT NULL,
            poc_email STRING, bpa_notes STRING, quotes INT, ebuy_quotes STRING, users STRING,
            adv_status BOOLEAN NOT NULL, bpa_schedule STRING, bpa_sin STRING,
            disp_in_ebuy BOOLEAN NOT NULL, bpa_min_order DECIMAL(18,2) NOT NULL,
            std_delivery_time INT NOT NULL, std_delivery_time_2 INT NOT NULL,
            delivery_code STRING NOT NULL, next_day_delivery STRING, desktop_delivery STRING,
            secure_desktop_delivery STRING, check_upiid_format BOOLEAN NOT NULL,
            convenience_fee STRING, next_day_delivery_flat_rate STRING,
            desktop_delivery_flat_rate STRING, secure_delivery_flat_rate STRING""",
        defaults={
            "service": "false",
            "adv_status": "false",
            "disp_in_ebuy": "false",
            "bpa_min_order": "0",
            "std_delivery_time": "0",
            "std_delivery_time_2": "0",
            "delivery_code": "''",
            "check_upiid_format": "false",
        },
        cluster_by=("bpa_number", "contract_number", "store_id", "id"),
    ),
    Contract(
        name="catalog_832",
        columns="""
            vend_id STRING NOT NULL, contract_num STRING NOT NULL, sched_num STRING,
            catalog_num STRING, agency_name STRING, buyer_code STRING, con_stdate TIMESTAMP,
            con_enddate TIMESTAMP, cc_disc DECIMAL(4,2), disc_term_amt INT,
            disc_term_per DECIMAL(4,2), disc_term_day STRING, fob STRING, max_battery DECIMAL(18,2),
            max_nsp DECIMAL(18,2), max_ship INT, mop STRING, min_order DECIMAL(18,2),
            max_order DECIMAL(18,2), delivery_days1 INT, delivery_days2 INT,
            zone_flag BOOLEAN NOT NULL, prompt_pay BOOLEAN NOT NULL, mod_date TIMESTAMP,
            disc_term_per2 DECIMAL(4,2), disc_term_day2 STRING, ppoint1 STRING, ppoint2 STRING,
            pr_war STRING, fob_ak STRING, fob_hi STRING, fob_pr STRING, fob_us STRING,
            x12_id STRING, appr_date TIMESTAMP, trans_date TIMESTAMP, source_edi STRING,
            l_file STRING, m_file STRING, r_file STRING, w_file STRING, warnumber STRING,
            warperiod STRING, ocontnum STRING, specterms INT, eff_date TIMESTAMP, suspend INT,
            lsa_code STRING, wo_code STRING, size_code STRING, min_code STRING, fob_cd STRING,
            ref_ind STRING, fill STRING, sdb_prog STRING, vet_owned_small_bus STRING,
            attributes_flag TINYINT, hubz_sbc STRING, delivery_code STRING, wosb_code STRING,
            edwosb_code STRING, mmti STRING, bus_attrib STRING, ssp_8a_exit_date DATE,
            con_eol_date TIMESTAMP""",
        defaults={"attributes_flag": "0"},
        cluster_by=("vend_id", "contract_num"),
    ),
    Contract(
        name="contracts",
        columns="""
            contract_identity BIGINT NOT NULL, contract_number STRING,
            contract_end_date STRING NOT NULL, business_size STRING, woman_owned STRING,
            minority_code STRING, disadvantaged_code STRING, labor_setaside STRING,
            competitive_solicitation_proc STRING, schedule_number STRING NOT NULL,
            special_item_number STRING NOT NULL, contractor_name STRING NOT NULL,
            contractor_address1 STRING, contractor_address2 STRING, contractor_address3 STRING,
            contractor_city STRING, contractor_state STRING, contractor_zip STRING,
            contractor_phone STRING, contractor_email STRING, contractor_url STRING,
            advantage_item STRING NOT NULL, date_updated TIMESTAMP NOT NULL, mfr_identity BIGINT,
            vosb STRING, buyer_name STRING, buyer_phone STRING, buyer_email STRING, hubzone STRING,
            hubzone_sbc STRING, stloc STRING, ref_text STRING, esb STRING, is_gwac STRING,
            dba STRING, contractor_country STRING, duns STRING, disaster_recovery STRING NOT NULL,
            arra STRING NOT NULL, epls STRING NOT NULL, naics STRING,
            display_in_elib STRING NOT NULL, wosb STRING NOT NULL, edwosb STRING NOT NULL,
            contract_begin_date STRING NOT NULL, tribally_owned_firm STRING NOT NULL,
            american_indian_owned STRING NOT NULL, native_alaskan_owned STRING NOT NULL,
            native_hawaiian_owned STRING NOT NULL, is_8a_source STRING NOT NULL,
            exit_date_8a_source STRING NOT NULL, contract_close_date STRING NOT NULL,
            is_8a_joint_venture STRING, women_owned_joint_venture STRING,
            veteran_owned_joint_venture STRING, hubzone_joint_venture STRING, sba_vosb STRING,
            sba_sdvosb STRING""",
        defaults={
            "disaster_recovery": "'N'",
            "arra": "'N'",
            "epls": "'N'",
            "display_in_elib": "'Y'",
            "wosb": "'N'",
            "edwosb": "'N'",
            "contract_begin_date": "''",
            "tribally_owned_firm": "'N'",
            "american_indian_owned": "'N'",
            "native_alaskan_owned": "'N'",
            "native_hawaiian_owned": "'N'",
            "is_8a_source": "'N'",
            "exit_date_8a_source": "''",
            "contract_close_date": "''",
        },
        cluster_by=("schedule_number", "special_item_number", "contractor_name"),
    ),
    Contract(
        name="adv_product",
        source_folder="ADV_PRODUCT",
        columns="""
            oid DECIMAL(14,0) NOT NULL, prod_id STRING NOT NULL, store_id INT NOT NULL,
            creation_time TIMESTAMP NOT NULL, status INT NOT NULL, deleted INT NOT NULL,
            last_mod_time TIMESTAMP NOT NULL, name STRING NOT NULL, dept STRING,
            price DECIMAL(18,2) NOT NULL, stock INT, preview_image STRING, preview_image_width INT,
            preview_image_height INT, full_image STRING, full_image_width INT,
            full_image_height INT, audio_file STRING, video_file STRING, sdesc2 STRING,
            lprice DECIMAL(18,2), longdesc STRING, appdef1 STRING, appdef2 STRING, appdef3 STRING,
            rating DOUBLE, no_votes INT, total_rating DOUBLE, adv_ass_num STRING NOT NULL,
            adv_item_num STRING NOT NULL, adv_sched_num STRING NOT NULL,
            adv_contract_num STRING NOT NULL, adv_catcode STRING NOT NULL, adv_duns STRING,
            adv_vendor_name STRING, adv_govt_name STRING, adv_item_type STRING NOT NULL,
            adv_options_flg INT NOT NULL, adv_accessory_flg INT NOT NULL, adv_unit STRING NOT NULL,
            adv_aac STRING, adv_item_code STRING, adv_delivery_code STRING,
            adv_allied_comp_flg INT NOT NULL, adv_chlorine_free_flg INT NOT NULL,
            adv_energy_efficient_flg INT NOT NULL, adv_lead_free_flg INT NOT NULL,
            adv_energy_star_flg INT NOT NULL, adv_low_volatile_flg INT NOT NULL,
            adv_ozone_safe_flg INT NOT NULL, adv_nib_nish_flg INT NOT NULL,
            adv_recycled_content_flg INT NOT NULL, adv_unicore_flg INT NOT NULL,
            adv_water_conserving_flg INT NOT NULL, adv_none_code_flg INT NOT NULL,
            adv_other_env_flg INT NOT NULL, adv_year_2000_flg INT, adv_environmental_flg INT,
            adv_wildfire_item_flg INT NOT NULL, adv_small_business_flg INT NOT NULL,
            adv_discount_flg INT NOT NULL, adv_nsn STRING, adv_manufacture_name STRING NOT NULL,
            adv_visa_flg INT, adv_del_days_low INT, adv_del_days_high INT,
            adv_minority_owned STRING, adv_woman_owned STRING, adv_color_flg INT,
            adv_vendor_url STRING, adv_business_size STRING, adv_lsa_code STRING,
            adv_bus_attrib STRING, adv_dimension STRING, adv_sin_num STRING,
            adv_sin_max_order DECIMAL(18,2), adv_photo_code STRING, adv_sdb_prog STRING,
            adv_environ_message STRING, adv_cpg INT, adv_vet_owned_small_bus STRING,
            adv_product STRING, adv_pcode STRING, price_indicator TINYINT""",
        defaults={"rating": "0", "no_votes": "0", "total_rating": "0"},
        cluster_by=("adv_contract_num", "prod_id", "adv_item_num", "deleted"),
        unique_keys=(("oid",),),
    ),
    Contract(
        name="item_xref",
        columns="""
            item_id DECIMAL(10,0) NOT NULL, ass_num DECIMAL(14,0) NOT NULL, sched_num STRING,
            contract_num STRING, item_num STRING, catcode STRING, pcode STRING, nsn_search STRING,
            niin_search STRING, cont_search STRING, duns STRING, vendor_name STRING,
            mfr_name STRING, item_name STRING, govt_name STRING, photocode STRING,
            description STRING, item_type STRING, item_status STRING, options_ind INT,
            accessory_ind INT, visa_ind INT, del_days1 INT, del_days2 INT, www_address STRING,
            uom STRING, fob_ak STRING, fob_hi STRING, fob_pr STRING, fob_us STRING,
            fob_code STRING, lsa_code STRING, minority_owned STRING, woman_owned STRING,
            business_size STRING, item_colors STRING, dimension STRING, aac STRING,
            item_code STRING, delivery_code STRING, allied_comp INT, chlorine_free INT,
            energy_efficient INT, energy_star INT, lead_free INT, low_volatile INT, nib_nish INT,
            ozone_safe INT, recycled_content INT, remanufactured INT, unicore INT,
            water_conserving INT, none_code INT, other_env INT, year_2000 INT, emergency_item INT,
            environmental INT, small_business INT, wildfire_item INT, item_price DECIMAL(19,4),
            discount INT, nsn STRING, sin STRING, sin_max_order DECIMAL(19,4), sdb_prog STRING,
            environ_message STRING, cpg INT, vet_owned_small_bus STRING, bus_attrib STRING,
            hubz_sbc STRING, vend_part STRING, photo_group_id STRING, upc_isbn_gtin STRING,
            gsin DECIMAL(14,0)""",
        defaults={"item_price": "0.0", "discount": "0"},
        cluster_by=("contract_num", "item_id", "item_num", "sched_num"),
    ),
    Contract(
        name="product_file",
        columns="""
            vend_id STRING, contract_num STRING, mfr_part STRING, sched_num STRING, mfr_name STRING,
            prod_name STRING, line_num STRING, vend_part STRING, prod_desc1 STRING,
            prod_desc2 STRING, spec_item STRING, ass_num DECIMAL(14,0), prod_length STRING,
            prod_width STRING, prod_height STRING, prod_depth STRING, prod_weight_old DECIMAL(7,3),
            prod_dimension STRING, prod_cube DECIMAL(9,3), prod_stdpack STRING, increment STRING,
            discontinue STRING, war_text STRING, warnumber STRING, warperiod STRING,
            basepart STRING, p_www STRING, min_order DECIMAL(10,4), max_order DECIMAL(10,4),
            disc_term_amt INT, disc_term_per DECIMAL(4,2), disc_term_day STRING, max_ship INT,
            qty INT, qty_per_pack STRING, conditions STRING, delivery_days1 INT, ppoint1 STRING,
            ppoint2 STRING, energy_star BOOLEAN, allied_comp BOOLEAN, prod_envcode STRING,
            prod_envmsg1 STRING, prod_envmsg2 STRING, vend_name STRING, uom STRING, fob_ak STRING,
            fob_hi STRING, fob_pr STRING, fob_us STRING, nsn STRING, mod_date TIMESTAMP,
            recycled_content BOOLEAN, energy_efficient BOOLEAN, lead_free BOOLEAN,
            water_conserving BOOLEAN, remanufactured BOOLEAN, chlorine_free BOOLEAN,
            ozone_safe BOOLEAN, year_2000 BOOLEAN, unicore BOOLEAN, nib_nish BOOLEAN,
            none_flag BOOLEAN, other_env BOOLEAN, low_volatile BOOLEAN, options_ind INT,
            accx_ind INT, maint_ind INT, lease_ind INT, rental_ind INT, ewarr_ind INT,
            prod_weight DECIMAL(11,3), prod_cube_uom STRING, prod_weight_uom STRING,
            prod_length_width_height_uom STRING, qty_unit_uom STRING""",
        source_names={"none_flag": "NONE"},
        cluster_by=("vend_id", "contract_num", "mfr_part", "sched_num"),
    ),
)
