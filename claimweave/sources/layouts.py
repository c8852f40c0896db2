"""Column layouts of the input extracts, in file order.

Every raw column is text.  The tag after a column name says which cast turns
it into its staging type; no tag means cleaned text::

    T  text (default)     D  date            I  integer
    S  smallint           N  decimal(15,2)   Q  decimal(12,3)

Claim extracts carry header fields on every line row.  Their line number column
(``clm_line_num`` or ``line_num``) marks where the line fields begin: columns
before it describe the claim, columns from it onwards describe the line.
"""

from __future__ import annotations

from typing import NamedTuple


class Field(NamedTuple):
    name: str
    kind: str


Layout = tuple[Field, ...]

LINE_KEYS = ("clm_line_num", "line_num")


def _field(tagged: str) -> Field:
    name, _, kind = tagged.partition(":")
    return Field(name, kind or "T")


def cols(text: str) -> Layout:
    return tuple(_field(word) for word in text.split())


def series(span: str, *patterns: str) -> Layout:
    """Numbered columns: every pattern repeated for each number of ``span``,
    ``#`` standing for the number (zero-padded as wide as the span writes it)."""
    first, last = span.split("..")
    return tuple(
        _field(pattern.replace("#", str(number).zfill(len(first))))
        for number in range(int(first), int(last) + 1)
        for pattern in patterns
    )


def names(layout: Layout) -> list[str]:
    return [field.name for field in layout]


def line_key(layout: Layout) -> str:
    return next(field.name for field in layout if field.name in LINE_KEYS)


def header_fields(layout: Layout) -> Layout:
    return layout[: names(layout).index(line_key(layout))]


def line_fields(layout: Layout) -> Layout:
    return layout[names(layout).index(line_key(layout)) :]


# ---------------------------------------------------------------------------
# Published column names of the extracts, in file order.
# ---------------------------------------------------------------------------

BENEFICIARY = (
    cols("""
        bene_id state_code county_cd zip_cd bene_birth_dt:D sex_ident_cd bene_race_cd
        entlmt_rsn_orig entlmt_rsn_curr esrd_ind bene_pta_trmntn_cd bene_ptb_trmntn_cd
        bene_death_dt:D bene_enrollmt_ref_yr:S bene_hi_cvrage_tot_mons:S bene_smi_cvrage_tot_mons:S
        bene_state_buyin_tot_mons:S bene_hmo_cvrage_tot_mons:S rds_cvrg_mons:S enrl_src sample_group
        enhanced_five_percent_flag crnt_bic_cd age_at_end_ref_yr:S covstart:D dual_elgbl_mons:S
    """)
    + series("01..12", "state_cnty_fips_cd_#")
    + cols("valid_death_dt_sw rti_race_cd")
    + series("01..12", "mdcr_status_code_#")
    + cols("ptd_plan_cvrg_mons:S")
    + series("01..12", "mdcr_entlmt_buyin_ind_#")
    + series("01..12", "hmo_ind_#")
    + series("01..12", "ptc_cntrct_id_#")
    + series("01..12", "ptc_pbp_id_#")
    + series("01..12", "ptc_plan_type_cd_#")
    + series("01..12", "ptd_cntrct_id_#")
    + series("01..12", "ptd_pbp_id_#")
    + series("01..12", "ptd_sgmt_id_#")
    + series("01..12", "rds_ind_#")
    + series("01..12", "dual_stus_cd_#")
    + series("01..12", "cst_shr_grp_cd_#")
)


INPATIENT = (
    cols("""
        bene_id clm_id nch_near_line_rec_ident_cd nch_clm_type_cd clm_from_dt:D clm_thru_dt:D
        nch_wkly_proc_dt:D fi_clm_proc_dt:D claim_query_code prvdr_num clm_fac_type_cd
        clm_srvc_clsfctn_type_cd clm_freq_cd fi_num clm_mdcr_non_pmt_rsn_cd clm_pmt_amt:N
        nch_prmry_pyr_clm_pd_amt:N nch_prmry_pyr_cd fi_clm_actn_cd prvdr_state_cd org_npi_num
        at_physn_upin at_physn_npi op_physn_upin op_physn_npi ot_physn_upin ot_physn_npi
        clm_mco_pd_sw ptnt_dschrg_stus_cd clm_pps_ind_cd clm_tot_chrg_amt:N clm_admsn_dt:D
        clm_ip_admsn_type_cd clm_src_ip_admsn_cd nch_ptnt_status_ind_cd clm_pass_thru_per_diem_amt:N
        nch_bene_ip_ddctbl_amt:N nch_bene_pta_coinsrnc_lblty_am:N nch_bene_blood_ddctbl_lblty_am:N
        nch_profnl_cmpnt_chrg_amt:N nch_ip_ncvrd_chrg_amt:N nch_ip_tot_ddctn_amt:N
        clm_tot_pps_cptl_amt:N clm_pps_cptl_fsp_amt:N clm_pps_cptl_outlier_amt:N
        clm_pps_cptl_dsprprtnt_shr_amt:N clm_pps_cptl_ime_amt:N clm_pps_cptl_excptn_amt:N
        clm_pps_old_cptl_hld_hrmls_amt:N clm_pps_cptl_drg_wt_num clm_utlztn_day_cnt:I
        bene_tot_coinsrnc_days_cnt:I bene_lrd_used_cnt:I clm_non_utlztn_days_cnt:I
        nch_blood_pnts_frnshd_qty:N nch_vrfd_ncvrd_stay_from_dt:D nch_vrfd_ncvrd_stay_thru_dt:D
        nch_actv_or_cvrd_lvl_care_thru:D nch_bene_mdcr_bnfts_exhtd_dt_i:D nch_bene_dschrg_dt:D
        clm_drg_cd clm_drg_outlier_stay_cd nch_drg_outlier_aprvd_pmt_amt:N admtg_dgns_cd
        prncpal_dgns_cd
    """)
    + series("1..25", "icd_dgns_cd#", "clm_poa_ind_sw#")
    + cols("fst_dgns_e_cd")
    + series("1..12", "icd_dgns_e_cd#", "clm_e_poa_ind_sw#")
    + series("1..25", "icd_prcdr_cd#", "prcdr_dt#:D")
    + cols("""
        ime_op_clm_val_amt:N dsh_op_clm_val_amt:N clm_uncompd_care_pmt_amt:N clm_line_num:I rev_cntr
        hcpcs_cd rev_cntr_ddctbl_coinsrnc_cd
    """)
)


OUTPATIENT = (
    cols("""
        bene_id clm_id nch_near_line_rec_ident_cd nch_clm_type_cd clm_from_dt:D clm_thru_dt:D
        nch_wkly_proc_dt:D fi_clm_proc_dt:D claim_query_code prvdr_num clm_fac_type_cd
        clm_srvc_clsfctn_type_cd clm_freq_cd fi_num clm_mdcr_non_pmt_rsn_cd clm_pmt_amt:N
        nch_prmry_pyr_clm_pd_amt:N nch_prmry_pyr_cd prvdr_state_cd org_npi_num at_physn_upin
        at_physn_npi op_physn_upin op_physn_npi ot_physn_upin ot_physn_npi clm_mco_pd_sw
        ptnt_dschrg_stus_cd clm_tot_chrg_amt:N nch_bene_blood_ddctbl_lblty_am:N
        nch_profnl_cmpnt_chrg_amt:N prncpal_dgns_cd
    """)
    + series("1..25", "icd_dgns_cd#")
    + cols("fst_dgns_e_cd")
    + series("1..12", "icd_dgns_e_cd#")
    + series("1..25", "icd_prcdr_cd#", "prcdr_dt#:D")
    + series("1..3", "rsn_visit_cd#")
    + cols("""
        nch_bene_ptb_ddctbl_amt:N nch_bene_ptb_coinsrnc_amt:N clm_op_prvdr_pmt_amt:N
        clm_op_bene_pmt_amt:N clm_line_num:I rev_cntr rev_cntr_dt:D rev_cntr_1st_ansi_cd
        rev_cntr_2nd_ansi_cd rev_cntr_3rd_ansi_cd rev_cntr_4th_ansi_cd rev_cntr_apc_hipps_cd
        hcpcs_cd hcpcs_1st_mdfr_cd hcpcs_2nd_mdfr_cd rev_cntr_pmt_mthd_ind_cd rev_cntr_dscnt_ind_cd
        rev_cntr_packg_ind_cd rev_cntr_otaf_pmt_cd rev_cntr_ide_ndc_upc_num rev_cntr_unit_cnt:I
        rev_cntr_rate_amt:N rev_cntr_blood_ddctbl_amt:N rev_cntr_cash_ddctbl_amt:N
        rev_cntr_coinsrnc_wge_adjstd_c:N rev_cntr_rdcd_coinsrnc_amt:N rev_cntr_1st_msp_pd_amt:N
        rev_cntr_2nd_msp_pd_amt:N rev_cntr_prvdr_pmt_amt:N rev_cntr_bene_pmt_amt:N
        rev_cntr_ptnt_rspnsblty_pmt:N rev_cntr_pmt_amt_amt:N rev_cntr_tot_chrg_amt:N
        rev_cntr_ncvrd_chrg_amt:N rev_cntr_stus_ind_cd rev_cntr_ndc_qty:I rev_cntr_ndc_qty_qlfr_cd
        rndrng_physn_upin rndrng_physn_npi
    """)
)


CARRIER = (
    cols("""
        bene_id clm_id nch_near_line_rec_ident_cd nch_clm_type_cd clm_from_dt:D clm_thru_dt:D
        nch_wkly_proc_dt:D carr_clm_entry_cd clm_disp_cd carr_num carr_clm_pmt_dnl_cd clm_pmt_amt:N
        carr_clm_prmry_pyr_pd_amt:N rfr_physn_upin rfr_physn_npi carr_clm_prvdr_asgnmt_ind_sw
        nch_clm_prvdr_pmt_amt:N nch_clm_bene_pmt_amt:N nch_carr_clm_sbmtd_chrg_amt:N
        nch_carr_clm_alowd_amt:N carr_clm_cash_ddctbl_apld_amt:N carr_clm_hcpcs_yr_cd
        carr_clm_rfrng_pin_num prncpal_dgns_cd prncpal_dgns_vrsn_cd
    """)
    + series("1..12", "icd_dgns_cd#", "icd_dgns_vrsn_cd#")
    + cols("""
        clm_clncl_tril_num carr_clm_blg_npi_num line_num:I carr_prfrng_pin_num prf_physn_upin
        prf_physn_npi org_npi_num carr_line_prvdr_type_cd tax_num prvdr_state_cd prvdr_zip
        prvdr_spclty prtcptng_ind_cd carr_line_rdcd_pmt_phys_astn_c line_srvc_cnt:I
        line_cms_type_srvc_cd line_place_of_srvc_cd carr_line_prcng_lclty_cd line_1st_expns_dt:D
        line_last_expns_dt:D hcpcs_cd hcpcs_1st_mdfr_cd hcpcs_2nd_mdfr_cd betos_cd
        line_nch_pmt_amt:N line_bene_pmt_amt:N line_prvdr_pmt_amt:N line_bene_ptb_ddctbl_amt:N
        line_bene_prmry_pyr_cd line_bene_prmry_pyr_pd_amt:N line_coinsrnc_amt:N
        line_sbmtd_chrg_amt:N line_alowd_chrg_amt:N line_prcsg_ind_cd line_pmt_80_100_cd
        line_service_deductible carr_line_mtus_cnt:I carr_line_mtus_cd line_icd_dgns_cd
        line_icd_dgns_vrsn_cd hpsa_scrcty_ind_cd carr_line_rx_num line_hct_hgb_rslt_num
        line_hct_hgb_type_cd line_ndc_cd carr_line_clia_lab_num carr_line_ansthsa_unit_cnt:I
    """)
)


DME = (
    cols("""
        bene_id clm_id nch_near_line_rec_ident_cd nch_clm_type_cd clm_from_dt:D clm_thru_dt:D
        nch_wkly_proc_dt:D carr_clm_entry_cd clm_disp_cd carr_num carr_clm_pmt_dnl_cd clm_pmt_amt:N
        carr_clm_prmry_pyr_pd_amt:N carr_clm_prvdr_asgnmt_ind_sw nch_clm_prvdr_pmt_amt:N
        nch_clm_bene_pmt_amt:N nch_carr_clm_sbmtd_chrg_amt:N nch_carr_clm_alowd_amt:N
        carr_clm_cash_ddctbl_apld_amt:N carr_clm_hcpcs_yr_cd prncpal_dgns_cd prncpal_dgns_vrsn_cd
    """)
    + series("1..12", "icd_dgns_cd#", "icd_dgns_vrsn_cd#")
    + cols("""
        rfr_physn_upin rfr_physn_npi clm_clncl_tril_num line_num:I tax_num prvdr_spclty
        prtcptng_ind_cd line_srvc_cnt:I line_cms_type_srvc_cd line_place_of_srvc_cd
        line_1st_expns_dt:D line_last_expns_dt:D hcpcs_cd hcpcs_1st_mdfr_cd hcpcs_2nd_mdfr_cd
        betos_cd line_nch_pmt_amt:N line_bene_pmt_amt:N line_prvdr_pmt_amt:N
        line_bene_ptb_ddctbl_amt:N line_bene_prmry_pyr_cd line_bene_prmry_pyr_pd_amt:N
        line_prmry_alowd_chrg_amt:N line_sbmtd_chrg_amt:N line_alowd_chrg_amt:N line_prcsg_ind_cd
        line_pmt_80_100_cd line_service_deductible line_icd_dgns_vrsn_cd prvdr_num prvdr_npi
        dmerc_line_prcng_state_cd prvdr_state_cd dmerc_line_supplr_type_cd hcpcs_3rd_mdfr_cd
        hcpcs_4th_mdfr_cd dmerc_line_scrn_svgs_amt:N dmerc_line_mtus_cnt:I dmerc_line_mtus_cd
        line_hct_hgb_rslt_num line_ndc_cd
    """)
)


SNF = (
    cols("""
        bene_id clm_id nch_near_line_rec_ident_cd nch_clm_type_cd clm_from_dt:D clm_thru_dt:D
        nch_wkly_proc_dt:D fi_clm_proc_dt:D claim_query_code prvdr_num clm_fac_type_cd
        clm_srvc_clsfctn_type_cd clm_freq_cd fi_num clm_mdcr_non_pmt_rsn_cd clm_pmt_amt:N
        nch_prmry_pyr_clm_pd_amt:N nch_prmry_pyr_cd fi_clm_actn_cd prvdr_state_cd org_npi_num
        at_physn_upin at_physn_npi op_physn_upin op_physn_npi ot_physn_upin ot_physn_npi
        clm_mco_pd_sw ptnt_dschrg_stus_cd clm_pps_ind_cd clm_tot_chrg_amt:N clm_admsn_dt:D
        clm_ip_admsn_type_cd clm_src_ip_admsn_cd nch_ptnt_status_ind_cd nch_bene_ip_ddctbl_amt:N
        nch_bene_pta_coinsrnc_lblty_am:N nch_bene_blood_ddctbl_lblty_am:N nch_ip_ncvrd_chrg_amt:N
        nch_ip_tot_ddctn_amt:N clm_pps_cptl_fsp_amt:N clm_pps_cptl_outlier_amt:N
        clm_pps_cptl_dsprprtnt_shr_amt:N clm_pps_cptl_ime_amt:N clm_pps_cptl_excptn_amt:N
        clm_pps_old_cptl_hld_hrmls_amt:N clm_utlztn_day_cnt:I bene_tot_coinsrnc_days_cnt:I
        clm_non_utlztn_days_cnt:I nch_blood_pnts_frnshd_qty:N nch_qlfyd_stay_from_dt:D
        nch_qlfyd_stay_thru_dt:D nch_vrfd_ncvrd_stay_from_dt:D nch_vrfd_ncvrd_stay_thru_dt:D
        nch_actv_or_cvrd_lvl_care_thru:D nch_bene_mdcr_bnfts_exhtd_dt_i:D nch_bene_dschrg_dt:D
        clm_drg_cd admtg_dgns_cd prncpal_dgns_cd
    """)
    + series("1..25", "icd_dgns_cd#")
    + cols("fst_dgns_e_cd")
    + series("1..12", "icd_dgns_e_cd#")
    + series("1..25", "icd_prcdr_cd#", "prcdr_dt#:D")
    + cols("""
        clm_line_num:I rev_cntr hcpcs_cd rev_cntr_unit_cnt:I rev_cntr_rate_amt:N
        rev_cntr_tot_chrg_amt:N rev_cntr_ncvrd_chrg_amt:N rev_cntr_ddctbl_coinsrnc_cd
        rev_cntr_ndc_qty:I rev_cntr_ndc_qty_qlfr_cd rndrng_physn_upin rndrng_physn_npi
    """)
)


HOSPICE = (
    cols("""
        bene_id clm_id nch_near_line_rec_ident_cd nch_clm_type_cd clm_from_dt:D clm_thru_dt:D
        nch_wkly_proc_dt:D fi_clm_proc_dt:D prvdr_num clm_fac_type_cd clm_srvc_clsfctn_type_cd
        clm_freq_cd fi_num clm_mdcr_non_pmt_rsn_cd clm_pmt_amt:N nch_prmry_pyr_clm_pd_amt:N
        nch_prmry_pyr_cd prvdr_state_cd org_npi_num at_physn_upin at_physn_npi ptnt_dschrg_stus_cd
        clm_tot_chrg_amt:N nch_ptnt_status_ind_cd clm_utlztn_day_cnt:I nch_bene_dschrg_dt:D
        prncpal_dgns_cd
    """)
    + series("1..25", "icd_dgns_cd#")
    + cols("fst_dgns_e_cd")
    + series("1..12", "icd_dgns_e_cd#")
    + cols("""
        clm_hospc_start_dt_id:D bene_hospc_prd_cnt:I claim_query_code clm_line_num:I rev_cntr
        rev_cntr_dt:D hcpcs_cd hcpcs_1st_mdfr_cd hcpcs_2nd_mdfr_cd rev_cntr_unit_cnt:I
        rev_cntr_rate_amt:N rev_cntr_prvdr_pmt_amt:N rev_cntr_bene_pmt_amt:N rev_cntr_pmt_amt_amt:N
        rev_cntr_tot_chrg_amt:N rev_cntr_ncvrd_chrg_amt:N rev_cntr_ddctbl_coinsrnc_cd
        rev_cntr_ndc_qty:I rev_cntr_ndc_qty_qlfr_cd rndrng_physn_upin rndrng_physn_npi
    """)
)


HHA = (
    cols("""
        bene_id clm_id nch_near_line_rec_ident_cd nch_clm_type_cd clm_from_dt:D clm_thru_dt:D
        nch_wkly_proc_dt:D fi_clm_proc_dt:D prvdr_num clm_fac_type_cd clm_srvc_clsfctn_type_cd
        clm_freq_cd fi_num clm_mdcr_non_pmt_rsn_cd clm_pmt_amt:N nch_prmry_pyr_clm_pd_amt:N
        nch_prmry_pyr_cd prvdr_state_cd org_npi_num at_physn_upin at_physn_npi ptnt_dschrg_stus_cd
        clm_pps_ind_cd clm_tot_chrg_amt:N prncpal_dgns_cd
    """)
    + series("1..25", "icd_dgns_cd#")
    + cols("fst_dgns_e_cd")
    + series("1..12", "icd_dgns_e_cd#")
    + cols("""
        clm_hha_lupa_ind_cd clm_hha_rfrl_cd clm_hha_tot_visit_cnt:I clm_admsn_dt:D claim_query_code
        clm_line_num:I rev_cntr rev_cntr_dt:D rev_cntr_1st_ansi_cd rev_cntr_apc_hipps_cd hcpcs_cd
        hcpcs_1st_mdfr_cd hcpcs_2nd_mdfr_cd rev_cntr_pmt_mthd_ind_cd rev_cntr_unit_cnt:I
        rev_cntr_rate_amt:N rev_cntr_pmt_amt_amt:N rev_cntr_tot_chrg_amt:N rev_cntr_ncvrd_chrg_amt:N
        rev_cntr_ddctbl_coinsrnc_cd rev_cntr_stus_ind_cd rev_cntr_ndc_qty:I rev_cntr_ndc_qty_qlfr_cd
        rndrng_physn_upin rndrng_physn_npi
    """)
)


PDE = (
    cols("""
        pde_id bene_id srvc_dt:D pd_dt:D prscrbr_id_qlfyr_cd prscrbr_id rx_srvc_rfrnc_num
        prod_srvc_id plan_cntrct_rec_id plan_pbp_rec_num cmpnd_cd daw_prod_slctn_cd qty_dspnsd_num:Q
        days_suply_num:I fill_num:I dspnsng_stus_cd drug_cvrg_stus_cd adjstmt_dltn_cd nstd_frmt_cd
        prcng_excptn_cd ctstrphc_cvrg_cd gdc_blw_oopt_amt:N gdc_abv_oopt_amt:N ptnt_pay_amt:N
        othr_troop_amt:N lics_amt:N plro_amt:N cvrd_d_plan_pd_amt:N ncvrd_plan_pd_amt:N
        tot_rx_cst_amt:N rx_orgn_cd rptd_gap_dscnt_num:N brnd_gnrc_cd phrmcy_srvc_type_cd
        ptnt_rsdnc_cd submsn_clr_cd
    """)
)


CLAIM_LAYOUTS: dict[str, Layout] = {
    "inpatient": INPATIENT,
    "outpatient": OUTPATIENT,
    "carrier": CARRIER,
    "dme": DME,
    "snf": SNF,
    "hospice": HOSPICE,
    "hha": HHA,
}

CODE_LIST = cols("""
    icd_dgns_cd description is_billable chapter_num chapter_desc
    block_code block_desc parent_code parent_desc
""")
