"""Writes a small set of the 19 extracts, with the awkward rows in them.

Each claim is a dict of header values and a list of lines; all other columns
stay empty.  Values are written as given, so quotes and blanks are under
control of the caller.
"""

from __future__ import annotations

from pathlib import Path

from claimweave.sources.layouts import BENEFICIARY, CLAIM_LAYOUTS, PDE, Layout, line_key, names

YEARS = (2015, 2016, 2025)

PERSONS = {
    2015: [
        {"bene_id": "-1", "state_code": "01", "zip_cd": "00501", "bene_birth_dt": "16-Aug-1939",
         "sex_ident_cd": "1", "rti_race_cd": "1", "age_at_end_ref_yr": "76",
         "bene_hi_cvrage_tot_mons": "12", "dual_elgbl_mons": "0"},
        {"bene_id": "-2", "state_code": "05", "zip_cd": "12345", "bene_birth_dt": "5-Aug-1940",
         "sex_ident_cd": "2", "rti_race_cd": "3", "bene_hi_cvrage_tot_mons": "1.5"},
    ],
    2016: [
        {"bene_id": "-1", "state_code": "02", "zip_cd": "00501", "bene_birth_dt": "16-Aug-1939",
         "sex_ident_cd": "1", "rti_race_cd": "1", "age_at_end_ref_yr": "77",
         "bene_hi_cvrage_tot_mons": "11", "dual_elgbl_mons": "3"},
        {"bene_id": "-3", "state_code": '""', "zip_cd": "54321", "bene_birth_dt": "31-Feb-1941",
         "bene_death_dt": "01-MAR-2016", "sex_ident_cd": "0", "rti_race_cd": "6"},
    ],
    2025: [
        {"bene_id": "-4", "state_code": "10", "zip_cd": "99999", "bene_birth_dt": "garbage",
         "sex_ident_cd": "2", "rti_race_cd": "2", "bene_hi_cvrage_tot_mons": "3"},
        # a later snapshot that lost its year
        {"bene_id": "-2", "state_code": "06", "zip_cd": "12345", "bene_enrollmt_ref_yr": "",
         "bene_birth_dt": "5-Aug-1940", "sex_ident_cd": "2", "rti_race_cd": "5"},
    ],
}

# (claim type, header values, line numbers)
CLAIMS = [
    ("inpatient", {"bene_id": "-1", "clm_id": "100", "nch_clm_type_cd": "60",
                   "clm_from_dt": "01-Feb-2015", "clm_thru_dt": "04-Feb-2015",
                   "clm_pmt_amt": "1000.50", "clm_tot_chrg_amt": "2000", "clm_drg_cd": "039",
                   "clm_utlztn_day_cnt": "3", "clm_admsn_dt": "01-Feb-2015",
                   "prvdr_state_cd": " 05 ", "ptnt_dschrg_stus_cd": '"01"',
                   "prncpal_dgns_cd": "E1165", "icd_dgns_cd1": "E1165", "icd_dgns_cd2": "E119",
                   "icd_dgns_cd25": "I10", "prcdr_dt1": "2-Feb-2015"}, ["1", "2", "3"]),
    # line 1 is missing; a quoted field holds the separator and a quote
    ("inpatient", {"bene_id": "-3", "clm_id": "101", "nch_clm_type_cd": "60",
                   "clm_from_dt": "03-Mar-2016", "clm_pmt_amt": "200.005",
                   "prvdr_num": '"A|B ""x"""', "prncpal_dgns_cd": "N183",
                   "icd_dgns_cd1": "N183"}, ["10", "2"]),
    ("outpatient", {"bene_id": "-2", "clm_id": "200", "nch_clm_type_cd": "40",
                    "clm_from_dt": "05-May-2015", "clm_pmt_amt": "10", "clm_tot_chrg_amt": "N/A",
                    "prncpal_dgns_cd": "E11", "icd_dgns_cd1": "E11", "icd_dgns_cd2": "E11",
                    "icd_dgns_cd3": "Z00"}, ["1"]),
    ("outpatient", {"bene_id": "-2", "clm_id": "201", "nch_clm_type_cd": "40",
                    "clm_from_dt": "06-May-2015", "clm_pmt_amt": "0", "prncpal_dgns_cd": "I10",
                    "icd_dgns_cd1": "I10"}, ["1", "2"]),
    # the person is in no snapshot
    ("carrier", {"bene_id": "-99", "clm_id": "300", "nch_clm_type_cd": "71",
                 "clm_from_dt": "07-Jul-2015", "clm_pmt_amt": "30.10",
                 "prncpal_dgns_cd": "E66", "icd_dgns_cd8": "E66", "icd_dgns_cd9": "J45"}, ["1"]),
    ("carrier", {"bene_id": "-4", "clm_id": "301", "nch_clm_type_cd": "71",
                 "clm_from_dt": "08-Jul-2015", "clm_pmt_amt": "31.00", "icd_dgns_cd1": "N18",
                 "icd_dgns_cd2": "E119"}, ["1", "2"]),
    ("dme", {"bene_id": "-4", "clm_id": "400", "nch_clm_type_cd": "82",
             "clm_from_dt": "09-Sep-2016", "clm_pmt_amt": "41.25", "icd_dgns_cd5": "E100",
             "icd_dgns_cd6": "F41"}, ["1"]),
    ("snf", {"bene_id": "-1", "clm_id": "500", "nch_clm_type_cd": "20",
             "clm_from_dt": "10-Oct-2016", "clm_pmt_amt": "500", "nch_bene_dschrg_dt": "20-Oct-2016",
             "icd_dgns_cd25": "N189"}, ["1"]),
    # before the first year the checks allow
    ("hospice", {"bene_id": "-1", "clm_id": "600", "nch_clm_type_cd": "50",
                 "clm_from_dt": "18-Nov-2014", "clm_pmt_amt": "60", "icd_dgns_cd6": "N182",
                 "icd_dgns_cd7": "G30"}, ["1"]),
    ("hha", {"bene_id": "-1", "clm_id": "700", "nch_clm_type_cd": "10",
             "clm_from_dt": "12-Dec-2016", "clm_pmt_amt": "70", "clm_admsn_dt": "11-Dec-2016",
             "icd_dgns_cd1": "C50"}, ["1", "2"]),
]

PDES = [
    {"pde_id": "1", "bene_id": "-1", "srvc_dt": "01-Jan-2016", "prod_srvc_id": "00000000001",
     "qty_dspnsd_num": "30.125", "days_suply_num": "30", "fill_num": "1.5", "brnd_gnrc_cd": "B",
     "drug_cvrg_stus_cd": "C", "tot_rx_cst_amt": "12.34", "ptnt_pay_amt": "N/A"},
    {"pde_id": "2", "bene_id": "-99", "srvc_dt": "02-Jan-2016", "prod_srvc_id": "0000000001",
     "brnd_gnrc_cd": "G", "drug_cvrg_stus_cd": "X", "tot_rx_cst_amt": "0.66"},
    {"pde_id": "3", "bene_id": "-1", "srvc_dt": "", "prod_srvc_id": "0000000000A",
     "brnd_gnrc_cd": "   ", "drug_cvrg_stus_cd": "E"},
]


def _write(path: Path, layout: Layout, records: list[dict[str, str]]) -> None:
    columns = names(layout)
    unknown = {key for record in records for key in record} - set(columns)
    assert not unknown, unknown
    lines = ["|".join(name.upper() for name in columns)]
    lines += ["|".join(record.get(name, "") for name in columns) for record in records]
    path.write_text("\n".join(lines) + "\n")


def write_extracts(folder: Path) -> None:
    for year in YEARS:
        people = [{"bene_enrollmt_ref_yr": str(year), **person} for person in PERSONS[year]]
        _write(folder / f"beneficiary_{year}.csv", BENEFICIARY, people)
    for claim_type, layout in CLAIM_LAYOUTS.items():
        records = [
            {**header, line_key(layout): line, "hcpcs_cd": f"H{line}"}
            for kind, header, lines in CLAIMS
            if kind == claim_type
            for line in lines
        ]
        _write(folder / f"{claim_type}.csv", layout, records)
    _write(folder / "pde.csv", PDE, PDES)
