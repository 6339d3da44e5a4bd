"""The output columns."""

# Column names in output order, without the prefix.
LAYOUT: tuple[str, ...] = tuple(
    """
    pidm term_code_eff stst_code levl_code styp_code term_code_matric term_code_admit exp_grad_date
    camp_code full_part_ind sess_code resd_code
    coll_code_1 degc_code_1 majr_code_1 majr_code_minr_1 majr_code_minr_1_2
    majr_code_conc_1 majr_code_conc_1_2 majr_code_conc_1_3
    coll_code_2 degc_code_2 majr_code_2 majr_code_minr_2 majr_code_minr_2_2
    majr_code_conc_2 majr_code_conc_2_2 majr_code_conc_2_3
    orsn_code prac_code advr_pidm grad_credit_appr_ind capl_code leav_code leav_from_date leav_to_date
    astd_code term_code_astd rate_code activity_date
    majr_code_1_2 majr_code_2_2 edlv_code incm_code admt_code emex_code
    aprn_code trcn_code gain_code voed_code blck_code term_code_grad acyr_code dept_code site_code
    dept_code_2 egol_code degc_code_dual levl_code_dual dept_code_dual coll_code_dual majr_code_dual
    bskl_code prim_roll_ind
    program_1 term_code_ctlg_1 dept_code_1_2 majr_code_conc_121 majr_code_conc_122 majr_code_conc_123
    secd_roll_ind term_code_admit_2 admt_code_2 program_2 term_code_ctlg_2
    levl_code_2 camp_code_2 dept_code_2_2 majr_code_conc_221 majr_code_conc_222 majr_code_conc_223
    curr_rule_1 cmjr_rule_1_1 ccon_rule_11_1 ccon_rule_11_2 ccon_rule_11_3
    cmjr_rule_1_2 ccon_rule_12_1 ccon_rule_12_2 ccon_rule_12_3 cmnr_rule_1_1 cmnr_rule_1_2
    curr_rule_2 cmjr_rule_2_1 ccon_rule_21_1 ccon_rule_21_2 ccon_rule_21_3
    cmjr_rule_2_2 ccon_rule_22_1 ccon_rule_22_2 ccon_rule_22_3 cmnr_rule_2_1 cmnr_rule_2_2
    prev_code term_code_prev cast_code term_code_cast data_origin user_id scpc_code surrogate_id
    version vpdi_code guid
    sort
    """.split()
)
