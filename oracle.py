"""SQL for a second engine: the expected rows of every registered query.

Written relation by relation (existence tests, joined text, range joins, lag lists), where the Spark
side uses flags, one aggregation and carried values, so that the two check each other.
"""

from __future__ import annotations

from termloom.sources import star
from termloom.sources.star import STAR_CONFIG as CFG

# Fixed values of the input and the target, stated here so that a wrong one in the package shows.
LAYOUT = tuple(
    """
    pidm term_code_eff stst_code levl_code styp_code term_code_matric term_code_admit exp_grad_date camp_code
    full_part_ind sess_code resd_code coll_code_1 degc_code_1 majr_code_1 majr_code_minr_1 majr_code_minr_1_2
    majr_code_conc_1 majr_code_conc_1_2 majr_code_conc_1_3 coll_code_2 degc_code_2 majr_code_2 majr_code_minr_2
    majr_code_minr_2_2 majr_code_conc_2 majr_code_conc_2_2 majr_code_conc_2_3 orsn_code prac_code advr_pidm
    grad_credit_appr_ind capl_code leav_code leav_from_date leav_to_date astd_code term_code_astd rate_code
    activity_date majr_code_1_2 majr_code_2_2 edlv_code incm_code admt_code emex_code aprn_code trcn_code
    gain_code voed_code blck_code term_code_grad acyr_code dept_code site_code dept_code_2 egol_code
    degc_code_dual levl_code_dual dept_code_dual coll_code_dual majr_code_dual bskl_code prim_roll_ind program_1
    term_code_ctlg_1 dept_code_1_2 majr_code_conc_121 majr_code_conc_122 majr_code_conc_123 secd_roll_ind
    term_code_admit_2 admt_code_2 program_2 term_code_ctlg_2 levl_code_2 camp_code_2 dept_code_2_2
    majr_code_conc_221 majr_code_conc_222 majr_code_conc_223 curr_rule_1 cmjr_rule_1_1 ccon_rule_11_1
    ccon_rule_11_2 ccon_rule_11_3 cmjr_rule_1_2 ccon_rule_12_1 ccon_rule_12_2 ccon_rule_12_3 cmnr_rule_1_1
    cmnr_rule_1_2 curr_rule_2 cmjr_rule_2_1 ccon_rule_21_1 ccon_rule_21_2 ccon_rule_21_3 cmjr_rule_2_2
    ccon_rule_22_1 ccon_rule_22_2 ccon_rule_22_3 cmnr_rule_2_1 cmnr_rule_2_2 prev_code term_code_prev cast_code
    term_code_cast data_origin user_id scpc_code surrogate_id version vpdi_code guid sort
    """.split()
)
FILLED = tuple(
    """
    coll_code_1 degc_code_1 majr_code_1 majr_code_conc_1 coll_code_2 degc_code_2 majr_code_2 program_1 program_2
    """.split()
)
CURRICULUM = tuple(
    """
    major_1 degr_cde div_cde major_2 concentration_1
    """.split()
)
MILESTONES = {
    "entry_dte": "entry date",
    "exit_dte": "exit date",
    "dte_degr_conferred": "degree conferred date",
    "withdrawal_dte": "withdrawal date",
}


def _list(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


def _code(date: str) -> str:
    return f"CAST(year({date}) * 100 + month({date}) AS INTEGER)"


def _in(values) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


def _date(y: str, day: tuple[int, int]) -> str:
    return f"make_date({y}, {day[0]}, {day[1]})"


# ---- inputs -------------------------------------------------------------------------------------

_TERMS = " UNION ALL ".join(
    f"SELECT {year} AS yr_cde, '{code}' AS trm_cde, {_date('y', begin)} AS trm_begin_dte, "
    f"{_date('y', end)} AS trm_end_dte FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)"
    for year, code, begin, end in star.TERMS
)
_DIGITS = f"(SELECT unnest({list(star.ACCOUNT_DIGITS)}) AS d)"
_CONCS = f"(SELECT unnest({list(star.CONCENTRATIONS)}) AS conc)"

INPUTS = {
    "year_terms": f"{_TERMS} UNION ALL SELECT 'ZZZZ', 'ZZ', DATE '1900-01-01', DATE '1900-01-01'",
    "courses": (
        f"SELECT {_list(star.COURSES)} FROM lineitem "
        f"JOIN (SELECT {_list(star.COURSE_ORDER)} FROM orders) ON l_orderkey = o_orderkey"
    ),
    "candidacy": (
        f"SELECT {_list({k: v for k, v in star.CANDIDACY_GROUP.items() if k != 'half'})}, {_list(star.CANDIDACY)} FROM orders "
        f"GROUP BY {', '.join(star.CANDIDACY_GROUP.values())}"
    ),
    "degrees": (
        f"SELECT {_list(star.DEGREES)} FROM (SELECT {star.ACCOUNT} AS id_num, o_orderpriority, {_list(star.RECORD)} "
        f"FROM orders GROUP BY {star.ACCOUNT}, o_orderpriority)"
    ),
    "majors": f"SELECT {_list(star.MAJORS)} FROM (SELECT DISTINCT p_size, {star.MAJOR_TWIN} AS twin FROM part)",
    "cohort": f"SELECT {_list(star.ACCOUNTS)} FROM customer, {_DIGITS} WHERE {star.COHORT_ROWS}",
    "code_map": f"SELECT {_list(star.CODE_MAP)} FROM (SELECT DISTINCT * FROM majors), {_CONCS}",
    "degree_map": (
        f"SELECT {_list(star.DEGREE_MAP)} FROM (SELECT DISTINCT degr_cde FROM majors) WHERE {star.DEGREE_MAP_ROWS}"
    ),
    "external_ids": f"SELECT {_list(star.EXTERNAL_IDS)} FROM customer, {_DIGITS} WHERE {star.EXTERNAL_IDS_ROWS}",
}

# ---- calendar, events, collapse -----------------------------------------------------------------

_OWN = (
    f"transaction_sts <> '{CFG.dropped_status}' AND grade_cde NOT IN {_in(CFG.transfer_grades)} "
    f"AND trm_cde <> '{CFG.transfer_term}' AND yr_cde <> '{CFG.transfer_year}'"
)
_MOVED = f"(yr_cde = '{CFG.transfer_year}' OR trm_cde = '{CFG.transfer_term}')"
_ACTIVE = (
    f"transaction_sts <> '{CFG.dropped_status}' AND yr_cde = '{CFG.active_year}' "
    f"AND trm_cde IN {_in(CFG.active_terms)} AND credit_hrs > 0"
)
_CUR = ", ".join(CURRICULUM)
_MILESTONES = " UNION ".join(
    f"SELECT id_num, {column} AS sig_date, '{label}' AS sig_desc, "
    f"{'exit_reason' if column == 'exit_dte' else repr('')} AS reason_code, {_CUR} FROM degrees"
    for column, label in MILESTONES.items()
)
_BLANKS = ", ".join(f"'' AS {c}" for c in CURRICULUM)
_RANKS = " ".join(f"WHEN '{c}' THEN {n}" for c, n in CFG.credit_type_ranks.items())
_LEVELS = " ".join(f"WHEN {column} IN {_in(codes)} THEN {level}" for column, codes, level in CFG.level_rules)

RELATIONS = {
    "cal": f"""
        SELECT *, CAST(lead(trm_begin_dte) OVER (ORDER BY trm_begin_dte NULLS FIRST, yr_cde, trm_cde)
                       - INTERVAL 1 DAY AS DATE) AS extend_trm_end_dte, {_code('trm_begin_dte')} AS term_code
        FROM year_terms WHERE yr_cde <> '{CFG.dummy_year}'""",
    "major_degree": "SELECT major_cde, CASE major_cde "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CFG.major_degree_overrides.items())
    + " ELSE degr_cde END AS degr_cde FROM majors",
    "course_terms": "SELECT c.*, trm_begin_dte, term_code FROM courses c LEFT JOIN cal USING (yr_cde, trm_cde)",
    "own_courses": f"SELECT * FROM course_terms WHERE {_OWN} AND credit_hrs > 0",
    "term_hours": "SELECT id_num, term_code, sum(hrs_attempted) AS hours FROM course_terms GROUP BY ALL",
    "loads": f"""
        SELECT c.*, trm_begin_dte, trm_end_dte, extend_trm_end_dte, term_code
        FROM candidacy c LEFT JOIN cal USING (yr_cde, trm_cde)
        WHERE c.yr_cde <> '{CFG.dummy_year}' OR c.trm_cde <> '{CFG.dummy_term}'""",
    "bounds": """
        SELECT id_num, min(trm_begin_dte) AS first_on, max(trm_begin_dte) AS last_on FROM own_courses GROUP BY id_num""",
    "milestones": _MILESTONES,
    "timeline": f"""
        SELECT * FROM milestones WHERE sig_date IS NOT NULL
        UNION SELECT id_num, first_on, 'start enroll', '', {_BLANKS} FROM bounds
        UNION SELECT id_num, last_on, 'last enroll', '', {_BLANKS} FROM bounds""",
    "placed": """
        SELECT t.*, term_code FROM timeline t
        LEFT JOIN cal ON t.sig_date BETWEEN trm_begin_dte AND extend_trm_end_dte""",
    "majors_seen": """
        SELECT DISTINCT id_num, term_code, trim(major_1) AS major_1, a.degr_cde AS mmd_degr_cde,
               trim(major_2) AS major_2, b.degr_cde AS mmd2_degr_cde, trim(concentration_1) AS concentration_1,
               p.degr_cde
        FROM placed p LEFT JOIN major_degree a ON a.major_cde = major_1 LEFT JOIN major_degree b ON b.major_cde = major_2""",
    "degrees_seen": f"""
        SELECT DISTINCT id_num, term_code, trim(degr_cde) AS degr_cde, CASE {_LEVELS} END AS degree_level FROM placed""",
    "majors_text": """
        SELECT id_num, term_code, string_agg(major_1, ';' ORDER BY major_1) AS agg_major_1,
               string_agg(major_2, ';' ORDER BY major_2) AS agg_major_2,
               string_agg(concentration_1, ';' ORDER BY concentration_1) AS agg_concentration_1
        FROM majors_seen GROUP BY ALL""",
    "degrees_text": """
        SELECT id_num, term_code, string_agg(degr_cde, ';' ORDER BY degr_cde) AS agg_degree_code,
               max(degree_level) AS highest_degree
        FROM degrees_seen GROUP BY ALL""",
    "events_text": """
        SELECT id_num, term_code, string_agg(sig_desc, ';' ORDER BY sig_desc) AS agg_sig_desc,
               string_agg(reason_code, ';' ORDER BY reason_code) AS agg_reason_code
        FROM placed SEMI JOIN cohort USING (id_num) GROUP BY ALL""",
    "row_counts": "SELECT id_num, count(*) AS row_count FROM events_text GROUP BY id_num",
    "ranks": f"""
        SELECT id_num, term_code, max(CASE credit_type_cde {_RANKS} END) AS max_credit_type_rank
        FROM own_courses GROUP BY ALL""",
    "attempting": f"SELECT DISTINCT id_num FROM courses WHERE {_OWN} AND hrs_attempted > 0",
}

_LAST_DAY = "DATE '2002-12-31'"

# ---- rules --------------------------------------------------------------------------------------

# Several candidacy rows of one term are told apart by their codes, from then on by row_num.
_W = (
    "OVER (PARTITION BY id_num ORDER BY term_code NULLS FIRST, load_p_f NULLS FIRST, "
    "candidacy_type NULLS FIRST)"
)
_R = "OVER (PARTITION BY id_num ORDER BY row_num)"


def _has(event: str, text: str = "agg_sig_desc") -> str:
    return f"contains({text}, '{event}')"


def _name(value: str, other: str = "NULL") -> str:
    return f"CASE {value} WHEN 3 THEN 'UG' WHEN 2 THEN 'VO' WHEN 1 THEN 'CE' ELSE {other} END"


def _load(h: str) -> str:
    return f"WHEN {h} >= {CFG.full_time_hours} THEN 'F' WHEN {h} > 0 THEN 'P'"


_LEAVES = f"({_has('last enroll')} OR {_has('withdrawal date')})"
_NO_MARK = " AND ".join(f"NOT contains(agg_degree_code, '{m}')" for m in (f";{CFG.degree_middle_mark};", *CFG.degree_marks))
_BY_RANK = _name("max_credit_type_rank", "'00'")

RELATIONS |= {
    "facts": """
        SELECT e.*, agg_major_1, agg_major_2, agg_concentration_1, agg_degree_code, highest_degree, row_count, hours,
               load_p_f, candidacy_type, max_credit_type_rank
        FROM events_text e SEMI JOIN attempting USING (id_num)
        LEFT JOIN majors_text USING (id_num, term_code) LEFT JOIN degrees_text USING (id_num, term_code)
        LEFT JOIN row_counts USING (id_num) LEFT JOIN loads USING (id_num, term_code)
        LEFT JOIN term_hours USING (id_num, term_code) LEFT JOIN ranks USING (id_num, term_code)""",
    "placed_facts": f"""
        SELECT *, row_number() {_W} AS row_num, lag(hours) {_W} AS hours_before, lead(hours) {_W} AS hours_after,
               lag(highest_degree) {_W} AS level_before, lead(highest_degree) {_W} AS level_after,
               lag(agg_sig_desc) {_W} AS events_before, lead(agg_sig_desc) {_W} AS events_after,
               EXISTS (FROM courses c WHERE c.id_num = facts.id_num AND {_MOVED}) AS moved,
               EXISTS (FROM courses c WHERE c.id_num = facts.id_num AND {_ACTIVE}) AS active,
               {_has('entry date')} OR {_has('start enroll')} AS starts
        FROM facts""",
    "coded": f"""
        SELECT *, CASE WHEN starts THEN term_code END AS start_term,
          CASE {_load('hours')}
            WHEN hours IS NULL AND row_num = 1 THEN CASE {_load('hours_after')} ELSE coalesce(load_p_f, 'F') END
            WHEN hours IS NULL THEN CASE {_load('hours_before')} ELSE coalesce(load_p_f, 'F') END
            ELSE coalesce(load_p_f, 'F') END AS ft_pt_ind,
          CASE WHEN highest_degree < {CFG.degree_level_floor} AND {_NO_MARK} THEN '9'
               WHEN moved THEN '2' ELSE '3' END AS ini_styp,
          CASE WHEN row_count = 1 THEN 'AS'
               WHEN row_num = row_count AND term_code < {CFG.cutoff_term} THEN 'IS'
               WHEN {_LEAVES} AND term_code < {CFG.cutoff_term} THEN 'IS'
               WHEN {_LEAVES} AND term_code IN {_in(CFG.current_terms)} THEN 'AS'
               WHEN {_has('start enroll')} OR {_has('entry date')} OR {_has('exit date')} THEN 'AS'
               WHEN {_has('degree conferred date')} THEN 'GR' END AS stst_code,
          CASE WHEN highest_degree IS NOT NULL THEN
                 CASE WHEN highest_degree = -1 THEN 'XX' ELSE {_name('highest_degree')} END
               WHEN {_has('last enroll')} AND ({_has('start enroll')} OR level_before IS NULL) THEN {_BY_RANK}
               WHEN {_has('last enroll')} THEN
                 {_name('level_before', "CASE WHEN level_before < 0 THEN '*' ELSE CAST(level_before AS VARCHAR) END")}
               WHEN {_has('start enroll')} THEN
                 CASE WHEN {_has('entry date', 'events_before')} THEN {_name('level_before', "'00'")}
                      WHEN {_has('entry date', 'events_after')} THEN {_name('level_after', "'00'")}
                      ELSE {_BY_RANK} END END AS levl_code
        FROM placed_facts""",
    "grouped": f"""
        SELECT *, CAST(sum(CASE WHEN starts THEN 1 ELSE 0 END)
                       OVER (PARTITION BY id_num ORDER BY row_num) AS BIGINT) AS hist_group FROM coded""",
    "typed": f"""
        SELECT *,
          CASE WHEN NOT starts AND lag(ini_styp) {_R} = '9' THEN 'C'
               WHEN lag(ini_styp) {_R} IN ('2', '3') THEN 'A' ELSE ini_styp END AS styp_code,
          first_value(start_term) OVER g AS term_code_admit, first_value(ft_pt_ind) OVER g AS full_part_ind
        FROM grouped WINDOW g AS (PARTITION BY id_num, hist_group ORDER BY row_num)""",
}

# ---- curriculum ---------------------------------------------------------------------------------


def _slots(entries: str) -> str:
    parts = "coalesce({0}.mmd_degr_cde, '') || coalesce({0}.major_1, '') || coalesce({0}.concentration_1, '')"
    columns = ", ".join(
        f"s{n}.major_1 AS major_{n}, s{n}.mmd_degr_cde AS degree_{n}, s{n}.concentration_1 AS concentration_{n}, "
        f"{parts.format(f's{n}')} AS map_key_{n}"
        for n in (1, 2)
    )
    return f"""
        WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY id_num, term_code ORDER BY
            mmd_degr_cde NULLS FIRST, major_1 NULLS FIRST, degree_history_degr_cde NULLS FIRST,
            concentration_1 NULLS FIRST) AS slot FROM {entries})
        SELECT s1.id_num, s1.term_code, {columns} FROM (FROM numbered WHERE slot = 1) s1
        LEFT JOIN (FROM numbered WHERE slot = 2) s2
          ON s1.id_num = s2.id_num AND s1.term_code IS NOT DISTINCT FROM s2.term_code"""


_CERTS = _in(CFG.certificate_degrees)
_BARE = "coll_code_1 IS NULL AND row_num = 1"
_DEFAULTS = f"""CASE WHEN {_BARE} THEN '{CFG.first_row_college}' ELSE coll_code_1 END AS coll_code_1,
    CASE WHEN {_BARE} THEN '{CFG.first_row_degree}' ELSE degc_code_1 END AS degc_code_1,
    CASE WHEN majr_code_1 IS NULL AND {_BARE} THEN '{CFG.first_row_major}' ELSE majr_code_1 END AS majr_code_1,
    CASE WHEN agg_major_1 IS NULL THEN NULL WHEN {_BARE} THEN '{CFG.first_row_program}' ELSE program_1 END AS program_1"""


def _pick(n: int, column: str, other: str) -> str:
    return f"CASE WHEN active THEN f{n}.{column} ELSE {other} END"


def _filled(c: str) -> str:
    lags = ", ".join(f"lag({c}, {k}) {_R}" for k in range(1, CFG.fill_depth + 1))
    return f"coalesce({c}, {lags}) AS {c}"


def _shift(term: str) -> str:
    arms = " ".join(f"WHEN {term} % 100 = {m} THEN {term} - {m - to}" for m, to in CFG.month_shift.items())
    return f"CASE {arms} ELSE {term} END"


_FIXED = {"camp_code": CFG.campus, "resd_code": CFG.residence, "admt_code": CFG.admit_type}
_PLAIN = {"levl_code", "styp_code", "full_part_ind", "majr_code_conc_2", "majr_code_1_2", *FILLED}


def _layout(computed: dict[str, str]) -> str:
    values = {
        "term_code_admit": _shift("term_code_admit"),
        "term_code_ctlg_1": _shift("term_code_admit"),
        "term_code_ctlg_2": f"CASE WHEN program_2 IS NOT NULL THEN {_shift('term_code_admit')} END",
        **{c: c for c in _PLAIN},
        **{c: repr(v) for c, v in _FIXED.items()},
        **computed,
    }
    return ", ".join(f"{values.get(c, repr(''))} AS {CFG.column_prefix if c != 'sort' else ''}{c}" for c in LAYOUT)


_NEXT = "coalesce(next_term, term_code)"
_BRANCHES = (
    {"pidm": "pidm", "term_code_eff": _shift("term_code"), "stst_code": "stst_code", "sort": "1"},
    {
        "pidm": "pidm",
        "term_code_eff": _shift(_NEXT),
        "stst_code": f"CASE WHEN term_code < {CFG.cutoff_term} THEN 'IS' ELSE 'AS' END",
        "sort": "2",
    },
)

RELATIONS |= {
    "term_majors": """
        SELECT id_num, term_code, major_1, mmd_degr_cde, degr_cde AS degree_history_degr_cde, concentration_1
        FROM majors_seen WHERE major_1 IS NOT NULL AND major_1 <> ''
        UNION SELECT id_num, term_code, major_2, mmd2_degr_cde, degr_cde, concentration_1
        FROM majors_seen WHERE major_2 IS NOT NULL AND major_2 <> ''""",
    "degree_entries": f"SELECT * FROM term_majors WHERE mmd_degr_cde NOT IN {_CERTS}",
    "cert_entries": f"SELECT * FROM term_majors WHERE mmd_degr_cde IN {_CERTS}",
    "degree_pairs": _slots("degree_entries"),
    "cert_pairs": _slots("cert_entries"),
    "mapped": f"""
        SELECT t.*, degree_1, degree_2, major_1, major_2,
          {_pick(1, 'college', 'p1.college')} AS coll_code_1, {_pick(1, 'degree', 'p1.degree')} AS degc_code_1,
          {_pick(1, 'major', 'major_1')} AS majr_code_1, {_pick(1, 'concentration', 'NULL')} AS majr_code_conc_1,
          CASE WHEN degree_1 <> degree_2 THEN {_pick(2, 'college', 'p2.college')} END AS coll_code_2,
          CASE WHEN degree_1 <> degree_2 THEN {_pick(2, 'degree', 'p2.degree')} END AS degc_code_2,
          CASE WHEN degree_1 <> degree_2 THEN {_pick(2, 'major', 'major_2')} END AS majr_code_2,
          CASE WHEN agg_major_1 IS NOT NULL AND degree_1 <> degree_2
               THEN {_pick(2, 'concentration', 'NULL')} END AS majr_code_conc_2,
          CASE WHEN degree_1 = degree_2 THEN {_pick(2, 'major', 'major_2')} END AS majr_code_1_2,
          {_pick(1, 'program', 'p1.program')} AS program_1,
          CASE WHEN agg_major_1 IS NULL THEN NULL
               WHEN active THEN CASE WHEN degree_1 <> degree_2 THEN f2.program END
               ELSE p2.program END AS program_2
        FROM typed t LEFT JOIN degree_pairs d USING (id_num, term_code)
        LEFT JOIN code_map f1 ON f1.map_code = map_key_1 LEFT JOIN code_map f2 ON f2.map_code = map_key_2
        LEFT JOIN degree_map p1 ON p1.degree_code = degree_1 LEFT JOIN degree_map p2 ON p2.degree_code = degree_2""",
    "defaulted": f"SELECT * REPLACE ({_DEFAULTS}) FROM mapped",
    "filled": f"SELECT * REPLACE ({', '.join(map(_filled, FILLED))}) FROM defaulted",
    "term_steps": """
        SELECT term_code, lead(term_code) OVER (ORDER BY term_code NULLS FIRST) AS next_term
        FROM (SELECT DISTINCT term_code FROM filled)""",
    "out_rows": """
        SELECT f.*, next_term, pidm FROM filled f LEFT JOIN term_steps USING (term_code)
        LEFT JOIN external_ids ON external_id = CAST(f.id_num AS VARCHAR)""",
    "converted": f"SELECT {_layout(_BRANCHES[0])} FROM out_rows UNION ALL "
    f"SELECT {_layout(_BRANCHES[1])} FROM out_rows WHERE row_count = 1",
    "user_days": """
        SELECT user_id, CAST(ts AS DATE) AS day, max(CASE WHEN event_type = 'purchase' THEN value END) AS spent,
               bool_or(event_type = 'signup') AS signed_up, count(*) AS n
        FROM events GROUP BY ALL""",
    "order_spans": f"""
        SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS first_day,
               coalesce(CAST(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey)
                             - INTERVAL 1 DAY AS DATE), {_LAST_DAY}) AS last_day
        FROM orders""",
    "typed_events": """
        SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'look' ELSE event_type END AS kind, ts,
               CAST(floor(value * 100) AS BIGINT) AS cents, CASE WHEN event_type <> 'view' THEN user_id END AS noted
        FROM events""",
    "account_quarters": f"""
        SELECT {star.ACCOUNT} AS account, CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS INTEGER) AS period,
               count(*) AS orders, min(o_orderdate) AS first_order
        FROM orders GROUP BY ALL""",
}

_DAYS = "OVER (PARTITION BY user_id ORDER BY day)"
_BY_KIND = "OVER (PARTITION BY kind ORDER BY ts, event_id)"
_TYPED = "OVER (PARTITION BY kind ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _keyed(table: str, *columns: str) -> str:
    return f"SELECT id_num, term_code, {', '.join(columns)} FROM {table}"


_MAPPED = tuple(dict.fromkeys((*FILLED, "majr_code_conc_2", "majr_code_1_2")))
_SLOTS = tuple(f"{c}_{n}" for n in (1, 2) for c in ("major", "degree", "concentration", "map_key"))

EXPECTED = {
    "term_calendar": "SELECT * EXCLUDE (term_code) FROM cal",
    "term_code": f"SELECT o_orderkey, {_code('o_orderdate')} AS term_code, "
    f"{_shift(_code('o_orderdate'))} AS shifted_term_code FROM orders",
    "major_override": "SELECT * FROM major_degree",
    "attempted_hours": "SELECT id_num, term_code, CAST(hours AS DOUBLE) AS sum_hrs_attempted FROM term_hours",
    "candidacy_terms": "SELECT * FROM loads",
    "enrolment_bounds": f"SELECT id_num, first_on AS first_term_date, last_on AS last_term_date, "
    f"{_code('first_on')} AS first_term_code FROM bounds",
    "event_unpivot": "SELECT * FROM milestones",
    "event_timeline": "SELECT * FROM timeline",
    "interval_join": "SELECT * FROM placed",
    "event_majors": "SELECT * FROM majors_seen",
    "event_degree_levels": "SELECT * FROM degrees_seen",
    "term_majors_agg": "SELECT * FROM majors_text",
    "term_degrees_agg": "SELECT * FROM degrees_text",
    "term_events": "SELECT * FROM events_text",
    "rows_per_student": "SELECT * FROM row_counts",
    "credit_type_rank": "SELECT * FROM ranks",
    "cohort_semi": "SELECT id_num, term_code FROM events_text SEMI JOIN attempting USING (id_num)",
    "student_flags": f"""
        SELECT DISTINCT id_num, EXISTS (FROM courses c WHERE c.id_num = s.id_num AND {_MOVED}) AS is_transfer,
               EXISTS (FROM courses c WHERE c.id_num = s.id_num AND {_ACTIVE}) AS is_active,
               id_num IN (SELECT id_num FROM attempting) AS has_attempted FROM courses s""",
    "first_term_flag": f"""
        SELECT id_num, term_code, CASE WHEN (SELECT {_code('first_on')} FROM bounds b WHERE b.id_num = e.id_num)
               = term_code THEN 'Y' ELSE 'N' END AS is_first_term FROM events_text e""",
    "load_indicator": _keyed("coded", "row_num", "row_count", "ft_pt_ind"),
    "initial_type": _keyed("coded", "starts", "start_term", "ini_styp"),
    "status_code": _keyed("coded", "stst_code"),
    "level_code": _keyed("coded", "levl_code"),
    "student_type": _keyed("typed", "styp_code"),
    "history_groups": _keyed("grouped", "starts", "hist_group"),
    "group_first_values": _keyed("typed", "hist_group", "term_code_admit", "full_part_ind"),
    "major_slots_unpivot": "SELECT * FROM term_majors",
    "degree_split": "SELECT *, 'degree' AS kind FROM degree_entries UNION ALL SELECT *, 'certificate' FROM cert_entries",
    "degree_count": "SELECT id_num, term_code, count(*) AS count_degree FROM degree_entries GROUP BY ALL",
    "degree_slots": _keyed("degree_pairs", *_SLOTS),
    "certificate_slots": _keyed("cert_pairs", *_SLOTS),
    "mapped_codes": _keyed("mapped", *_MAPPED),
    "first_row_defaults": _keyed("defaulted", *_MAPPED),
    "fill_forward_6": _keyed("filled", *_MAPPED),
    "next_observed_term": "SELECT * FROM term_steps",
    "follow_up_rows": f"""
        SELECT id_num, {_shift('term_code')} AS term_code_eff, stst_code, 1 AS sort FROM out_rows
        UNION ALL SELECT id_num, {_shift(_NEXT)}, {_BRANCHES[1]['stst_code']}, 2 FROM out_rows WHERE row_count = 1""",
    "layout": f"SELECT {_layout(_BRANCHES[0])} FROM out_rows",
    "student_term_history": "SELECT * FROM converted",
    "daily_fill_forward": f"""
        SELECT user_id, day, n, coalesce(spent, {', '.join(f'lag(spent, {k}) {_DAYS}' for k in range(1, 7))}) AS spent
        FROM user_days""",
    "daily_marker_groups": f"""
        SELECT user_id, day, n, CAST(count(*) FILTER (signed_up) {_DAYS} AS BIGINT) AS visit FROM user_days""",
    "order_line_slots": """
        SELECT l_orderkey, max(CASE WHEN slot = 1 THEN l_partkey END) AS l_partkey_1,
               max(CASE WHEN slot = 1 THEN l_suppkey END) AS l_suppkey_1,
               max(CASE WHEN slot = 2 THEN l_partkey END) AS l_partkey_2,
               max(CASE WHEN slot = 2 THEN l_suppkey END) AS l_suppkey_2
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey) AS slot
              FROM lineitem) GROUP BY l_orderkey""",
    "shipment_terms": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, term_code FROM lineitem
        LEFT JOIN cal ON CAST(l_shipdate AS DATE) BETWEEN trm_begin_dte AND extend_trm_end_dte""",
    "single_quarter_follow_up": """
        WITH q AS (SELECT *, count(*) OVER (PARTITION BY account) AS quarters FROM account_quarters)
        SELECT *, 1 AS part FROM q UNION ALL SELECT *, 2 FROM q WHERE quarters = 1""",
    "order_periods": "SELECT * FROM order_spans",
    "keyed_interval_join": """
        SELECT l_orderkey, l_linenumber, ship_day, s.o_custkey, p.o_orderkey, p.first_day
        FROM (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day, o_custkey
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey) s
        LEFT JOIN order_spans p ON p.o_custkey = s.o_custkey AND ship_day BETWEEN p.first_day AND p.last_day""",
    "shipment_intervals": f"""
        SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_day,
               coalesce(CAST(lead(CAST(l_shipdate AS DATE)) OVER (ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber)
                             - INTERVAL 1 DAY AS DATE), {_LAST_DAY}) AS until
        FROM lineitem""",
    "next_observed_time": "SELECT ts, lead(ts) OVER (ORDER BY ts) AS next_ts FROM (SELECT DISTINCT ts FROM events)",
    "spread_lookup": """
        WITH coded AS (
            SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN '' WHEN l_linenumber < 7 THEN CAST(l_partkey AS VARCHAR) END AS code
            FROM lineitem),
        parts AS (
            SELECT CAST(p_partkey AS VARCHAR) AS code, p_name, p_brand FROM part UNION ALL SELECT '', min(p_name), max(p_brand) FROM part)
        SELECT l_orderkey, l_linenumber, c.code, p_name, p_brand FROM coded c LEFT JOIN parts p ON c.code = p.code""",
    "hot_running_sum": f"""
        SELECT event_id, kind, cents, CAST(count(*) {_TYPED} AS BIGINT) AS nth, CAST(sum(cents) {_TYPED} AS BIGINT) AS total_cents,
               last_value(noted IGNORE NULLS) {_TYPED} AS last_noted
        FROM typed_events""",
    "hot_fill_forward": f"""
        SELECT event_id, kind, coalesce(noted, {', '.join(f'lag(noted, {k}) {_BY_KIND}' for k in range(1, CFG.fill_depth + 1))}) AS noted
        FROM typed_events""",
    "hot_marker_groups": f"""
        WITH g AS (SELECT *, CAST(count(*) FILTER (event_id % 50 = 0) {_TYPED} AS BIGINT) AS visit FROM typed_events)
        SELECT event_id, kind, visit, CASE WHEN visit > 0 THEN
            first_value(noted) OVER (PARTITION BY kind, visit ORDER BY ts, event_id) END AS first_noted FROM g""",
}


def expected_sql(own_inputs: bool = False) -> dict[str, str]:
    """SQL per query. With ``own_inputs`` the nine input tables must exist instead of the star schema."""
    relations = RELATIONS if own_inputs else INPUTS | RELATIONS
    chain = ", ".join(f"{name} AS ({text})" for name, text in relations.items())
    return {key: f"WITH {chain} SELECT * FROM ({text})" for key, text in EXPECTED.items()}
