"""Equivalent SQL for the queries, for another engine on the same tables.

Fragments are functions that return SQL text; words, weights and sentences come
from the same rule data as the jobs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from clausewise import rules
from clausewise.functions import values as v
from clausewise.operators import graph, ranking
from clausewise.plans import vocabulary as words
from clausewise.plans.queries import ENRICHED_COLUMNS, PRIORITY_COLUMNS
from clausewise.plans.views import VIEWS, sql_of

ORACLES: dict[str, str] = {}


# ------------------------------------------------------------------ fragments


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(items: Sequence[str]) -> str:
    return "(" + ", ".join(q(x) for x in items) + ")"


BLANKS = q(v.BLANKS)
RUN = r"[ \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
NUM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
EMPTY = in_list(["", *rules.EMPTY_WORDS])


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def filled(x: str) -> str:
    return f"(CASE WHEN lower({strip(x)}) IN {EMPTY} THEN NULL ELSE {strip(x)} END)"


def clean(x: str) -> str:
    return f"coalesce({filled(x)}, '')"


def first(*columns: str, default: str = "") -> str:
    return f"coalesce({', '.join(filled(c) for c in columns)}, {q(default)})"


def number(x: str) -> str:
    return f"(CASE WHEN regexp_matches({strip(x)}, '{NUM}') THEN TRY_CAST({strip(x)} AS DOUBLE) END)"


def share(x: str) -> str:
    """x is text."""
    n = f"coalesce({number(f'replace({clean(x)}, {chr(39)}%{chr(39)}, {chr(39)}{chr(39)})')}, 0)"
    n = f"({n} / CASE WHEN contains({clean(x)}, '%') THEN 100.0e0 ELSE 1.0e0 END)"
    return f"greatest(0.0e0, CASE WHEN {n} > 1 THEN least(1.0e0, {n} / 100.0e0) ELSE {n} END)"


def number_share(x: str) -> str:
    return f"coalesce(greatest(0.0e0, CASE WHEN {x} > 1 THEN least(1.0e0, {x} / 100.0e0) ELSE {x} END), 0.0e0)"


def rnd(x: str, digits: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(20,10)), {digits}) AS DOUBLE)"


def fixed(x: str, digits: int) -> str:
    return f"CAST(CAST(round(CAST({x} AS DECIMAL(20,10)), {digits}) AS DECIMAL(16,{digits})) AS VARCHAR)"


def exact_sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(8,6))) AS DOUBLE)"


def any_of(x: str, items: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in items) + ")"


def all_of(x: str, items: Sequence[str]) -> str:
    return "(" + " AND ".join(f"contains({x}, {q(w)})" for w in items) + ")"


def mapped(x: str, scores: Mapping[str, float], default: float) -> str:
    cases = " ".join(f"WHEN {q(w)} THEN {score}e0" for w, score in scores.items())
    return f"(CASE {x} {cases} ELSE {default}e0 END)"


def hashed(prefix: str, x: str, digits: int = 12) -> str:
    return f"({q(prefix + '_')} || substr(sha1({x}), 1, {digits}))"


def node_id(prefix: str, x: str) -> str:
    name = rf"trim(regexp_replace({clean(x)}, '[^0-9A-Za-z\x{{4E00}}-\x{{9FFF}}_.-]+', '_', 'g'), '_')"
    return f"(CASE WHEN {clean(x)} = '' THEN '' ELSE {q(prefix + ':')} || {name} END)"


def refs(x: str, pattern: str) -> str:
    parts = f"list_transform(regexp_split_to_array({clean(x)}, '{pattern}'), lambda r: {strip('r')})"
    return f"list_filter({parts}, lambda r: r <> '')"


CLAUSE_BREAK = r"[;；\n\r|]+"
REPORT_BREAK = r"[；;]|\n+"


def flag(x: str) -> str:
    return f"coalesce(lower({strip(f'CAST({x} AS VARCHAR)')}) IN {in_list(rules.FLAG_WORDS)}, false)"


def demand(x: str) -> str:
    low = f"lower({clean(x)})"
    return f"({low} IN {in_list(rules.DEMAND_WORDS)} OR {any_of(low, rules.DEMAND_PARTS)})"


def severity(x: str) -> str:
    text = clean(x)
    return (
        f"(CASE WHEN {any_of(text, rules.HIGH_SEVERITY_WORDS)} THEN 3 "
        f"WHEN {any_of(text, rules.MEDIUM_SEVERITY_WORDS)} THEN 2 WHEN {text} <> '' THEN 1 ELSE 0 END)"
    )


def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def text_clean(x: str) -> str:
    low = f"lower({clean(x)})"
    short = rf"regexp_replace({low}, '\p{{Nd}}+(?:\.\p{{Nd}}+)+', '', 'g')"
    return rf"regexp_replace({short}, '[^\x{{4e00}}-\x{{9fff}}A-Za-z0-9]+', '', 'g')"


def gram_list(c: str) -> str:
    """c is a cleaned text."""
    letters = f"string_split({c}, '')"
    pairs = f"list_transform(range(1, len({letters})), lambda i: letters[i] || letters[i + 1])"
    pairs = f"(SELECT {pairs.replace('len(' + letters + ')', 'len(letters)')} FROM (SELECT {letters} AS letters))"
    return f"(CASE WHEN {c} IN {EMPTY} THEN CAST([] AS VARCHAR[]) WHEN length({c}) <= 2 THEN [{c}] ELSE list_distinct({pairs}) END)"


def term_list(x: str) -> str:
    return rf"list_distinct(regexp_extract_all(lower({clean(x)}), '[\x{{4e00}}-\x{{9fff}}A-Za-z0-9]{{2,}}', 0))"


def jaccard(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return (
        f"(CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0e0 "
        f"ELSE CAST({both} AS DOUBLE) / (len({a}) + len({b}) - {both}) END)"
    )


def alike(a: str, b: str) -> str:
    """Similarity of two texts whose parts are in columns a_clean, a_grams, a_terms."""
    mixed = f"0.75e0 * {jaccard(a + '_grams', b + '_grams')} + 0.25e0 * {jaccard(a + '_terms', b + '_terms')}"
    return (
        f"(CASE WHEN {a}_clean = '' OR {b}_clean = '' THEN 0.0e0 "
        f"WHEN contains({a}_clean, {b}_clean) OR contains({b}_clean, {a}_clean) THEN 0.95e0 "
        f"ELSE {rnd(mixed, 4)} END)"
    )


def parts_of(name: str, x: str) -> str:
    """Select items for ``alike``; x is a column."""
    return f"{text_clean(x)} AS {name}_clean, {term_list(x)} AS {name}_terms"


def oracle(name: str, sql: str, *views: str, **ctes: str) -> None:
    """Register; ``views`` and ``ctes`` become WITH parts in that order."""
    parts = [f'{n} AS ({sql_of(n)})' for n in views] + [f"{n} AS ({text})" for n, text in ctes.items()]
    ORACLES[name] = (f"WITH {', '.join(parts)} " if parts else "") + sql


# ---------------------------------------------------------- sources and sinks

for _name in ("scan_csv", "scan_jsonl"):
    oracle(_name, "SELECT * FROM documents")
oracle("sink_jsonl", "SELECT * FROM linked_issues", "linked_issues")
oracle(
    "sink_csv",  # where an empty text and none are the same
    "SELECT * REPLACE (nullif(kg_standard_id, '') AS kg_standard_id, nullif(kg_clause_id, '') AS kg_clause_id, "
    "nullif(kg_relation_type, '') AS kg_relation_type, nullif(predicted_category, '') AS predicted_category) FROM linked_issues",
    "linked_issues",
)

STANDARD_OF = f"""
    SELECT s.standard_id AS sid, {clean('s.standard_name')} AS standard_name, {clean('s.standard_no')} AS standard_no,
      {clean('s.standard_status')} AS standard_status, {clean('s.domain')} AS domain,
      {clean('s.risk_level')} AS risk_level, {clean('s.equipment_type')} AS standard_equipment
    FROM standards s QUALIFY row_number() OVER (PARTITION BY standard_id ORDER BY pos DESC) = 1
"""
JOINED_CLAUSES = """
    SELECT c.*, coalesce(standard_name, '') AS standard_name, coalesce(standard_no, '') AS standard_no,
      coalesce(standard_status, '') AS standard_status, coalesce(domain, '') AS domain,
      coalesce(risk_level, '') AS risk_level, coalesce(standard_equipment, '') AS standard_equipment
    FROM clauses c LEFT JOIN standard_of ON standard_id = sid
"""
REFERENCE = "concat_ws(' ', nullif(standard_no, ''), nullif(standard_name, ''), nullif(standard_status, ''))"
POINTS = f"""
    SELECT coalesce({filled('clause_id')}, concat_ws('_', standard_id, clause_no)) AS point_id,
      pos AS point_pos,
      concat_ws(' ', {filled('clause_no')}, {filled(f"substr({clean('clause_text')}, 1, 80)")}) AS label,
      {clean('clause_text')} AS full_text,
      coalesce({filled('equipment_type')}, standard_equipment) AS equipment,
      {clean('stage')} AS stage, risk_level AS severity, {clean('problem_category')} AS project,
      [coalesce(nullif({REFERENCE}, ''), standard_id)] AS standards,
      CASE WHEN {clean('clause_text')} = '' THEN CAST([] AS VARCHAR[]) ELSE [{clean('clause_text')}] END AS requirements,
      standard_id, standard_name, standard_no, standard_status, domain, risk_level,
      {clean('clause_id')} AS clause_id, {clean('clause_no')} AS clause_no, {clean('clause_text')} AS clause_text,
      list_filter(list_transform(keywords, lambda w: {clean('w')}), lambda w: w <> '') AS keywords,
      {clean('problem_category')} AS problem_category
    FROM joined_clauses
"""
LIBRARY = {"standard_of": STANDARD_OF, "joined_clauses": JOINED_CLAUSES, "points": POINTS}
FLAT = """* REPLACE (array_to_string(standards, '|') AS standards, array_to_string(requirements, '|') AS requirements"""

oracle(
    "kg_points_from_library",
    f"SELECT {FLAT}, array_to_string(keywords, '|') AS keywords) FROM points",
    "standards", "clauses", **LIBRARY,
)
oracle(
    "join_clause_standard",
    """SELECT clause_id, standard_id, clause_no, standard_name, standard_no, standard_status, domain, risk_level,
       standard_equipment FROM joined_clauses""",
    "standards", "clauses", standard_of=STANDARD_OF, joined_clauses=JOINED_CLAUSES,
)


def stage_case(x: str) -> str:
    text = clean(x)
    exact = " ".join(f"WHEN {text} = {q(a)} THEN {q(s)}" for a, s in rules.STAGE_ALIASES.items())
    inside = " ".join(f"WHEN contains({text}, {q(a)}) THEN {q(s)}" for a, s in rules.STAGE_ALIASES.items())
    return f"(CASE {exact} {inside} ELSE {text} END)"


LINKED_ENDS = f"""
    SELECT e.point_id, e.other_id, e.edge_type, e.link_pos,
      coalesce({filled('o.label')}, '') AS other_label,
      coalesce({filled('o.full_reference')}, {filled('o.label')}, '') AS other_reference,
      coalesce({filled('o.full_text')}, {filled('o.label')}, '') AS other_text
    FROM (
      SELECT CASE edge_type WHEN 'HAS_POINT' THEN target ELSE source END AS point_id,
        CASE edge_type WHEN 'HAS_POINT' THEN source ELSE target END AS other_id, edge_type, pos AS link_pos
      FROM graph_links WHERE source <> '' AND target <> ''
    ) e
    JOIN (SELECT id FROM graph_nodes WHERE node_type = '监督要点') p ON e.point_id = p.id
    LEFT JOIN graph_nodes o ON e.other_id = o.id
"""
oracle(
    "join_graph_links",
    """SELECT point_id, edge_type, other_reference, count(*) AS links, min(link_pos) AS first_pos,
       max(link_pos) AS last_pos FROM linked_ends GROUP BY 1, 2, 3""",
    "graph_nodes", "graph_links", linked_ends=LINKED_ENDS,
)
oracle(
    "kg_points_from_graph",
    f"""
    SELECT n.id AS point_id, n.pos AS point_pos, {clean('n.label')} AS label,
      {first('n.full_text', 'n.label')} AS full_text, {clean('n.equipment')} AS equipment,
      {stage_case('n.stage')} AS stage, coalesce(severity, '') AS severity, coalesce(project, '') AS project,
      array_to_string(list_filter(
        CASE WHEN list_contains(coalesce(governed, []), {clean('n.reference')}) THEN governed
        ELSE list_append(coalesce(governed, []), {clean('n.reference')}) END, lambda x: x <> ''), '|') AS standards,
      array_to_string(list_filter(coalesce(required, []), lambda x: x <> ''), '|') AS requirements
    FROM graph_nodes n
    LEFT JOIN (
      SELECT point_id,
        arg_max(other_label, link_pos) FILTER (WHERE edge_type = 'HAS_SEVERITY') AS severity,
        arg_min(other_label, link_pos) FILTER (WHERE edge_type = 'HAS_POINT') AS project
      FROM linked_ends GROUP BY 1) a ON a.point_id = n.id
    LEFT JOIN (
      SELECT point_id, list(other_reference ORDER BY p, other_reference) AS governed FROM (
        SELECT point_id, other_reference, min(link_pos) AS p FROM linked_ends
        WHERE edge_type = 'GOVERNED_BY' GROUP BY 1, 2) GROUP BY 1) g ON g.point_id = n.id
    LEFT JOIN (
      SELECT point_id, list(other_text ORDER BY p, other_text) AS required FROM (
        SELECT point_id, other_text, min(link_pos) AS p FROM linked_ends
        WHERE edge_type = 'HAS_REQUIREMENT' GROUP BY 1, 2) GROUP BY 1) r ON r.point_id = n.id
    WHERE n.node_type = '监督要点'
    """,
    "graph_nodes", "graph_links", linked_ends=LINKED_ENDS,
)
LIBRARY_NAMES = f"""
    SELECT DISTINCT name FROM (
      SELECT {clean('equipment_type')} AS name FROM standards UNION ALL
      SELECT {clean('equipment_type')} FROM clauses) WHERE name <> ''
"""
oracle(
    "kg_supported_equipment",
    f"""SELECT name, 'library' AS form FROM names UNION ALL
        SELECT DISTINCT {clean('label')}, 'graph' FROM graph_nodes WHERE node_type = '设备类型'""",
    "standards", "clauses", "graph_nodes", names=LIBRARY_NAMES,
)

# ------------------------------------------ projection, filtering and cleaning

RENAMED = ", ".join(f'"{old}" AS {new}' for old, new in rules.RAW_COLUMNS.items())
oracle("issue_rename", f"SELECT row_pos, {RENAMED} FROM raw_issues", "raw_issues")
UNKNOWN_LIST = in_list([*rules.EMPTY_WORDS, rules.UNKNOWN])


def one_line(x: str) -> str:
    line = strip(f"regexp_replace(coalesce({x}, ''), '{RUN}', ' ', 'g')")
    return f"(CASE WHEN lower({line}) IN {UNKNOWN_LIST} THEN '' ELSE {line} END)"


def day(x: str) -> str:
    forms = [
        "%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%Y%m%d", "%m/%d/%Y", "%Y-%m-%d %H:%M:%S",
    ]
    tries = ", ".join(f"try_strptime({one_line(x)}, '{form}')" for form in forms)
    return f"coalesce(strftime(coalesce({tries}), '%Y-%m-%d'), {one_line(x)})"


TEXTS = [(old, new) for old, new in rules.RAW_COLUMNS.items() if new not in rules.DATE_COLUMNS]
oracle(
    "issue_clean_text",
    "SELECT row_pos, " + ", ".join(f"""{one_line(f'"{old}"')} AS {new}""" for old, new in TEXTS) + " FROM raw_issues",
    "raw_issues",
)
oracle(
    "issue_clean_date",
    f"""SELECT o_orderkey, CASE WHEN k IN (9, 10, 11, 12, 13, 14, 16, 17, 18, 19, 20, 21, 23, 24) THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN k = 15 THEN strftime(o_orderdate, '%Y-%m-01') WHEN k = 22 THEN strftime(o_orderdate, '%Y年%-m月')
        ELSE {day('event_time')} END AS event_time FROM spelled""",
    spelled="""
      SELECT o_orderkey, o_orderdate, o_orderkey % 25 AS k, CASE o_orderkey % 25
        WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%-m/%-d')
        WHEN 2 THEN strftime(o_orderdate, '%Y.%m.%d') WHEN 3 THEN strftime(o_orderdate, '%Y%m%d')
        WHEN 4 THEN strftime(o_orderdate, '%-m/%-d/%Y') WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
        WHEN 6 THEN ' week  of ' || strftime(o_orderdate, '%Y') WHEN 7 THEN 'NaN' END AS event_time
      FROM orders""",
)
CLEANED = "SELECT row_pos, " + ", ".join(
    f"""{day(f'"{old}"') if new in rules.DATE_COLUMNS else one_line(f'"{old}"')} AS {new}"""
    for old, new in rules.RAW_COLUMNS.items()
) + " FROM raw_issues"
VALID = f"SELECT * FROM cleaned WHERE text <> '' AND label IN {in_list(rules.LEVELS)}"
KEYS = ", ".join(rules.REPEAT_KEYS)
DEDUPED = f"SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY {KEYS} ORDER BY row_pos) = 1"
PREPARED = {"cleaned": CLEANED, "valid": VALID, "deduped": DEDUPED}
oracle("issue_filter_valid", "SELECT row_pos, text, label FROM valid", "raw_issues", cleaned=CLEANED, valid=VALID)
oracle("issue_dedupe_first", f"SELECT row_pos, {KEYS} FROM deduped", "raw_issues", **PREPARED)
oracle(
    "issue_assign_id",
    """SELECT printf('real_v1_%06d', row_number() OVER (ORDER BY row_pos)) AS sample_id, row_pos, text, label,
       event_time, '未知' AS source_unit, 'pytest_processed_1_real' AS data_source FROM deduped""",
    "raw_issues", **PREPARED,
)
oracle(
    "issue_fill_ids",
    """SELECT row_pos, CASE WHEN row_pos % 3 = 2 THEN sample_id ELSE printf('pred_%06d', n) END AS sample_id
       FROM (SELECT row_pos, sample_id,
         CAST(sum(CASE WHEN row_pos % 3 < 2 THEN 1 ELSE 0 END) OVER (ORDER BY row_pos) AS BIGINT) AS n FROM doc_issues)""",
    "doc_issues",
)

_LINKED = [
    "problem_id", "problem_text", "device_type", "major", "organization", "region", "predicted_category",
    "predicted_severity", "category_confidence", "severity_confidence", "need_review", "kg_standard_id",
    "kg_standard_name", "kg_standard_refs", "standard_no", "standard_status", "kg_clause_id", "kg_clause_title",
    "clause_no", "kg_relation_type", "kg_relation_confidence", "revision_demand", "revision_need_type",
    "standard_revision_priority_score",
]


def field(name: str) -> str:
    found = [c for c in rules.FIELD_ALIASES[name] if c in _LINKED]
    return first(*[txt(c) for c in found]) if found else "''"


oracle(
    "alias_resolve",
    "SELECT " + ", ".join(f"{field(name)} AS {name}" for name in rules.FIELD_ALIASES) + " FROM linked_issues",
    "linked_issues",
)
oracle(
    "alias_missing_fields",
    " UNION ALL ".join(
        f"SELECT {q(name)} AS field, {q('true' if name in ('region', 'kg_clause_title') else 'false')} AS missing, "
        f"count(*) FILTER (WHERE {field(name) if name not in ('region', 'kg_clause_title') else chr(39) * 2} = '') AS empty_rows "
        "FROM linked_issues"
        for name in rules.REQUIRED_FIELDS
    ),
    "linked_issues",
)


def normalised(x: str, lower: bool = False, marks: bool = True) -> str:
    out = strip(f"coalesce({x}, '')")
    if lower:
        out = f"lower({out})"
    if marks:
        out = f"translate({out}, {q(rules.FULL_WIDTH_MARKS)}, {q(rules.ASCII_MARKS)})"
    for a, b in words.TERMS.items():
        out = f"replace({out}, {q(a)}, {q(b)})"
    return out


oracle(
    "text_normalise",
    f"""SELECT doc_id, {normalised('t')} AS plain, {normalised('t', lower=True, marks=False)} AS lowered,
        {normalised(normalised('t'))} AS twice
        FROM (SELECT doc_id, '　（a）；' || text || '。 ' AS t FROM documents)""",
)
_twice = {name: normalised(normalised(name)) for name in ("text", "device_type", "specialty", "rule_name")}
MODEL_INPUT = (
    "SELECT row_pos, label, concat_ws('；', "
    + ", ".join(
        f"CASE WHEN {_twice[n]} <> '' THEN {q(words.FIELD_NAMES.get(n, n) + ': ')} || {_twice[n]} END"
        for n in ("device_type", "specialty", "rule_name")
    )
    + f", {q(words.FIELD_NAMES['text'] + ': ')} || {_twice['text']}) AS model_input FROM doc_issues"
)
oracle("model_input_build", "SELECT row_pos, model_input FROM model_input", "doc_issues", model_input=MODEL_INPUT)


def category_case() -> str:
    have = {"text", "problem_reason", "problem_stage", "supervision_stage", "rule_name", "checkpoint_text", "specialty"}
    value = {n: strip(f"coalesce({n}, '')") for n in have}
    joined = ", ".join(f"nullif({value[n]}, '')" for n in rules.CATEGORY_TEXT_FIELDS)
    cases = []
    for rule in words.CATEGORY_RULES:
        tests = []
        for test in rule["tests"]:
            parts = []
            if "field" in test:
                parts.append(f"{value[test['field']]} IN {in_list(test['values'])}")
            if "words" in test:
                parts.append(any_of("joined", test["words"]))
            tests.append("(" + " AND ".join(parts) + ")")
        cases.append(f"WHEN {' OR '.join(tests)} THEN {q(rule['category'])}")
    case = f"CASE {' '.join(cases)} ELSE {q(words.CATEGORY_DEFAULT)} END"
    return f"SELECT *, {case} AS category FROM (SELECT *, concat_ws(' ', {joined}) AS joined FROM doc_issues)"


CATEGORISED = category_case()
oracle("category_rules", "SELECT row_pos, category FROM categorised", "doc_issues", categorised=CATEGORISED)
_tag = f"CASE WHEN row_pos % 2 = 0 THEN 'docs|{rules.CATEGORY_TAG}' ELSE '{rules.CATEGORY_TAG}' END AS data_source"
oracle(
    "category_dataset",
    f"SELECT row_pos, label AS problem_level, category AS label, {_tag} FROM categorised",
    "doc_issues", categorised=CATEGORISED,
)

PREDICTIONS = """
    SELECT order_no, problem_id AS sample_id, problem_text AS text, device_type, predicted_severity AS predicted_label,
      CASE WHEN severity_confidence < 0.6e0 THEN NULL ELSE severity_confidence END AS level_confidence,
      CASE WHEN severity_confidence < 0.6e0 THEN 'n/a' ELSE CAST(severity_confidence AS VARCHAR) END AS confidence,
      predicted_severity AS pred_level,
      predicted_category AS pred_category, category_confidence, repeat_count, need_review AS need_manual_review
    FROM linked_issues
"""
oracle(
    "primary_role_columns",
    """SELECT sample_id, pred_level, level_confidence, predicted_label AS as_category,
       level_confidence AS as_confidence FROM predictions""",
    "linked_issues", predictions=PREDICTIONS,
)
oracle("stage_alias", f"SELECT row_pos, {stage_case('supervision_stage')} AS stage FROM doc_issues", "doc_issues")

# ------------------------------------------------------------- decision rules

PRIORITY = rules.merged(rules.PRIORITY_RULES, words.PRIORITY_OVERRIDES)


def with_flag(threshold: float = rules.REVIEW_THRESHOLD) -> str:
    return (
        f"({flag('need_manual_review')} OR coalesce(level_confidence, 1) < {threshold}e0 "
        f"OR coalesce(category_confidence, 1) < {threshold}e0)"
    )


def _device() -> str:
    groups = " ".join(
        f"WHEN {any_of('device', g['keywords'])} THEN {g['score']}e0" for g in PRIORITY["device_scores"]
    )
    return f"(CASE {groups} ELSE {PRIORITY['device_default_score']}e0 END)"


_w = PRIORITY["weights"]
PARTED = f"""
    SELECT *, {mapped('level', PRIORITY['level_scores'], PRIORITY['level_scores'][rules.UNKNOWN])} AS level_score,
      {_device()} AS device_score,
      {mapped('category', PRIORITY['category_scores'], PRIORITY['category_scores'][rules.UNKNOWN])} AS category_score,
      CASE WHEN repeat_count >= 3 THEN 1.0e0 WHEN repeat_count >= 1 THEN 0.7e0 ELSE 0.4e0 END AS repeat_score,
      (coalesce(level_confidence, 0.5e0) + coalesce(category_confidence, 0.5e0)) / 2 AS sure
    FROM (SELECT *, {first('pred_level', default=rules.UNKNOWN)} AS level,
      {first('pred_category', default=rules.UNKNOWN)} AS category,
      {first('device_type', default=rules.DEVICE_DEFAULT)} AS device, {with_flag()} AS need_review FROM predictions)
"""
_total = " + ".join(
    f"{_w[n]}e0 * {'sure' if n == 'confidence_score' else n}"
    for n in ("level_score", "device_score", "category_score", "repeat_score", "confidence_score")
)
PRIORITISED = f"""
    SELECT *, CASE WHEN priority_score >= 0.8e0 THEN '高' WHEN priority_score >= 0.6e0 THEN '中' ELSE '低' END AS priority_label,
      {rnd('sure', 4)} AS confidence_score
    FROM (SELECT *, {rnd('0.0e0 + ' + _total, 4)} AS priority_score FROM parted)
"""
REASON = (
    "'问题等级为' || level || '，涉及设备为' || device || '，问题类别为' || category || "
    "'，综合历史重复情况和模型置信度后，建议按' || priority_label || '优先级处理。' AS priority_reason"
)
DECISION = {"predictions": PREDICTIONS, "parted": PARTED, "prioritised": PRIORITISED}


def advice(part: str, category: str) -> str:
    texts = rules.SUGGESTION_RULES["category_rules"]
    cases = " ".join(f"WHEN {q(name)} THEN {q(t[part])}" for name, t in texts.items())
    return f"(CASE {category} {cases} ELSE {q(texts[rules.UNKNOWN][part])} END)"


def advice_items(category: str, label: str, flagged: str) -> str:
    extra = rules.SUGGESTION_RULES
    return (
        f"{advice('suggestion', category)} AS suggestion, {advice('basis', category)} AS suggestion_basis, "
        f"concat_ws(' ', {advice('action', category)}, "
        f"CASE WHEN {label} = '高' THEN {q(extra['high_priority_action'])} END, "
        f"CASE WHEN {flagged} THEN {q(extra['need_review_action'])} END) AS recommended_action"
    )


oracle(
    "review_flag", f"SELECT sample_id, {txt(with_flag())} AS need_review FROM predictions",
    "linked_issues", predictions=PREDICTIONS,
)
_PRIORITY_ITEMS = ", ".join(REASON if n == "priority_reason" else n for n in PRIORITY_COLUMNS)
oracle("priority_score", f"SELECT sample_id, {_PRIORITY_ITEMS} FROM prioritised", "linked_issues", **DECISION)
oracle(
    "suggestion_rules",
    "SELECT sample_id, "
    + advice_items(
        first("pred_category", default=rules.UNKNOWN),
        "CASE WHEN repeat_count > 3 THEN '高' ELSE '低' END",
        flag("need_manual_review"),
    )
    + " FROM predictions",
    "linked_issues", predictions=PREDICTIONS,
)
DECIDED = f"""
    SELECT *, {REASON}, {advice_items('category', 'priority_label', '(need_review OR ' + flag('need_manual_review') + ')')}
    FROM prioritised
"""
DECISION_ALL = {**DECISION, "decided": DECIDED}
oracle(
    "decision_enrich",
    "SELECT sample_id, pred_level, pred_category, level_confidence, category_confidence, "
    f"{txt('need_review')} AS need_review, {', '.join(PRIORITY_COLUMNS)}, suggestion, suggestion_basis, "
    "recommended_action FROM decided",
    "linked_issues", **DECISION_ALL,
)
_REVIEW_ITEMS = {
    "sample_id": "sample_id",
    "need_manual_review": txt(flag("need_manual_review")),
    "need_review": txt("need_review"),
    "confidence": "level_confidence",
    "predicted_label": "predicted_label",
    "pred_level": "pred_level",
    "pred_category": "pred_category",
    "level_confidence": "level_confidence",
    "category_confidence": "category_confidence",
    "priority_score": "priority_score",
    "priority_label": "priority_label",
    "priority_reason": "priority_reason",
    "suggestion": "suggestion",
    "suggestion_basis": "suggestion_basis",
    "recommended_action": "recommended_action",
    "review_status": "'pending'",
    "reviewed_label": "''",
    "text": "text",
    "device_type": "device_type",
}
_shown = {
    rules.REVIEW_COLUMNS[n]: "coalesce(CASE WHEN repeat_count = 1 THEN 'own' END, suggestion_basis)"
    if n == "suggestion_basis"
    else x
    for n, x in _REVIEW_ITEMS.items()
}
oracle(
    "review_rename_columns",
    "SELECT " + ", ".join(f'{x} AS "{n}"' for n, x in _shown.items()) + " FROM decided",
    "linked_issues", **DECISION_ALL,
)
_QUEUE = "SELECT " + ", ".join(f"{x} AS {n}" for n, x in _REVIEW_ITEMS.items()) + " FROM decided"
oracle("review_queue", _QUEUE, "linked_issues", **DECISION_ALL)
oracle("review_subset", _QUEUE + " WHERE need_review", "linked_issues", **DECISION_ALL)
oracle(
    "priority_top10",
    f"""SELECT sample_id, pred_level, pred_category, priority_score, priority_label, {txt('need_review')} AS need_review,
        text FROM decided ORDER BY decided.priority_score DESC, sample_id LIMIT 10""",
    "linked_issues", **DECISION_ALL,
)
_n = rules.SUMMARY_NAMES
_summary = [
    (_n["total_rows"], "true"),
    (_n["need_manual_review_true"], flag("need_manual_review")),
    (_n["need_manual_review_false"], "NOT " + flag("need_manual_review")),
    (_n["need_review_true"], "need_review"),
    (_n["review_status_pending"], "repeat_count % 2 = 0"),
    *[(label + _n["priority_"], f"priority_label = {q(label)}") for label in rules.PRIORITY_LABELS],
    (_n["high_priority_and_need_review"], "priority_label = '高' AND need_review"),
    (_n["revision_need_true"], "repeat_count = 3"),
]
oracle(
    "review_summary",
    " UNION ALL ".join(
        f"SELECT {q(item)} AS item, count(*) FILTER (WHERE {test}) AS value FROM decided" for item, test in _summary
    )
    + f""" UNION ALL SELECT {q(_n['revision'] + '标准缺失')}, count(*) FROM decided WHERE repeat_count = 3
        UNION ALL SELECT {q(_n['kg_match'])} || CASE WHEN repeat_count > 4 THEN 'low_score' ELSE 'matched' END, count(*)
          FROM decided GROUP BY 1
        UNION ALL SELECT {q(_n['category'])} || pred_category, count(*) FROM decided WHERE pred_category <> '' GROUP BY 1
        UNION ALL SELECT {q(_n['level'])} || pred_level, count(*) FROM decided WHERE pred_level <> '' GROUP BY 1""",
    "linked_issues", **DECISION_ALL,
)
_fill_columns = [
    "pred_level", "pred_category", "level_confidence", "category_confidence", "priority_score",
    "priority_label", "priority_reason", "suggestion", "suggestion_basis", "recommended_action",
]
oracle(
    "field_fill_rate",
    " UNION ALL ".join(
        f"SELECT 'fill' AS kind, {q(c)} AS column, '' AS value, count(*) FILTER (WHERE {strip(f'coalesce({txt(c)}, {chr(39)}{chr(39)})')} <> '') AS rows, "
        + rnd(f"count(*) FILTER (WHERE {strip(f'coalesce({txt(c)}, {chr(39)}{chr(39)})')} <> '') / count(*)", 4)
        + " AS rate FROM decided"
        for c in _fill_columns
    ).replace("AS column", 'AS "column"')
    + "".join(
        f" UNION ALL SELECT 'value', {q(c)}, {c}, count(*), CAST(NULL AS DOUBLE) FROM decided WHERE {strip(c)} <> '' GROUP BY {c}"
        for c in ("pred_category", "priority_label", "pred_level")
    ),
    "linked_issues", **DECISION_ALL,
)

# ---------------------------------------------------------------------- joins


def equipment_of(fields: Sequence[str], table: str = "doc_issues") -> str:
    """(row_pos, equipment) with '' when none; needs a CTE ``names``."""
    stacked = " UNION ALL ".join(
        f"SELECT row_pos, {i} AS field_no, {clean(f)} AS t FROM {table}" for i, f in enumerate(fields)
    )
    return f"""
      SELECT i.row_pos, coalesce(h.name, '') AS equipment FROM {table} i LEFT JOIN (
        SELECT row_pos, name FROM ({stacked}) x JOIN names ON contains(x.t, names.name)
        QUALIFY row_number() OVER (PARTITION BY row_pos ORDER BY field_no, length(name) DESC, name) = 1
      ) h ON h.row_pos = i.row_pos
    """


LONG_NAMES = f"""
    SELECT name FROM library_names UNION
    SELECT unnest(regexp_extract_all(text, '[A-Za-z]{{9,}}', 0)) FROM benchmark
"""
oracle(
    "join_equipment_contains",
    "SELECT row_pos, equipment FROM found",
    "doc_issues", "standards", "clauses",
    library_names=LIBRARY_NAMES, names=LONG_NAMES, found=equipment_of(["device_type", "rule_name", "text"]),
)
oracle(
    "join_candidates",
    "SELECT f.row_pos, f.equipment, p.point_id FROM found f JOIN points p ON f.equipment = p.equipment WHERE f.equipment <> ''",
    "doc_issues", "standards", "clauses", **LIBRARY,
    names=LIBRARY_NAMES, found=equipment_of(["device_type", "rule_name"]),
)

REVIEWED = """
    SELECT sample_id, reviewed_label FROM reviews
    WHERE lower(review_status) IN ('accepted', 'corrected') AND trim(reviewed_label) <> ''
    QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY review_no DESC) = 1
"""
oracle(
    "join_feedback",
    "SELECT sample_id, label, reviewed_label FROM doc_issues LEFT JOIN reviewed USING (sample_id)",
    "doc_issues", "reviews", reviewed=REVIEWED,
)
oracle(
    "join_category_prediction",
    """SELECT sample_id, predicted_label AS pred_category, good_logit / 10 AS category_confidence,
       length(predicted_label) AS category_label_id
       FROM doc_issues LEFT JOIN guesses ON row_pos = doc_id""",
    "doc_issues", "guesses",
)
oracle(
    "join_feature_vector",
    """SELECT sample_id, text AS problem_text, coalesce(device_type, '') AS device_type, coalesce(specialty, '') AS supervision_major,
       coalesce(supervision_stage, '') AS supervision_stage, coalesce(problem_stage, '') AS problem_phase, '' AS pred_level,
       pred_category, priority_score AS level_confidence, '' AS category_confidence,
       CASE WHEN toxic = 1 THEN 'true' WHEN toxic = 0 THEN 'false' END AS need_review, vec_id, """
    + ", ".join(f"embedding[{i + 1}] AS cls_{i}" for i in range(64))
    + " FROM doc_issues JOIN embeddings ON row_pos % (SELECT count(*) FROM embeddings) = vec_id",
    "doc_issues",
)

# ----------------------------------------------- text similarity and matching

oracle(
    "token_sets",
    f"""SELECT doc_id, clean, array_to_string(list_sort({gram_list('clean')}), '|') AS grams,
        array_to_string(list_sort({term_list('text')}), '|') AS terms
        FROM (SELECT doc_id, text, {text_clean('text')} AS clean FROM documents)""",
)
oracle(
    "text_similarity",
    f"""SELECT * FROM (SELECT doc_id, item_id, {alike('a', 'b')} AS similarity FROM l JOIN r ON l.source = r.source)
        WHERE similarity > 0 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY similarity DESC, item_id) <= 3""",
    l=f"SELECT *, {gram_list('a_clean')} AS a_grams FROM (SELECT doc_id, source, {parts_of('a', 'text')} FROM documents)",
    r=f"""SELECT *, {gram_list('b_clean')} AS b_grams FROM (
      SELECT item_id, 'src' || (item_id % 20) AS source, {parts_of('b', 'text')} FROM benchmark)""",
)
oracle(
    "keyword_overlap",
    f"""SELECT * FROM (SELECT doc_id, pos, hits,
          {rnd('CASE WHEN len(keywords) > 0 THEN hits / len(keywords) ELSE 0 END', 4)} AS share
        FROM (SELECT doc_id, pos, keywords,
          len(list_filter(keywords, lambda w: w <> '' AND contains(text, w))) AS hits
          FROM documents JOIN clauses ON source = equipment_type WHERE equipment_type <> ''))
        WHERE hits > 0
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY share DESC, hits DESC, pos) <= 3""",
    "clauses",
)

_SEARCH = ", ".join(
    f"nullif({x}, '')"
    for x in (
        "label", "full_text", "project", "stage", "severity", "standard_name", "standard_no", "standard_status",
        "clause_no", "clause_text", "array_to_string(keywords, ' ')", "problem_category",
        "array_to_string(standards, ' ')", "array_to_string(requirements, ' ')",
    )
)
POINT_TEXTS = f"""
    SELECT *, concat_ws(' ', {_SEARCH}) AS t_all,
      full_text || ' ' || array_to_string(requirements, ' ') AS t_own,
      array_to_string(standards, ' ') AS t_standards, problem_category AS t_category FROM points
"""
_POINT_PARTS = {"pa": "t_all", "po": "t_own", "ps": "t_standards", "pc": "t_category"}
_ISSUE_PARTS = {"it": "issue_text", "ic": "checkpoint", "io": "opinion", "ir": "rule", "ig": "category"}


def parted(source: str, parts: Mapping[str, str]) -> str:
    inner = ", ".join(parts_of(n, x) for n, x in parts.items())
    grams = ", ".join(f"{gram_list(n + '_clean')} AS {n}_grams" for n in parts)
    return f"SELECT *, {grams} FROM (SELECT *, {inner} FROM {source})"


ISSUE_TEXTS = f"""
    SELECT d.row_pos, f.equipment, {clean('d.text')} AS issue_text, {clean('d.checkpoint_text')} AS checkpoint,
      concat_ws(' ', {filled('d.supervision_opinion')}, {filled('d.actual_fix')}) AS opinion,
      {clean('d.rule_name')} AS rule, {clean('d.pred_category')} AS category,
      {stage_case('d.supervision_stage')} AS supervised, {stage_case('d.problem_stage')} AS problem_staged,
      {clean('d.label')} AS level
    FROM doc_issues d JOIN found f ON d.row_pos = f.row_pos
"""
_stage = "(CASE WHEN supervised <> '' THEN supervised ELSE problem_staged END)"
PAIRS = f"""
    SELECT row_pos, point_id, point_pos, {alike('ic', 'po')} AS checkpoint_score, {alike('it', 'pa')} AS issue_score,
      CASE WHEN len(keywords) > 0
        THEN len(list_filter(keywords, lambda w: contains(issue_text, w))) / len(keywords) ELSE 0.0e0 END AS keyword_score,
      len(list_filter(keywords, lambda w: contains(issue_text, w))) AS keyword_hits,
      CASE WHEN category <> '' AND category = problem_category THEN 1.0e0 ELSE {alike('ig', 'pc')} END AS category_score,
      {alike('io', 'pa')} AS opinion_score, {alike('ir', 'ps')} AS rule_score,
      CASE WHEN {_stage} <> '' AND {_stage} = p.stage THEN 1.0e0 ELSE 0.0e0 END AS stage_score,
      CASE WHEN level <> '' AND level = p.severity THEN 1.0e0 ELSE 0.0e0 END AS severity_score,
      (ic_clean <> '' AND contains(po_clean, ic_clean)) AS hit, clause_id
    FROM issue_parts i JOIN point_parts p ON i.equipment = p.equipment WHERE i.equipment <> ''
"""
_m = rules.MATCH_RULES
_mw = {
    "checkpoint": "checkpoint_score", "issue": "issue_score", "keywords": "keyword_score",
    "category": "category_score", "opinion": "opinion_score", "rule": "rule_score", "stage": "stage_score",
    "severity": "severity_score",
}
_score = " + ".join(f"{_m['weights'][n]}e0 * {c}" for n, c in _mw.items())
_floor1 = f"CASE WHEN hit THEN {_m['checkpoint_floor']}e0 ELSE 0.0e0 END"
_floor2 = (
    f"CASE WHEN clause_id <> '' AND keyword_hits > 0 AND category_score >= {_m['keyword_floor_category']}e0 "
    f"THEN least({_m['keyword_floor_base']}e0 + {_m['keyword_floor_step']}e0 * keyword_hits, {_m['keyword_floor_top']}e0) ELSE 0.0e0 END"
)
_reason = (
    "concat_ws('; ', CASE WHEN hit THEN " + q(_m["checkpoint_reason"]) + " END, "
    + ", ".join(
        f"'{shown}=' || {fixed(column, digits)}"
        for shown, column, digits in (
            ("checkpoint", "checkpoint_score", 2), ("issue", "issue_score", 2), ("keywords", "keyword_score", 2),
            ("category", "category_score", 2), ("stage", "stage_score", 0), ("severity", "severity_score", 0),
        )
    )
    + ")"
)
SCORED = f"""
    SELECT *, {rnd(f'least(1.0e0, greatest({_score}, {_floor1}, {_floor2}))', 4)} AS score, {_reason} AS reason FROM pairs
"""
MATCHED = """
    SELECT *, row_number() OVER (PARTITION BY row_pos ORDER BY score DESC, point_pos, point_id) AS rank
    FROM scored WHERE score >= 0.18e0 QUALIFY rank <= 3
"""
MATCHING = {
    **LIBRARY,
    "names": LIBRARY_NAMES,
    "found": equipment_of(["device_type", "rule_name", "text"]),
    "point_texts": POINT_TEXTS,
    "point_parts": parted("point_texts", _POINT_PARTS),
    "issue_texts": ISSUE_TEXTS,
    "issue_parts": parted("issue_texts", _ISSUE_PARTS),
    "pairs": PAIRS,
    "scored": SCORED,
}
_MATCH_VIEWS = ("doc_issues", "standards", "clauses")
oracle(
    "match_score",
    f"""SELECT row_pos, point_id, checkpoint_score, issue_score, {rnd('keyword_score', 6)} AS keyword_score,
        category_score, opinion_score, rule_score, stage_score, severity_score, score, reason FROM scored
        QUALIFY row_number() OVER (PARTITION BY row_pos ORDER BY score DESC, point_pos, point_id) <= 3""",
    *_MATCH_VIEWS, **MATCHING,
)
MATCHING["matched"] = MATCHED
oracle("match_topk", "SELECT row_pos, point_id, score, rank, reason FROM matched", *_MATCH_VIEWS, **MATCHING)
NESTED = """
    SELECT m.row_pos, to_json(list({'kg_point_id': p.point_id, 'score': m.score, 'kg_point_text': p.full_text,
      'kg_project': p.project, 'kg_stage': p.stage, 'kg_standard_refs': p.standards} ORDER BY m.rank)) AS kg_top_matches
    FROM matched m JOIN points p ON m.point_id = p.point_id GROUP BY 1
"""
oracle("match_topk_nested", "SELECT row_pos, CAST(kg_top_matches AS VARCHAR) AS kg_top_matches FROM nested", *_MATCH_VIEWS, **MATCHING, nested=NESTED)
BEST = """
    SELECT f.row_pos AS rp, f.equipment AS issue_equipment, m.point_id AS best_id, m.score AS best_score,
      CASE WHEN m.score IS NOT NULL THEN 'matched' WHEN f.equipment = '' THEN 'unsupported_equipment'
        ELSE 'low_score' END AS kg_match_status
    FROM found f LEFT JOIN (SELECT * FROM matched WHERE rank = 1) m ON f.row_pos = m.row_pos
"""
oracle(
    "antijoin_unlinked",
    "SELECT rp AS row_pos, issue_equipment AS equipment, kg_match_status FROM best WHERE best_id IS NULL",
    *_MATCH_VIEWS, **MATCHING, best=BEST,
)


def need_case(text: str, matched: str, status: str) -> str:
    """Number of the outcome: 0 unmatched, then the rules, then the rest."""
    cases = [f"WHEN NOT ({matched}) THEN 0"]
    for i, rule in enumerate(words.REVISION_RULES, start=1):
        tests = []
        for test in rule["tests"]:
            parts = []
            if "all" in test:
                parts.append(all_of(text, test["all"]))
            if "any" in test:
                parts.append(any_of(text, test["any"]))
            if "status" in test:
                parts.append(f"{status} IN {in_list(test['status'])}")
            tests.append("(" + " AND ".join(parts) + ")")
        cases.append(f"WHEN {' OR '.join(tests)} THEN {i}")
    return f"(CASE {' '.join(cases)} ELSE {len(words.REVISION_RULES) + 1} END)"


OUTCOMES = [
    {**rules.REVISION_UNMATCHED, "needed": False}, *words.REVISION_RULES, {**rules.REVISION_OTHERWISE, "needed": False},
]


def outcome(part: str) -> str:
    show = (lambda x: "true" if x else "false") if part == "needed" else q
    return "(CASE outcome " + " ".join(f"WHEN {i} THEN {show(o[part])}" for i, o in enumerate(OUTCOMES)) + " END)"


_p = rules.REVISION_PRIORITY_RULES
ISSUE_TEXT_ALL = "concat_ws(' ', {})".format(
    ", ".join(filled(c) for c in ("text", "supervision_opinion", "actual_fix", "checkpoint_text", "pred_category"))
)


def revised(source: str, matched: str, status: str, evidence: str, score: str) -> str:
    """Select with the five revision columns over a source with the issue columns."""
    numbered = f"SELECT *, {need_case('whole_text', matched, status)} AS outcome FROM (SELECT *, {ISSUE_TEXT_ALL} AS whole_text FROM {source})"
    issue = f"CASE WHEN coalesce(priority_score, 0) > 0 THEN priority_score ELSE {mapped(clean('priority_label'), _p['label_scores'], _p['label_default'])} END"
    total = (
        f"{_p['weights']['issue']}e0 * ({issue}) + {_p['weights']['need']}e0 * (CASE WHEN {outcome('needed')} THEN 1.0e0 ELSE 0.0e0 END) "
        f"+ {_p['weights']['match']}e0 * {score} + {_p['weights']['level']}e0 * {mapped(clean('label'), _p['level_scores'], _p['level_default'])}"
    )
    lagging = f"({outcome('needed')} AND {status} IN {in_list(rules.LAGGING_STATUSES)})"
    priced = f"SELECT *, {rnd(f'least(1.0e0, {total})', 4)} AS raw_priority FROM ({numbered})"
    priced = f"SELECT *, CASE WHEN {lagging} THEN greatest(raw_priority, {_p['lagging_floor']}e0) ELSE raw_priority END AS revision_priority_score FROM ({priced})"
    shown = f"substr(CASE WHEN {matched} THEN coalesce({evidence}, '') ELSE '' END, 1, {rules.EVIDENCE_CHARS})"
    bare = f"replace({outcome('reason')}, '{{status}}', {status})"
    relation = (
        f"CASE WHEN NOT ({matched}) THEN 'unmatched' "
        + " ".join(
            f"WHEN {outcome('need')} = {q(n)} THEN {q(r)}" for n, r in rules.RELATION_OF_NEED.items() if n != "执行落实问题"
        )
        + f" WHEN {status} IN {in_list(rules.LAGGING_STATUSES)} THEN 'standard_lagging' "
        f"WHEN {outcome('need')} = '执行落实问题' THEN 'standard_execution' ELSE 'manual_review' END"
    )
    return f"""
      SELECT *, {outcome('needed')} AS revision_need, {outcome('need')} AS revision_need_type,
        CASE WHEN revision_priority_score >= 0.75e0 THEN '高' WHEN revision_priority_score >= 0.55e0 THEN '中' ELSE '低' END AS revision_priority_label,
        {bare} || CASE WHEN {shown} <> '' THEN {q(rules.REVISION_EVIDENCE)} || {shown} ELSE '' END AS revision_reason,
        {relation} AS relation_type
      FROM ({priced})
    """


NEEDS = """
    SELECT *, row_pos % 8 <> 0 AS is_matched,
      CASE row_pos % 3 WHEN 0 THEN '待修订' WHEN 1 THEN '现行' ELSE '' END AS status,
      CASE WHEN row_pos % 8 <> 0 THEN (row_pos % 100) / 100.0e0 ELSE 0.0e0 END AS match_score FROM doc_issues
"""
_revised = revised("needs", "is_matched", "status", "concat_ws(' ', specialty, rule_name)", "match_score")
oracle(
    "revision_need",
    f"SELECT row_pos, {txt('revision_need')} AS revision_need, revision_need_type, revision_reason FROM revised",
    "doc_issues", needs=NEEDS, revised=_revised,
)
oracle(
    "revision_priority", "SELECT row_pos, revision_priority_score, revision_priority_label FROM revised",
    "doc_issues", needs=NEEDS, revised=_revised,
)
oracle("relation_type", "SELECT row_pos, relation_type FROM revised", "doc_issues", needs=NEEDS, revised=_revised)

LINKED_DOCS = """
    SELECT d.*, b.*, coalesce(b.best_score, 0.0e0) AS best, p.point_id AS p_id, p.full_text AS p_text, p.project AS p_project,
      p.stage AS p_stage, p.severity AS p_severity, p.standards AS p_standards, p.requirements AS p_requirements,
      p.standard_id AS p_standard_id, p.standard_name AS p_standard_name, p.standard_no AS p_standard_no,
      coalesce(p.standard_status, '') AS p_status, p.clause_id AS p_clause_id, p.clause_no AS p_clause_no,
      p.clause_text AS p_clause_text, n.kg_top_matches AS tops
    FROM doc_issues d JOIN best b ON d.row_pos = b.rp LEFT JOIN points p ON p.point_id = b.best_id
    LEFT JOIN nested n ON n.row_pos = d.row_pos
"""
_enrich = revised(
    "linked_docs", "kg_match_status = 'matched'", "p_status",
    "concat_ws(' ', array_to_string(p_standards, ' '), nullif(array_to_string(p_requirements, ' '), ''))", "best",
)
_sid = f"coalesce({filled('p_standard_id')}, p_standards[1], '')"
_sname = f"coalesce({filled('p_standard_name')}, p_standards[1], '')"
_cid = f"coalesce({filled('p_clause_id')}, p_id, '')"
_ctext = f"coalesce({filled('p_clause_text')}, p_text, '')"
_enriched_items = {
    "row_pos": "row_pos", "problem_id": "sample_id", "kg_match_status": "kg_match_status", "kg_match_score": "best",
    "kg_point_id": "coalesce(p_id, '')", "kg_point_text": "coalesce(p_text, '')", "kg_project": "coalesce(p_project, '')",
    "kg_stage": "coalesce(p_stage, '')", "kg_severity": "coalesce(p_severity, '')",
    "kg_standard_refs": "coalesce(array_to_string(p_standards, '；'), '')",
    "kg_requirement_texts": "coalesce(array_to_string(p_requirements, ' || '), '')",
    "kg_top_matches": "coalesce(CAST(tops AS VARCHAR), '[]')",
    "related_standard_id": _sid, "related_standard_name": _sname, "related_standard_no": "coalesce(p_standard_no, '')",
    "related_clause_id": _cid, "related_clause_no": "coalesce(p_clause_no, '')", "related_clause_text": _ctext,
    "standard_match_confidence": "best", "problem_standard_relation_type": "relation_type", "standard_status": "p_status",
    "standard_revision_trigger_evidence": "revision_reason",
    "standard_revision_priority_initial": "CASE WHEN revision_priority_score >= 0.75e0 THEN 'high' WHEN revision_priority_score >= 0.55e0 THEN 'medium' ELSE 'low' END",
    "graph_problem_node_id": node_id("Problem", "sample_id"), "graph_standard_node_id": node_id("Standard", _sid),
    "graph_clause_node_id": node_id("Clause", _cid),
    "graph_relation_type": "CASE WHEN kg_match_status = 'matched' THEN 'PROBLEM_MATCHES_CLAUSE' ELSE 'UNMATCHED' END",
    "kg_standard_id": _sid, "kg_standard_name": _sname, "kg_clause_id": _cid,
    "kg_clause_title": f"coalesce({filled('p_clause_no')}, substr({_ctext}, 1, {rules.TITLE_CHARS}))",
    "kg_relation_type": "relation_type", "kg_relation_confidence": "best", "revision_need": txt("revision_need"),
    "revision_need_type": "revision_need_type", "revision_priority_score": "revision_priority_score",
    "revision_priority_label": "revision_priority_label", "revision_reason": "revision_reason",
}
oracle(
    "issue_enrich_kg",
    "SELECT " + ", ".join(f"{_enriched_items[c]} AS {c}" for c in ENRICHED_COLUMNS) + " FROM enriched",
    *_MATCH_VIEWS, **MATCHING, nested=NESTED, best=BEST, linked_docs=LINKED_DOCS, enriched=_enrich,
)
oracle(
    "final_label",
    """SELECT sample_id,
         CASE WHEN by_hand THEN reviewed ELSE coalesce(nullif(label, ''), nullif(predicted, ''), '') END AS final_confirmed_label,
         CASE WHEN by_hand THEN 'manual' WHEN predicted <> '' THEN 'model' WHEN label <> '' THEN 'dataset' ELSE '' END AS label_source,
         CASE WHEN status IN ('', 'pending') THEN 'false' ELSE 'true' END AS is_reviewed
       FROM (SELECT *, status IN ('accepted', 'corrected') AND reviewed <> '' AS by_hand FROM (
         SELECT d.sample_id, CASE WHEN row_pos % 5 = 0 THEN '' ELSE label END AS label,
           CASE WHEN row_pos % 2 = 0 THEN specialty ELSE '' END AS predicted,
           coalesce(lower(r.review_status), '') AS status, coalesce(trim(r.reviewed_label), '') AS reviewed
         FROM doc_issues d LEFT JOIN (
           SELECT * FROM reviews QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY review_no DESC) = 1
         ) r ON d.sample_id = r.sample_id))""",
    "doc_issues", "reviews",
)

# --------------------------------------------------------------- aggregations

REPORTABLE = f"""
    SELECT order_no, problem_id AS sample_id,
      kg_standard_name || CASE WHEN repeat_count = 1 THEN '; 标准 ' || device_type ELSE '' END AS kg_standard_refs,
      revision_demand = 'TRUE' AS need, coalesce(revision_need_type, '') AS need_type, predicted_severity,
      {rnd('severity_confidence * 0.9e0', 4)} AS priority_score, {rnd('kg_relation_confidence', 4)} AS kg_match_score,
      {rnd('kg_relation_confidence * category_confidence', 4)} AS revision_priority_score,
      CASE repeat_count WHEN 6 THEN 'low_score' WHEN 5 THEN 'unsupported_equipment' ELSE 'matched' END AS kg_match_status
    FROM linked_issues
"""
_rw = rules.REPORT_WEIGHTS
REPORT = f"""
    SELECT t.standard_ref, n AS linked_issue_count, need_n AS revision_need_count, major_n AS major_or_above_issue_count,
      {rnd('max_p', 4)} AS max_issue_priority, {rnd('avg_p', 4)} AS avg_issue_priority, {rnd('avg_m', 4)} AS avg_kg_match_score,
      {rnd(f"greatest({_rw['count']}e0 * least(n / 5.0e0, 1.0e0) + {_rw['need']}e0 * (need_n / n) + {_rw['max_priority']}e0 * max_p + {_rw['avg_priority']}e0 * avg_p + {_rw['major']}e0 * (major_n / n) + {_rw['match']}e0 * avg_m, 0.8e0 * max_r)", 4)} AS standard_revision_priority_score,
      example_issue_ids
    FROM (
      SELECT standard_ref, count(*) AS n, count(*) FILTER (WHERE need) AS need_n,
        count(*) FILTER (WHERE predicted_severity IN ('重大', '较大')) AS major_n, max(priority_score) AS max_p,
        {exact_sum('priority_score')} / count(*) AS avg_p, {exact_sum('kg_match_score')} / count(*) AS avg_m,
        max(revision_priority_score) AS max_r FROM by_ref GROUP BY 1) t
    JOIN (
      SELECT standard_ref, string_agg(sample_id, '；' ORDER BY rn) AS example_issue_ids FROM (
        SELECT *, row_number() OVER (PARTITION BY standard_ref ORDER BY revision_priority_score DESC, order_no, sample_id) AS rn
        FROM by_ref) WHERE rn <= 5 GROUP BY 1) e ON t.standard_ref = e.standard_ref
"""
BY_REF = f"SELECT *, unnest({refs('kg_standard_refs', REPORT_BREAK)}) AS standard_ref FROM reportable"
REPORTING = {"reportable": REPORTABLE, "by_ref": BY_REF, "report": REPORT}
oracle(
    "standard_report",
    """SELECT *, CASE WHEN standard_revision_priority_score >= 0.75e0 THEN '高'
       WHEN standard_revision_priority_score >= 0.55e0 THEN '中' ELSE '低' END AS standard_revision_priority_label FROM report""",
    "linked_issues", **REPORTING,
)
oracle(
    "link_report",
    f"""SELECT 'total' AS section, '' AS item, count(*) AS rows, CAST(NULL AS DOUBLE) AS score FROM reportable
        UNION ALL SELECT 'matched', '', count(*), NULL FROM reportable WHERE kg_match_status = 'matched'
        UNION ALL SELECT 'revision_need', '', count(*), NULL FROM reportable WHERE need
        UNION ALL SELECT 'status', kg_match_status, count(*), NULL FROM reportable GROUP BY 2
        UNION ALL SELECT 'need_type', need_type, count(*), NULL FROM reportable GROUP BY 2
        UNION ALL SELECT 'match_rate', '', NULL, {rnd("count(*) FILTER (WHERE kg_match_status = 'matched') / count(*)", 4)} FROM reportable
        UNION ALL SELECT 'top_standard', standard_ref, linked_issue_count, standard_revision_priority_score FROM (
          SELECT * FROM report ORDER BY standard_revision_priority_score DESC, linked_issue_count DESC, standard_ref LIMIT 10)
        UNION ALL SELECT 'best_sample', sample_id, NULL, kg_match_score FROM (
          SELECT * FROM reportable WHERE kg_match_status = 'matched' ORDER BY kg_match_score DESC, order_no, sample_id LIMIT 5)""",
    "linked_issues", **REPORTING,
)

EXPANDED = f"""
    SELECT order_no, CASE WHEN sid <> '' OR sname <> '' THEN
        CASE WHEN sid <> '' THEN sid ELSE {hashed('standard', 'sname', 10)} END
        ELSE {hashed('standard', 'ref', 10)} END AS kg_standard_id,
      CASE WHEN sid <> '' OR sname <> '' THEN CASE WHEN sname <> '' THEN sname ELSE sid END ELSE ref END AS kg_standard_name,
      problem_id, {clean('problem_text')} AS problem_text, {clean('device_type')} AS device_type, {clean('major')} AS major,
      {clean('organization')} AS organization, {clean('region')} AS region, predicted_severity,
      {demand('need_review')} AS need_review, {number_share('category_confidence')} AS category_confidence,
      {number_share('severity_confidence')} AS severity_confidence, kg_clause_id,
      CASE WHEN kg_clause_id <> '' THEN {clean('kg_clause_title')} ELSE '' END AS kg_clause_title,
      standard_no, standard_status, clause_no, kg_relation_type,
      {number_share('kg_relation_confidence')} AS kg_relation_confidence,
      ({demand('revision_demand')} OR {clean('revision_demand')} IN {in_list(rules.CERTAIN_DEMANDS)}) AS revision_demand,
      {clean('revision_need_type')} AS revision_need_type,
      {share('standard_revision_priority_score')} AS standard_revision_priority_score
    FROM (
      SELECT *, unnest(CASE WHEN sid <> '' OR sname <> '' THEN [''] ELSE {refs('kg_standard_refs', CLAUSE_BREAK)} END) AS ref
      FROM (SELECT *, {clean('kg_standard_id')} AS sid, {clean('kg_standard_name')} AS sname FROM linked_issues))
"""
_EXPANDED_COLUMNS = [
    "kg_standard_id", "kg_standard_name", "problem_id", "problem_text", "device_type", "major", "organization",
    "region", "predicted_severity", "kg_clause_id", "kg_clause_title", "standard_no", "standard_status",
    "clause_no", "kg_relation_type", "revision_need_type", "need_review", "revision_demand",
    "category_confidence", "severity_confidence", "kg_relation_confidence", "standard_revision_priority_score",
]
oracle(
    "clause_expand",
    "SELECT " + ", ".join(
        f"{txt(c)} AS {c}" if c in ("need_review", "revision_demand") else c for c in _EXPANDED_COLUMNS
    ) + " FROM expanded",
    "linked_issues", expanded=EXPANDED,
)
GROUP = ", ".join(ranking.GROUP)
_known = "list_filter([category_confidence, severity_confidence, kg_relation_confidence], lambda x: x > 0)"
LOW = f"coalesce(list_min({_known}) < 0.6e0, false)"
_sev = severity("predicted_severity")
AGGREGATED = f"""
    SELECT {GROUP}, kg_clause_id = '' AS clause_missing, count(*) AS related_problem_count,
      count(*) FILTER (WHERE {_sev} >= 3) AS high_severity_problem_count,
      count(*) FILTER (WHERE {_sev} >= 2) AS medium_high_severity_problem_count,
      count(*) FILTER (WHERE revision_demand) AS revision_demand_count,
      count(*) FILTER (WHERE need_review) AS manual_review_count,
      count(*) FILTER (WHERE {LOW}) AS low_confidence_problem_count,
      {exact_sum('kg_relation_confidence')} / count(*) AS mean_confidence, max(kg_relation_confidence) AS best_confidence,
      {exact_sum('standard_revision_priority_score')} / count(*) AS mean_priority,
      0.35e0 * max({mapped('standard_status', rules.STATUS_SCORES, 0)})
        + 0.35e0 * max({mapped('kg_relation_type', rules.RELATION_SCORES, 0)})
        + 0.3e0 * max({mapped('revision_need_type', rules.NEED_SCORES, 0)}) AS context,
      {', '.join(f"count(DISTINCT nullif({d}, '')) AS {d}_count" for d in ranking.DIMENSIONS)},
      arg_min(standard_no, (order_no, standard_no, clause_no)) AS standard_no,
      arg_min(clause_no, (order_no, standard_no, clause_no)) AS clause_no
    FROM expanded GROUP BY {GROUP}
"""
_rounded4 = ["mean_confidence", "best_confidence", "mean_priority", "context"]
_counts = [
    "related_problem_count", "high_severity_problem_count", "medium_high_severity_problem_count",
    "revision_demand_count", "manual_review_count", "low_confidence_problem_count",
    *[f"{d}_count" for d in ranking.DIMENSIONS],
]
oracle(
    "clause_aggregate",
    f"SELECT {GROUP}, {txt('clause_missing')} AS clause_missing, {', '.join(_counts)}, "
    + ", ".join(f"{rnd(c, 4)} AS {c}" for c in _rounded4)
    + ", standard_no, clause_no FROM aggregated",
    "linked_issues", expanded=EXPANDED, aggregated=AGGREGATED,
)
oracle(
    "clause_context_priority",
    f"SELECT {GROUP}, {rnd('context', 4)} AS context, {rnd('greatest(mean_priority, context)', 4)} AS existing FROM aggregated",
    "linked_issues", expanded=EXPANDED, aggregated=AGGREGATED,
)
_c = "related_problem_count"
CLAUSE_PARTS = f"""
    SELECT *, least(1.0e0, {_c} / greatest(3, least(total, 10))) AS frequency,
      least(1.0e0, (high_severity_problem_count + 0.6e0 * (medium_high_severity_problem_count - high_severity_problem_count)) / {_c}) AS severity,
      revision_demand_count / {_c} AS demand, mean_confidence AS confidence,
      (least(device_type_count / 3.0e0, 1.0e0) + least(major_count / 3.0e0, 1.0e0) + least(organization_count / 5.0e0, 1.0e0)
        + least(region_count / 5.0e0, 1.0e0)) / 4.0e0 AS coverage,
      greatest(mean_priority, context) AS existing,
      greatest(manual_review_count / {_c}, low_confidence_problem_count / {_c}) AS uncertainty
    FROM aggregated, (SELECT count(*) AS total FROM expanded)
"""
_cw = rules.RANKING_WEIGHTS
_mixed = " + ".join(f"{_cw[n]}e0 * {n}" for n in ("frequency", "severity", "demand", "confidence", "coverage", "existing"))
_say = {k: q(x) for k, x in rules.RANKING_PHRASES.items()}
CLAUSE_SCORED = f"""
    SELECT *, CASE WHEN score >= 80 THEN '高优先级' WHEN score >= 60 THEN '中高优先级' WHEN score >= 40 THEN '中优先级' ELSE '低优先级' END AS level,
      {_say['lead']} || concat_ws('，',
        CASE WHEN {_c} >= 5 THEN {_say['count_many']} WHEN {_c} >= 2 THEN {_say['count_some']} ELSE {_say['count_few']} END,
        CASE WHEN high_severity_problem_count / {_c} >= 0.4e0 THEN {_say['high_share']} WHEN high_severity_problem_count > 0 THEN {_say['high_some']}
          WHEN medium_high_severity_problem_count > 0 THEN {_say['medium_some']} END,
        CASE WHEN revision_demand_count >= 2 THEN {_say['demand_many']} WHEN revision_demand_count > 0 THEN {_say['demand_some']} ELSE {_say['demand_none']} END,
        CASE WHEN mean_confidence >= 0.75e0 THEN {_say['confidence_high']} WHEN mean_confidence > 0 THEN {_say['confidence_some']} END,
        CASE WHEN coverage >= 0.5e0 THEN {_say['coverage']} END,
        CASE WHEN uncertainty >= 0.4e0 THEN {_say['uncertain']} END,
        CASE WHEN score >= 60 THEN {_say['advice_now']} ELSE {_say['advice_later']} END) AS reason
    FROM (SELECT *, {rnd(f"least(1.0e0, greatest(0.0e0, {_mixed} - {_cw['uncertainty']}e0 * uncertainty)) * 100.0e0", 2)} AS score FROM clause_parts)
"""
CLAUSES = {"expanded": EXPANDED, "aggregated": AGGREGATED, "clause_parts": CLAUSE_PARTS, "clause_scored": CLAUSE_SCORED}
oracle(
    "clause_score",
    f"SELECT {GROUP}, "
    + ", ".join(f"{rnd(n, 4)} AS {n}" for n in ("frequency", "severity", "demand", "confidence", "coverage", "existing", "uncertainty"))
    + ", score, level, reason FROM clause_scored",
    "linked_issues", **CLAUSES,
)


def distribution(column: str, out: str) -> str:
    pair = f"""to_json({column}) || ':' || n"""
    return f"""
      SELECT {GROUP}, '{{' || string_agg({pair}, ',' ORDER BY {column}) || '}}' AS {out} FROM (
        SELECT {GROUP}, {column}, count(*) AS n FROM expanded WHERE {column} <> '' GROUP BY {GROUP}, {column})
      GROUP BY {GROUP}"""


DISTRIBUTIONS = {
    "relations": distribution("kg_relation_type", "relation_type_distribution"),
    "needs_spread": distribution("revision_need_type", "revision_need_type_distribution"),
}
oracle(
    "clause_distribution",
    f"SELECT * FROM relations FULL JOIN needs_spread USING ({GROUP})",
    "linked_issues", expanded=EXPANDED, **DISTRIBUTIONS,
)
REPRESENTATIVES = f"""
    SELECT {GROUP}, string_agg(problem_id, '；' ORDER BY rn) AS representative_problem_ids,
      coalesce(string_agg(nullif(problem_text, ''), '；' ORDER BY rn), '') AS representative_problem_texts
    FROM (SELECT *, row_number() OVER (PARTITION BY {GROUP} ORDER BY {_sev} DESC, kg_relation_confidence DESC,
      standard_revision_priority_score DESC, (problem_text <> '') DESC, order_no, problem_id) AS rn FROM expanded)
    WHERE rn <= 3 GROUP BY {GROUP}
"""
oracle("clause_representatives", "SELECT * FROM representatives", "linked_issues", expanded=EXPANDED, representatives=REPRESENTATIVES)
_order = f"score DESC, related_problem_count DESC, best_confidence DESC, {GROUP}"
RANKED = f"""
    SELECT *, row_number() OVER (ORDER BY {_order}) AS rank FROM clause_scored QUALIFY rank <= 50
"""
_rank_items = {
    "rank": "rank", **{g: g for g in ranking.GROUP}, "clause_missing": txt("clause_missing"), **{c: c for c in _counts},
    "avg_relation_confidence": rnd("mean_confidence", 4), "max_relation_confidence": rnd("best_confidence", 4),
    "avg_standard_revision_priority_score": rnd("existing", 4), "aggregated_priority_score": "score",
    "aggregated_priority_level": "level", "aggregated_priority_reason": "reason",
    "representative_problem_ids": "representative_problem_ids",
    "representative_problem_texts": "representative_problem_texts", "standard_id": "kg_standard_id",
    "standard_name": "kg_standard_name", "standard_no": "standard_no", "clause_id": "kg_clause_id", "clause_no": "clause_no",
    "problem_count": _c, "high_risk_problem_count": "high_severity_problem_count",
    "avg_match_confidence": rnd("mean_confidence", 4),
    "relation_type_distribution": "coalesce(relation_type_distribution, '{}')",
    "revision_need_type_distribution": "coalesce(revision_need_type_distribution, '{}')",
    "revision_priority_score": "score", "revision_priority_level": "level", "revision_reason_summary": "reason",
}
oracle(
    "clause_rank",
    "SELECT " + ", ".join(f"{x} AS {n}" for n, x in _rank_items.items())
    + f" FROM ranked LEFT JOIN representatives USING ({GROUP}) LEFT JOIN relations USING ({GROUP}) LEFT JOIN needs_spread USING ({GROUP})",
    "linked_issues", **CLAUSES, **DISTRIBUTIONS, representatives=REPRESENTATIVES, ranked=RANKED,
)
oracle(
    "clause_summary",
    f"""SELECT (SELECT count(*) FROM expanded) AS total_related_problems, count(*) AS aggregated_item_count,
        count(DISTINCT kg_standard_id) AS standard_count, count(*) FILTER (WHERE NOT clause_missing) AS clause_count,
        count(*) FILTER (WHERE level = '高优先级') AS high_priority_count,
        count(*) FILTER (WHERE level = '中高优先级') AS medium_high_priority_count,
        (SELECT count(*) FROM expanded WHERE need_review) AS manual_review_problem_count,
        (SELECT count(*) FROM expanded WHERE {LOW}) AS low_confidence_problem_count FROM ranked""",
    "linked_issues", **CLAUSES, ranked=RANKED,
)
oracle(
    "dataset_stats",
    """SELECT 'raw_rows' AS item, '' AS value, count(*) AS rows FROM raw_issues
       UNION ALL SELECT 'prepared_rows', '', count(*) FROM deduped
       UNION ALL SELECT 'dropped_rows', '', (SELECT count(*) FROM raw_issues) - (SELECT count(*) FROM deduped)
       UNION ALL SELECT 'label_distribution', label, count(*) FROM deduped GROUP BY label
       UNION ALL SELECT * FROM (SELECT 'specialty_distribution_top10', specialty, count(*) AS n FROM deduped
         GROUP BY specialty ORDER BY n DESC, specialty LIMIT 10)
       UNION ALL SELECT * FROM (SELECT 'rule_name_distribution_top10', rule_name, count(*) AS n FROM deduped
         GROUP BY rule_name ORDER BY n DESC, rule_name LIMIT 10)""",
    "raw_issues", **PREPARED,
)
oracle(
    "category_level_crosstab",
    "SELECT category, count(*) AS rows, "
    + ", ".join(f'count(*) FILTER (WHERE label = {q(x)}) AS "{x}"' for x in rules.LEVELS)
    + " FROM categorised GROUP BY category",
    "doc_issues", categorised=CATEGORISED,
)
_valid = {
    "invalid_relation_type": f"coalesce(kg_relation_type, '') NOT IN {in_list(rules.VALID_RELATIONS)}",
    "invalid_revision_need_type": f"coalesce(revision_need_type, '') NOT IN {in_list(rules.VALID_NEEDS)}",
    "invalid_priority": "repeat_count = 2",
    "invalid_graph_relation_type": "false",
}
_conf = "CASE WHEN repeat_count = 6 THEN NULL WHEN repeat_count = 5 THEN 1.5e0 ELSE kg_relation_confidence END"
oracle(
    "link_validate",
    f"""SELECT *, 'WARNING' AS status, 'missing fields: graph_relation_type' || CASE WHEN r > 0.5e0 THEN
          '; related_clause_text missing rate ' || {fixed('r * 100', 2)} || '% exceeds 50%' ELSE '' END AS warnings
        FROM (SELECT count(*) AS total_records,
          {rnd("count(*) FILTER (WHERE trim(coalesce(kg_standard_name, '')) = '') / count(*)", 6)} AS missing_related_standard_name_rate,
          {rnd("count(*) FILTER (WHERE repeat_count < 4) / count(*)", 6)} AS missing_related_clause_text_rate,
          count(*) FILTER (WHERE repeat_count < 4) / count(*) AS r,
          count(*) FILTER (WHERE ({_conf}) IS NULL OR ({_conf}) < 0 OR ({_conf}) > 1) AS invalid_confidence,
          {', '.join(f'count(*) FILTER (WHERE {x}) AS {n}' for n, x in _valid.items())}
        FROM linked_issues)""".replace("SELECT *, 'WARNING'", "SELECT * EXCLUDE (r), 'WARNING'"),
    "linked_issues",
)

# --------------------------------------------------- feedback and set operations

oracle(
    "feedback_append",
    """SELECT sample_id, row_pos, label, reviewed_label FROM (
         SELECT sample_id, row_pos, label, NULL AS reviewed_label, 0 AS part FROM doc_issues UNION ALL
         SELECT sample_id, review_no, NULL, reviewed_label, 1 FROM reviews)
       QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY part DESC, row_pos DESC) = 1""",
    "doc_issues", "reviews",
)
oracle(
    "feedback_attach",
    """SELECT sample_id, predicted_label, confidence, 'model-1' AS model_version, '2024-01-01T00:00:00' AS prediction_time,
       CAST(coalesce(level_confidence < 0.8e0, false) AS VARCHAR) AS need_manual_review, 'pending' AS review_status,
       '' AS reviewed_label, '' AS review_comment, '' AS feedback_time, predicted_label AS final_label FROM predictions""",
    "linked_issues", predictions=PREDICTIONS,
)
oracle(
    "feedback_retrain",
    f"""SELECT sample_id, coalesce(reviewed_label, label) AS label,
        CASE WHEN reviewed_label IS NULL THEN source
          WHEN coalesce(source, '') <> '' THEN source || '|{rules.REVIEWED_TAG}' ELSE '{rules.REVIEWED_TAG}' END AS data_source
        FROM (SELECT sample_id, label, CASE WHEN row_pos % 2 = 0 THEN 'docs' END AS source FROM doc_issues)
        LEFT JOIN reviewed USING (sample_id)""",
    "doc_issues", "reviews", reviewed=REVIEWED,
)

# --------------------------------------------------------------- graph export

GRAPH_INPUT = """
    SELECT *, 'because "of" ' || predicted_severity AS revision_reason,
      CASE WHEN repeat_count < 3 THEN '高' ELSE '低' END AS revision_priority_label FROM linked_issues
"""
_GRAPH_COLUMNS = {*_LINKED, "revision_reason", "revision_priority_label"}


def graph_value(name: str) -> str:
    fields = graph.RECORD_ALIASES.get(name, [name])
    found = [c for c in fields if c in _GRAPH_COLUMNS]
    return first(*[txt(c) for c in found]) if found else "''"


_record_special = {"is_reviewed": "'false'", "label_source": "''", "final_confirmed_label": "''"}
oracle(
    "graph_records",
    "SELECT "
    + ", ".join(
        f"{_record_special.get(c, graph_value(c))} AS {c}"
        for c in graph.RECORD_COLUMNS
        if c not in ("graph_nodes", "graph_edges")
    )
    + " FROM graph_input",
    "linked_issues", graph_input=GRAPH_INPUT,
)
_NESTED_INPUT = f"""
    SELECT problem_id, {clean('predicted_category')} AS category, {clean('predicted_severity')} AS level,
      {clean('device_type')} AS device, {clean('major')} AS major, {clean('kg_clause_id')} AS clause,
      {clean('kg_clause_title')} AS title, {clean('kg_standard_id')} AS sid, {clean('kg_standard_name')} AS sname,
      {clean(txt('kg_relation_confidence'))} AS confidence, revision_reason AS reason,
      {refs('kg_standard_refs', CLAUSE_BREAK)} AS ref_list
    FROM graph_input
"""


def _js(x: str) -> str:
    return f"CAST(to_json({x}) AS VARCHAR)"


def _jnode(id_: str, kind: str, name: str) -> str:
    return f"""'{{"id":' || {_js(id_)} || ',"type":"{kind}","name":' || {_js(name)} || ',"properties":{{}}}}'"""


def _jedge(source: str, target: str, relation: str, source_field: str, linked: bool) -> str:
    conf, reason = (_js("confidence"), _js("reason")) if linked else ("'\"\"'", "'\"\"'")
    return (
        f"""'{{"source":' || {_js(source)} || ',"target":' || {_js(target)} || ',"relation_type":"{relation}","confidence":' """
        f"""|| {conf} || ',"source_field":' || {_js(source_field)} || ',"relation_reason":' || {reason} || '}}'"""
    )


_plain = [
    ("category", "category", "has_category", "predicted_category"),
    ("level", "severity", "has_severity", "predicted_severity"),
    ("device", "device", "has_device", "device_type"),
    ("major", "major", "has_major", "specialty"),
]
_pairs = (
    f"CASE WHEN sid <> '' OR sname <> '' THEN [{{'id': CASE WHEN sid <> '' THEN sid ELSE {hashed('standard', 'sname')} END, "
    "'name': CASE WHEN sname <> '' THEN sname ELSE sid END, 'field': 'kg_standard_id'}] "
    f"ELSE list_transform(ref_list, lambda r: {{'id': {hashed('standard', 'r')}, 'name': r, 'field': 'kg_standard_refs'}}) END"
)
_node_items = [_jnode("problem_id", "problem", "problem_id")] + [
    f"CASE WHEN {x} <> '' THEN {_jnode(hashed(kind, x), kind, x)} END" for x, kind, _, _ in _plain
] + [f"CASE WHEN clause <> '' THEN {_jnode('clause', 'clause', 'CASE WHEN title <> ' + chr(39) * 2 + ' THEN title ELSE clause END')} END"]
_edge_items = [
    f"CASE WHEN {x} <> '' THEN {_jedge('problem_id', hashed(kind, x), rel, q(f), False)} END" for x, kind, rel, f in _plain
] + [f"CASE WHEN clause <> '' THEN {_jedge('problem_id', 'clause', 'related_to_clause', q('kg_clause_id'), True)} END"]
oracle(
    "graph_nested_json",
    f"""SELECT problem_id,
        '[' || array_to_string(list_distinct_kept, ',') || ']' AS graph_nodes,
        '[' || array_to_string(list_concat(list_filter([{', '.join(_edge_items)}], lambda x: x IS NOT NULL),
          flatten(list_transform(pairs, lambda p: list_filter([
            {_jedge('problem_id', 'p.id', 'related_to_standard', 'p.field', True)},
            CASE WHEN clause <> '' THEN {_jedge('clause', 'p.id', 'belongs_to_standard', q('kg_clause_id'), True)} END
          ], lambda x: x IS NOT NULL)))), ',') || ']' AS graph_edges
        FROM (SELECT *, list_filter(all_nodes, lambda x, i: list_position(all_nodes, x) = i) AS list_distinct_kept FROM (
          SELECT *, list_concat(list_filter([{', '.join(_node_items)}], lambda x: x IS NOT NULL),
            list_transform(pairs, lambda p: {_jnode('p.id', 'standard', 'p.name')})) AS all_nodes
          FROM (SELECT *, {_pairs} AS pairs FROM nested_input)))""".replace(
        "\"name\":' || " + _js("problem_id") + " || ',\"properties\":{}}'",
        "\"name\":' || " + _js("problem_id") + " || ',\"properties\":' || CASE WHEN ptext <> '' THEN '{\"text\":' || " + _js("ptext") + " || '}' ELSE '{}' END || '}'",
    ),
    "linked_issues", graph_input=GRAPH_INPUT,
    nested_input=_NESTED_INPUT.replace("SELECT problem_id,", "SELECT problem_id, '' AS ptext,", 1),
)
TABLE_INPUT = f"""
    SELECT order_no, problem_id, 'Problem:' || problem_id AS problem_node, '' AS problem_note,
      CASE WHEN {clean('kg_standard_id')} <> '' THEN 'Standard:' || {clean('kg_standard_id')} ELSE '' END AS standard_node,
      {clean('kg_standard_name')} AS standard_name, standard_no, standard_status,
      CASE WHEN {clean('kg_clause_id')} <> '' THEN 'Clause:' || {clean('kg_clause_id')} ELSE '' END AS clause_node,
      clause_no, {clean('kg_clause_title')} AS clause_text, {clean('predicted_category')} AS category,
      {clean('device_type')} AS equipment, {clean('revision_need_type')} AS need, revision_priority_label AS priority,
      {txt('kg_relation_confidence')} AS confidence, revision_reason AS reason
    FROM graph_input
"""


def _slot(n: int, id_: str, kind: str, name: str, where: str, no="NULL", status="NULL", clause="NULL", text="NULL") -> str:
    return (
        f"SELECT order_no, problem_id, {n} AS slot, {id_} AS node_id, '{kind}' AS node_type, {name} AS name, "
        f"{no} AS standard_no, {status} AS status, {clause} AS clause_no, {text} AS text FROM table_input WHERE {where}"
    )


_priority_node = hashed("RevisionPriority", "standard_node || ':' || priority")
_nodes = " UNION ALL ".join([
    _slot(0, "problem_node", "Problem", "problem_id", "true"),
    _slot(1, "standard_node", "Standard", "coalesce(nullif(standard_name, ''), standard_node)", "standard_node <> ''", no="standard_no", status="standard_status"),
    _slot(2, "clause_node", "Clause", "clause_no", "clause_node <> ''", clause="clause_no", text="clause_text"),
    _slot(3, hashed("ProblemCategory", "category"), "ProblemCategory", "category", "category <> ''"),
    _slot(4, hashed("Equipment", "equipment"), "Equipment", "equipment", "equipment <> ''"),
    _slot(5, hashed("RevisionNeed", "need"), "RevisionNeed", "need", "need <> ''"),
    _slot(6, _priority_node, "RevisionPriority", "priority", "standard_node <> ''"),
])
oracle(
    "graph_node_table",
    "SELECT node_id, node_type, name, standard_no, status, clause_no, text FROM nodes "
    "QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY order_no, problem_id, slot) = 1",
    "linked_issues", graph_input=GRAPH_INPUT, table_input=TABLE_INPUT, nodes=_nodes,
)


def _edge_slot(n: int, source: str, target: str, relation: str, where: str, linked: bool = False) -> str:
    conf, reason = ("confidence", "reason") if linked else ("NULL", "NULL")
    return (
        f"SELECT order_no, problem_id, {n} AS slot, {source} AS source_id, {target} AS target_id, "
        f"'{relation}' AS relation_type, {conf} AS confidence, {reason} AS relation_reason FROM table_input WHERE {where}"
    )


_edges = " UNION ALL ".join([
    _edge_slot(0, "problem_node", "clause_node", "PROBLEM_MATCHES_CLAUSE", "clause_node <> ''", True),
    _edge_slot(1, "clause_node", "standard_node", "CLAUSE_BELONGS_TO_STANDARD", "clause_node <> '' AND standard_node <> ''"),
    _edge_slot(2, "problem_node", hashed("ProblemCategory", "category"), "PROBLEM_HAS_CATEGORY", "category <> ''"),
    _edge_slot(3, "problem_node", hashed("Equipment", "equipment"), "PROBLEM_INVOLVES_EQUIPMENT", "equipment <> ''"),
    _edge_slot(4, "problem_node", hashed("RevisionNeed", "need"), "PROBLEM_TRIGGERS_REVISION_NEED", "need <> ''"),
    _edge_slot(5, "standard_node", _priority_node, "STANDARD_HAS_REVISION_PRIORITY", "standard_node <> ''"),
])
oracle(
    "graph_edge_table",
    "SELECT " + hashed("Edge", "source_id || '|' || relation_type || '|' || target_id")
    + " AS edge_id, source_id, target_id, relation_type, confidence, relation_reason FROM edges "
    "QUALIFY row_number() OVER (PARTITION BY source_id, relation_type, target_id ORDER BY order_no, problem_id, slot) = 1",
    "linked_issues", graph_input=GRAPH_INPUT, table_input=TABLE_INPUT, edges=_edges,
)

# ---------------------------------------------- dataset, training, evaluation


def _shared(source: str, size: str, wanted: str, out: str) -> str:
    share = f"({size} * ({wanted}) / sum({size}) OVER ())"
    based = f"SELECT *, {share} AS s_{out}, floor({share}) AS b_{out}, ({wanted}) AS w_{out} FROM {source}"
    return (
        f"SELECT *, CAST(b_{out} + CASE WHEN row_number() OVER (ORDER BY s_{out} - b_{out} DESC, label) "
        f"<= w_{out} - sum(b_{out}) OVER () THEN 1 ELSE 0 END AS BIGINT) AS {out} FROM ({based})"
    )


oracle(
    "split_stratified",
    """SELECT d.row_pos, d.label, CASE WHEN place <= train_n THEN 'train' WHEN place <= train_n + valid_n THEN 'valid'
         ELSE 'test' END AS split
       FROM (SELECT row_pos, label, row_number() OVER (PARTITION BY label ORDER BY sha1('42:' || row_pos), row_pos) AS place
         FROM doc_issues) d JOIN sized ON d.label = sized.label""",
    "doc_issues",
    sizes="SELECT label, count(*) AS n FROM doc_issues GROUP BY label",
    trained=_shared("sizes", "n", "SELECT floor(0.8e0 * sum(n)) FROM sizes", "train_n"),
    rested="SELECT label, train_n, n - train_n AS rest FROM trained",
    sized=_shared("rested", "rest", "SELECT floor(0.1e0 / (0.1e0 + 0.1e0) * sum(rest)) FROM rested", "valid_n"),
)
oracle(
    "label_map",
    "SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM (SELECT DISTINCT category AS label FROM categorised)",
    "doc_issues", categorised=CATEGORISED,
)
oracle(
    "label_encode",
    f"""SELECT CAST(row_pos AS VARCHAR) AS row_pos, {_tag}, category AS label_text, label_id AS labels
        FROM categorised JOIN (SELECT label AS l, row_number() OVER (ORDER BY label) - 1 AS label_id
          FROM (SELECT DISTINCT category AS label FROM categorised)) ON category = l""",
    "doc_issues", categorised=CATEGORISED,
)
CLASS_SCORES = """
    SELECT c.label, coalesce(hits, 0) AS hits, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted,
      CASE WHEN coalesce(predicted, 0) > 0 THEN hits / predicted ELSE 0 END AS precision,
      CASE WHEN coalesce(support, 0) > 0 THEN hits / support ELSE 0 END AS recall,
      CASE WHEN coalesce(support, 0) + coalesce(predicted, 0) > 0
        THEN 2.0e0 * coalesce(hits, 0) / (coalesce(support, 0) + coalesce(predicted, 0)) ELSE 0 END AS f1
    FROM (SELECT label FROM guesses UNION SELECT predicted_label FROM guesses) c
    LEFT JOIN (SELECT label, count(*) AS support, count(*) FILTER (WHERE label = predicted_label) AS hits
      FROM guesses GROUP BY label) s ON s.label = c.label
    LEFT JOIN (SELECT predicted_label AS label, count(*) AS predicted FROM guesses GROUP BY 1) p ON p.label = c.label
"""


def steady(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(30,12))) AS DOUBLE)"


oracle(
    "eval_metrics",
    f"""SELECT {rnd('sum(hits) / sum(support)', 6)} AS accuracy, {rnd(steady('f1') + ' / count(*)', 6)} AS macro_f1,
        {rnd(steady('f1 * support') + ' / sum(support)', 6)} AS weighted_f1 FROM class_scores""",
    "guesses", class_scores=CLASS_SCORES,
)
_report3 = ("precision", "recall", "f1")
oracle(
    "eval_report",
    f"""SELECT label, {', '.join(f'{rnd(f"coalesce({x}, 0)", 6)} AS {x}' for x in _report3)}, CAST(support AS BIGINT) AS support FROM class_scores
        UNION ALL SELECT 'accuracy', NULL, NULL, {rnd('sum(hits) / sum(support)', 6)}, CAST(sum(support) AS BIGINT) FROM class_scores
        UNION ALL SELECT 'macro avg', {', '.join(rnd(steady(f'coalesce({x}, 0)') + ' / count(*)', 6) for x in _report3)}, CAST(sum(support) AS BIGINT) FROM class_scores
        UNION ALL SELECT 'weighted avg', {', '.join(rnd(steady(f'coalesce({x}, 0) * support') + ' / sum(support)', 6) for x in _report3)},
          CAST(sum(support) AS BIGINT) FROM class_scores""",
    "guesses", class_scores=CLASS_SCORES,
)
oracle(
    "eval_confusion",
    """SELECT label_id, c.label, """
    + ", ".join(f"count(*) FILTER (WHERE g.predicted_label = {q(x)}) AS {x}" for x in ("bad", "good", "other"))
    + """ FROM (VALUES (0::BIGINT, 'bad'), (1, 'good'), (2, 'other')) c(label_id, label)
        LEFT JOIN guesses g ON g.label = c.label GROUP BY 1, 2""",
    "guesses",
)


def _binary(truth: str, guess: str) -> str:
    return (
        f"SELECT sum({truth} * {guess}) AS hits, sum({truth}) AS support, sum({guess}) AS predicted FROM yes"
    )


oracle(
    "eval_multilabel",
    f"""SELECT (SELECT {rnd('avg(CASE WHEN quality = g AND toxic = t THEN 1.0e0 ELSE 0.0e0 END)', 6)} FROM yes) AS accuracy,
        {rnd(steady('f1') + ' / count(*)', 6)} AS macro_f1,
        {rnd(steady('f1 * support') + ' / sum(support)', 6)} AS weighted_f1
        FROM (SELECT *, CASE WHEN support + predicted > 0 THEN 2.0e0 * hits / (support + predicted) ELSE 0 END AS f1
          FROM ({_binary('quality', 'g')} UNION ALL {_binary('toxic', 't')}))""",
    "guesses",
    yes="""SELECT quality, toxic, CASE WHEN 1.0e0 / (1.0e0 + exp(-good_logit)) >= 0.5e0 THEN 1 ELSE 0 END AS g,
      CASE WHEN 1.0e0 / (1.0e0 + exp(-toxic_logit)) >= 0.5e0 THEN 1 ELSE 0 END AS t FROM guesses""",
)

assert all(name in VIEWS for name in ("linked_issues", "doc_issues", "raw_issues"))

# Naive Bayes: weights in millionths, whole numbers on both sides.
_log = lambda x: f"CAST(round(ln({x}) * 1000000) AS BIGINT)"
BAYES = {
    "model_input": MODEL_INPUT,
    "classes": "SELECT label, row_number() OVER (ORDER BY label) - 1 AS class FROM (SELECT DISTINCT label FROM model_input)",
    "model_rows": f"""SELECT row_pos, label, class, string_split({text_clean('model_input')}, '') AS letters
        FROM model_input JOIN classes USING (label)""",
    "grams": """SELECT row_pos, class, unnest(CASE WHEN len(letters) <= 2 THEN [array_to_string(letters, '')]
        ELSE list_transform(range(1, len(letters)), lambda i: letters[i] || letters[i + 1]) END) AS gram FROM model_rows""",
    "seen": "SELECT gram, class, count(*) AS n FROM grams GROUP BY 1, 2",
    "total": "SELECT class, sum(n) + (SELECT count(DISTINCT gram) FROM seen) AS total FROM seen GROUP BY 1",
    "weights": f"""SELECT g.gram, t.class, {_log('(coalesce(n, 0) + 1) / total')} AS weight
        FROM (SELECT DISTINCT gram FROM seen) g, total t LEFT JOIN seen s ON s.gram = g.gram AND s.class = t.class""",
    "priors": f"SELECT class, {_log('count(*) / (SELECT count(*) FROM model_rows)')} AS prior FROM model_rows GROUP BY 1",
}
oracle(
    "train_classifier",
    "SELECT gram, class, weight FROM weights UNION ALL SELECT '', class, prior FROM priors",
    "doc_issues", **BAYES,
)
oracle(
    "batch_predict",
    f"""SELECT row_pos, r.label AS label_text, best AS predicted_label_id, c.label AS predicted_label, {rnd('confidence', 6)} AS confidence
        FROM (SELECT row_pos, min_by(class, (-score, class)) AS best, 1 / sum(exp((score - top) / 1000000.0e0)) AS confidence
              FROM (SELECT *, max(score) OVER (PARTITION BY row_pos) AS top FROM scores) GROUP BY row_pos)
        JOIN model_rows r USING (row_pos) JOIN classes c ON c.class = best""",
    "doc_issues", **BAYES,
    scores="""SELECT row_pos, w.class, CAST(sum(n * weight) AS BIGINT) + any_value(prior) AS score
        FROM (SELECT row_pos, gram, count(*) AS n FROM grams GROUP BY 1, 2) g JOIN weights w USING (gram) JOIN priors p ON p.class = w.class
        GROUP BY 1, 2""",
)
