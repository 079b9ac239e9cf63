"""Given tables in the shape of issue tables.

The adapters are plain SQL that reads the same in Spark and in other engines;
names in back quotes are identifiers.  A view may use the tables and the views
before it.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import cache
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

from clausewise.sources.tables import spread

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

FACTS = {"lineitem", "documents"}
#: What the first join of linked_issues goes by.
LINES_BY_ORDER = {"lineitem": "l_orderkey"}

VIEWS = {
    # Order lines as issues that are linked to standards and clauses already.
    "linked_issues": """
        SELECT
          CAST(l_orderkey AS BIGINT) * 8 + l_linenumber AS order_no,
          'I' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
            || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS problem_id,
          CASE WHEN l_linenumber = 7 THEN ' ' ELSE p_name || ' / ' || o_orderpriority END AS problem_text,
          p_type AS device_type,
          CASE o_orderstatus WHEN 'F' THEN '电气' WHEN 'O' THEN '试验' ELSE 'NaN' END AS major,
          n_name AS organization,
          r_name AS region,
          CASE o_orderpriority WHEN '1-URGENT' THEN '调试与试验' WHEN '2-HIGH' THEN '安装与施工'
            WHEN '3-MEDIUM' THEN '采购与制造' WHEN '4-NOT SPECIFIED' THEN '资料与标识'
            ELSE '' END AS predicted_category,
          CASE l_returnflag WHEN 'R' THEN '重大' WHEN 'A' THEN '较大' ELSE '一般' END AS predicted_severity,
          1 - 5 * l_tax AS category_confidence,
          1 - 5 * l_discount AS severity_confidence,
          CASE WHEN l_discount >= 0.08e0 THEN 'yes' WHEN l_discount < 0.01e0 THEN NULL ELSE 'false' END AS need_review,
          CASE WHEN l_linenumber = 3 THEN '' WHEN l_linenumber = 4 THEN NULL ELSE p_brand END AS kg_standard_id,
          CASE WHEN l_linenumber = 3 THEN 'none' ELSE '标准 ' || p_brand END AS kg_standard_name,
          CASE WHEN l_linenumber = 3 THEN p_brand || '；标准 ' || p_type || '|; ' || p_brand ELSE 'nan' END AS kg_standard_refs,
          'Q/' || p_brand AS standard_no,
          CASE p_size % 4 WHEN 0 THEN '现行' WHEN 1 THEN '待修订' WHEN 2 THEN '废止' ELSE '在运' END AS standard_status,
          CASE WHEN l_linenumber = 5 THEN '' ELSE 'C' || p_size END AS kg_clause_id,
          'Clause ' || p_size AS kg_clause_title,
          p_size || '.1' AS clause_no,
          CASE l_linenumber WHEN 1 THEN 'standard_execution' WHEN 2 THEN 'standard_missing'
            WHEN 3 THEN 'standard_lagging' WHEN 4 THEN 'manual_review' ELSE '' END AS kg_relation_type,
          0.3e0 + 0.7e0 * l_quantity / 50 AS kg_relation_confidence,
          CASE WHEN l_linestatus = 'O' THEN 'TRUE' WHEN l_linenumber = 1 THEN '标准冲突'
            WHEN l_linenumber = 2 THEN '需人工判断' ELSE 'no' END AS revision_demand,
          CASE l_linenumber WHEN 1 THEN '执行落实问题' WHEN 2 THEN '标准缺失' WHEN 3 THEN '适用性不足'
            WHEN 4 THEN '需人工判断' WHEN 5 THEN '标准冲突' ELSE NULL END AS revision_need_type,
          CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity * 2 AS STRING) || '%'
            WHEN l_linenumber = 6 THEN 'n/a' ELSE CAST(l_quantity / 50 AS STRING) END AS standard_revision_priority_score,
          l_linenumber - 1 AS repeat_count
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
    """,
    # Documents as free-text issues.
    "doc_issues": """
        SELECT
          d.doc_id AS row_pos,
          'D' || d.doc_id AS sample_id,
          d.text AS text,
          CASE d.lang WHEN 'en' THEN '一般' WHEN 'fr' THEN '较大' WHEN 'de' THEN '重大' ELSE '未知' END AS label,
          CASE d.doc_id % 4 WHEN 3 THEN '' WHEN 2 THEN 'nan' ELSE d.source || ' unit' END AS device_type,
          CASE WHEN d.doc_id % 4 = 2 THEN d.source || ' rule' ELSE NULL END AS rule_name,
          d.lang AS specialty,
          d.source AS source_unit,
          CASE d.doc_id % 5 WHEN 0 THEN '设备采购' WHEN 1 THEN '现场设备安装阶段' WHEN 2 THEN '竣工验收'
            WHEN 3 THEN 'other' ELSE ' ' END AS supervision_stage,
          CASE d.doc_id % 3 WHEN 0 THEN '设备调试' WHEN 1 THEN 'x' ELSE NULL END AS problem_stage,
          CASE d.doc_id % 11 WHEN 0 THEN '现场安装' ELSE d.lang END AS problem_reason,
          b.text AS checkpoint_text,
          CASE WHEN d.doc_id % 6 = 0 THEN 'see ' || d.source ELSE NULL END AS supervision_opinion,
          CASE WHEN d.doc_id % 9 = 0 THEN 'done' ELSE '' END AS actual_fix,
          CASE d.doc_id % 4 WHEN 0 THEN '资料与标识' WHEN 1 THEN '设计与选型' WHEN 2 THEN '安装与施工' ELSE '' END AS pred_category,
          CASE l.toxic WHEN 1 THEN '高' WHEN 0 THEN '中' ELSE NULL END AS priority_label,
          CASE WHEN l.quality = 1 THEN 0.9e0 ELSE 0 END AS priority_score,
          l.quality AS quality,
          l.toxic AS toxic
        FROM documents d
        LEFT JOIN labels l ON d.doc_id = l.doc_id
        LEFT JOIN benchmark b ON d.doc_id = b.item_id * 25
    """,
    # Documents as the raw issue table, before any cleaning.
    "raw_issues": """
        SELECT
          doc_id AS row_pos,
          lang AS `工程性质`,
          source AS `设备名称`,
          'none' AS `电压等级`,
          '  ' || lang || '   ' || source || ' ' AS `设备型号`,
          'A' || doc_id AS `实物ID`,
          lang AS `设备类型`,
          CASE doc_id % 11 WHEN 0 THEN '现场安装' ELSE '未知' END AS `问题原因`,
          CASE doc_id % 3 WHEN 0 THEN '2024/3/' || (doc_id % 28 + 1) WHEN 1 THEN 'soon' ELSE NULL END AS `发现时间`,
          CASE doc_id % 3 WHEN 0 THEN '设备调试' ELSE 'NULL' END AS `问题产生阶段`,
          lang AS `问题产生环节`,
          'x' AS `细则问题等级`,
          CASE lang WHEN 'en' THEN ' 一般' WHEN 'fr' THEN '较大' WHEN 'de' THEN '重大' ELSE '轻微' END AS `问题等级`,
          text AS `问题描述`,
          'y' AS `是否质量问题`,
          lang AS `监督专业`,
          text AS `问题原因分析`,
          '' AS `监督意见`,
          '20240' || (doc_id % 9 + 1) || '11' AS `处理时间`,
          'fix' AS `实际整改措施`,
          source AS `细则名称`,
          's' AS `阶段名称`,
          's' AS `所属环节`,
          '1' AS `条款序号`,
          '2' AS `监督要点序号`,
          'nan' AS `监督要点`
        FROM documents
    """,
    # Suppliers as standards, benchmark passages as their clauses.
    "standards": """
        SELECT
          s_suppkey AS pos,
          'STD-' || s_suppkey AS standard_id,
          s_name AS standard_name,
          CASE WHEN s_suppkey % 5 = 0 THEN 'null' ELSE 'No.' || s_nationkey END AS standard_no,
          CASE s_suppkey % 4 WHEN 0 THEN '现行' WHEN 1 THEN '在运' WHEN 2 THEN '待修订' ELSE '废止' END AS standard_status,
          n_name AS domain,
          'src' || (s_suppkey % 20) AS equipment_type,
          CASE s_suppkey % 3 WHEN 0 THEN '重大' WHEN 1 THEN '较大' ELSE '一般' END AS risk_level
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
    "clauses": """
        SELECT
          item_id AS pos,
          CASE WHEN item_id % 9 = 8 THEN '' ELSE 'CL-' || item_id END AS clause_id,
          'STD-' || (item_id * 3) AS standard_id,
          CAST(floor(item_id / 10) AS BIGINT) || '.' || (item_id % 10) AS clause_no,
          text AS clause_text,
          regexp_extract_all(text, '[A-Za-z]{8,}', 0) AS keywords,
          CASE WHEN item_id % 5 = 0 THEN '' ELSE 'src' || (item_id % 20) END AS equipment_type,
          CASE item_id % 3 WHEN 0 THEN '资料与标识' WHEN 1 THEN '设计与选型' ELSE '' END AS problem_category,
          CASE item_id % 4 WHEN 0 THEN '采购制造' ELSE '' END AS stage
        FROM benchmark
    """,
    # Parts, brands, types, suppliers and order priorities as a property graph.
    "graph_nodes": """
        SELECT p_partkey AS pos, 'P' || p_partkey AS id, '监督要点' AS node_type, p_name AS label,
          CASE WHEN p_partkey % 2 = 0 THEN p_name || ' ' || p_type ELSE '' END AS full_text,
          p_type AS equipment,
          CASE p_partkey % 3 WHEN 0 THEN 'Ref ' || p_brand WHEN 1 THEN 'Std Supplier#000000002' ELSE '' END AS reference,
          CASE p_size % 3 WHEN 0 THEN '设备采购' WHEN 1 THEN '某设备验收期' ELSE 'x' END AS stage,
          '' AS full_reference
        FROM part
        UNION ALL
        SELECT -1 AS pos, 'B' || p_brand, '监督项目', p_brand, '', '', '', '', ''
        FROM part GROUP BY p_brand
        UNION ALL
        SELECT -1 AS pos, 'T' || p_type, '问题分级', p_type, '', '', '', '', ''
        FROM part GROUP BY p_type
        UNION ALL
        SELECT -1 AS pos, 'E' || p_type, '设备类型', p_type, '', '', '', '', ''
        FROM part GROUP BY p_type
        UNION ALL
        SELECT -1 AS pos, 'S' || s_suppkey, '标准文件', s_name, '', '', '', '',
          CASE WHEN s_suppkey % 2 = 0 THEN 'Std ' || s_name ELSE 'nan' END
        FROM supplier
        UNION ALL
        SELECT -1 AS pos, 'R' || o_orderpriority, '监督要求', o_orderpriority, '', '', '', '', ''
        FROM orders GROUP BY o_orderpriority
    """,
    "graph_links": """
        SELECT (CAST(l_orderkey AS BIGINT) * 8 + l_linenumber) * 10 AS pos,
          'P' || l_partkey AS source, 'S' || l_suppkey AS target, 'GOVERNED_BY' AS edge_type
        FROM lineitem
        UNION ALL
        SELECT (CAST(l_orderkey AS BIGINT) * 8 + l_linenumber) * 10 + 1,
          'P' || l_partkey, 'R' || o_orderpriority, 'HAS_REQUIREMENT'
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        UNION ALL
        SELECT p_partkey, 'B' || p_brand, 'P' || p_partkey, 'HAS_POINT' FROM part
        UNION ALL
        SELECT p_partkey * 2, 'P' || p_partkey, 'T' || p_type, 'HAS_SEVERITY' FROM part
        UNION ALL
        SELECT p_partkey * 2 + 1, 'P' || p_partkey, 'TSTANDARD', 'HAS_SEVERITY' FROM part WHERE p_partkey % 5 = 0
        UNION ALL
        SELECT 0, '', 'P' || p_partkey, 'HAS_POINT' FROM part WHERE p_partkey % 7 = 0
    """,
    # Reviewed predictions, some ids twice.
    "reviews": """
        SELECT 'D' || doc_id AS sample_id, doc_id * 2 AS review_no,
          CASE toxic WHEN 1 THEN 'Corrected' ELSE 'accepted' END AS review_status,
          CASE WHEN doc_id % 7 = 0 THEN ' ' ELSE 'q' || quality END AS reviewed_label
        FROM labels
        UNION ALL
        SELECT 'D' || doc_id, doc_id * 2 + 1,
          CASE WHEN doc_id % 2 = 0 THEN 'corrected' ELSE 'pending' END,
          CASE toxic WHEN 1 THEN 'toxic' ELSE 'clean' END
        FROM labels WHERE doc_id % 3 = 0
    """,
    # Labels next to a rule's guess.
    "guesses": """
        SELECT l.doc_id AS doc_id,
          CASE l.quality WHEN 1 THEN 'good' ELSE 'bad' END AS label,
          CASE WHEN d.n_chars > 400 THEN 'good' WHEN d.lang = 'es' THEN 'other' ELSE 'bad' END AS predicted_label,
          l.quality AS quality,
          l.toxic AS toxic,
          (d.n_chars - 800) / 1000.0e0 AS good_logit,
          CASE WHEN d.lang = 'en' THEN 0.4e0 ELSE -1.5e0 END AS toxic_logit
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id
    """,
}


@cache
def sources_of(name: str) -> tuple[str, ...]:
    return tuple(t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", VIEWS[name]))


def view(spark: SparkSession, sf_dir: str, name: str, keys: Mapping[str, str] = MappingProxyType({})) -> DataFrame:
    """A view over the tables of a folder; ``keys`` names what facts are dealt out by, if they are."""
    frames = {t: table(spark, sf_dir, t, keys.get(t)) for t in sources_of(name)}
    text = VIEWS[name].replace("{", "{{").replace("}", "}}")
    for t in frames:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **frames)


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, key) if name in FACTS else df


def sql_of(name: str) -> str:
    """The view for engines that quote identifiers with double quotes."""
    return VIEWS[name].replace("`", '"')
