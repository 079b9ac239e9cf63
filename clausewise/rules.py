"""Default rules as plain data.

Every job takes its rules as an argument; these are the defaults.  They are
fixed values: word lists, score maps, weights, thresholds, column names and
sentences that results have to agree on.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

# ---------------------------------------------------------------- fixed values
# Emptiness and coercion words.

EMPTY_WORDS = ["nan", "none", "null"]
UNKNOWN = "未知"
FLAG_WORDS = ["true", "1", "yes", "y"]
DEMAND_WORDS = ["true", "1", "yes", "y", "是", "需", "需要", "命中", "有", "疑似", "true。"]
DEMAND_PARTS = ["需人工", "需复核", "标准缺失", "歧义", "冲突", "适用性不足"]
HIGH_SEVERITY_WORDS = ["重大", "严重", "高"]
MEDIUM_SEVERITY_WORDS = ["较大", "中高", "中"]
MAJOR_LEVELS = ["重大", "较大"]
LEVELS = ["一般", "较大", "重大"]

# ---------------------------------------------------------------- fixed values
# Raw issue table: source column -> canonical column.

RAW_COLUMNS = {
    "工程性质": "project_type",
    "设备名称": "device_name",
    "电压等级": "voltage_level",
    "设备型号": "device_model",
    "实物ID": "asset_id",
    "设备类型": "device_type",
    "问题原因": "problem_reason",
    "发现时间": "event_time",
    "问题产生阶段": "problem_stage",
    "问题产生环节": "supervision_stage",
    "细则问题等级": "rule_level",
    "问题等级": "label",
    "问题描述": "text",
    "是否质量问题": "is_quality_issue",
    "监督专业": "specialty",
    "问题原因分析": "root_cause_analysis",
    "监督意见": "supervision_opinion",
    "处理时间": "resolved_time",
    "实际整改措施": "actual_fix",
    "细则名称": "rule_name",
    "阶段名称": "stage_name",
    "所属环节": "stage_link",
    "条款序号": "clause_no",
    "监督要点序号": "checkpoint_no",
    "监督要点": "checkpoint_text",
}
DATE_COLUMNS = ["event_time", "resolved_time"]
REPEAT_KEYS = ["text", "label", "device_type", "specialty", "supervision_stage"]
DATA_SOURCE = "pytest_processed_1_real"
ID_PREFIX = "real_v1_"
CATEGORY_TAG = "problem_category_rule_v1"
REVIEWED_TAG = "feedback_reviewed"

# Date spellings accepted by the cleaner; those of the same shape are tried in this order.
DATE_FORMATS = [
    "yyyy-M-d",
    "yyyy/M/d",
    "yyyy.M.d",
    "yyyyMMdd",
    "M/d/yyyy",
    "yyyy-M-d H:mm:ss",
    "yyyy/M/d H:mm:ss",
    "yyyy-M-d H:mm",
    "yyyy/M/d H:mm",
    "yyyy-M-d'T'H:mm:ss",
    "yyyy-M",
    "yyyyMMddHHmmss",
    "yyyyMMdd H:mm:ss",
    "M-d-yyyy",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "MMM d, yyyy",
    "MMM d yyyy",
    "d MMM yyyy",
    "d-MMM-yyyy",
    "MMM yyyy",
    "yyyy MMM d",
    "MMM d, yyyy H:mm:ss",
    "d MMM yyyy H:mm:ss",
    "M/d/yyyy h:mm a",
    "M/d/yyyy h:mm:ss a",
    "yyyy-M-d h:mm a",
    "yyyy-M-d h:mm:ss a",
    "yyyy/M/d h:mm:ss a",
]
# No date is written in more characters.
DATE_CHARS = 80
# What is taken off a date before the formats are tried.
DATE_TAIL = r"(?i)([0-9]:[0-9]{2}(?::[0-9]{2})?)(?:[.,][0-9]+)? *(?:z|utc|gmt|[+-][0-9]{2}:?[0-9]{2})?$"
DATE_WEEKDAY = r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +"
DATE_ORDINAL = r"(?i)\b([0-9]{1,2})(?:st|nd|rd|th)\b"
DATE_MONTH = r"(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"

# ---------------------------------------------------------------- fixed values
# Text normalisation.

FULL_WIDTH_MARKS = "，。；：（）【】"
ASCII_MARKS = ",.;:()[]"

# ---------------------------------------------------------------- fixed values
# Category rules: first rule with a true test wins.  A test holds when its
# field (if any) has one of the values and its words (if any) occur in the
# joined text.

CATEGORY_TEXT_FIELDS = [
    "text",
    "problem_reason",
    "problem_stage",
    "supervision_stage",
    "rule_name",
    "checkpoint_text",
]
CATEGORY_RULES = [
    {
        "category": "资料与标识",
        "tests": [
            {"words": ["台账", "记录", "报告", "标识", "标牌", "铭牌", "签字", "签名", "编号", "归档", "资料", "文档"]},
        ],
    },
    {
        "category": "设计与选型",
        "tests": [
            {"field": "problem_reason", "values": ["工程设计", "工程规划", "设备选型"]},
            {"field": "problem_stage", "values": ["工程设计", "规划可研"]},
            {"field": "supervision_stage", "values": ["工程设计", "规划可研"]},
            {"words": ["设计图纸", "选型", "布置", "容量配置", "设计不合理"]},
        ],
    },
    {
        "category": "采购与制造",
        "tests": [
            {"field": "problem_reason", "values": ["设备制造工艺", "设备材质", "出厂试验"]},
            {"field": "problem_stage", "values": ["设备制造", "设备采购"]},
            {"field": "supervision_stage", "values": ["设备采购"]},
            {"words": ["出厂", "材质", "加工工艺", "采购技术协议", "制造"]},
        ],
    },
    {
        "category": "运维与环境",
        "tests": [
            {"field": "problem_reason", "values": ["设备运维", "运行环境"]},
            {"words": ["渗漏", "温升", "腐蚀", "噪声", "振动", "环境", "通风", "消防"]},
        ],
    },
    {
        "category": "验收与交接",
        "tests": [
            {"field": "problem_stage", "values": ["设备验收", "竣工验收"]},
            {"field": "supervision_stage", "values": ["竣工验收"]},
            {"words": ["交接试验", "启动验收", "投运前验收", "验收移交"]},
        ],
    },
    {
        "category": "安装与施工",
        "tests": [
            {"field": "problem_reason", "values": ["现场安装"]},
            {"field": "problem_stage", "values": ["设备安装"]},
            {
                "field": "supervision_stage",
                "values": ["安装调试"],
                "words": [
                    "接线", "接地", "封堵", "螺栓", "焊接", "支架", "基础", "敷设",
                    "相序", "防火封堵", "端子", "电缆", "安装偏差",
                ],
            },
            {"words": ["施工", "孔洞封堵", "电缆敷设", "螺栓松动", "焊缝", "二次接线"]},
        ],
    },
    {
        "category": "调试与试验",
        "tests": [
            {"field": "problem_reason", "values": ["设备调试"]},
            {"field": "problem_stage", "values": ["设备调试"]},
            {"words": ["调试", "试验", "校验", "联调", "定值", "二次回路", "保护动作", "绝缘电阻", "耐压", "局放"]},
        ],
    },
    {"category": "验收与交接", "tests": [{"words": ["验收", "投运前", "交接"]}]},
]
CATEGORY_DEFAULT = "安装与施工"
CATEGORIES = ["设计与选型", "采购与制造", "安装与施工", "调试与试验", "验收与交接", "资料与标识", "运维与环境"]

# ---------------------------------------------------------------- fixed values
# Stage names; the order decides which alias inside a longer name wins.

STAGE_ALIASES = {
    "设备采购": "采购制造",
    "设备制造": "采购制造",
    "采购与制造": "采购制造",
    "采购制造": "采购制造",
    "设备安装": "安装调试",
    "设备调试": "安装调试",
    "安装调试": "安装调试",
    "工程设计": "工程设计",
    "规划可研": "规划可研",
    "设备验收": "竣工验收",
    "竣工验收": "竣工验收",
    "验收与交接": "竣工验收",
    "设备运维": "运维检修",
    "运维检修": "运维检修",
}

# ---------------------------------------------------------------- fixed values
# Issue priority.

PRIORITY_RULES = {
    "weights": {
        "level_score": 0.40,
        "device_score": 0.25,
        "category_score": 0.20,
        "repeat_score": 0.10,
        "confidence_score": 0.05,
    },
    "level_scores": {"重大": 1.0, "较大": 0.7, "一般": 0.4, "未知": 0.3},
    "device_scores": [
        {"keywords": ["变压器", "主变", "组合电器", "断路器", "隔离开关"], "score": 1.0},
        {"keywords": ["母线", "电缆", "继电保护", "避雷器"], "score": 0.8},
    ],
    "device_default_score": 0.5,
    "category_scores": {
        "调试与试验": 0.9,
        "安装与施工": 0.8,
        "采购与制造": 0.75,
        "设计与选型": 0.7,
        "验收与交接": 0.65,
        "运维与环境": 0.6,
        "资料与标识": 0.4,
        "未知": 0.3,
    },
    "confidence_default": 0.5,
    "repeat_thresholds": {
        "high": 3,
        "medium": 1,
        "high_score": 1.0,
        "medium_score": 0.7,
        "default_score": 0.4,
    },
    "label_thresholds": {"high": 0.80, "medium": 0.60},
}
DEVICE_DEFAULT = "其他设备"
REVIEW_THRESHOLD = 0.75

# ---------------------------------------------------------------- fixed values
# Advice per category.

SUGGESTION_RULES = {
    "category_rules": {
        "设计与选型": {
            "suggestion": "建议复核设计依据、设备选型参数、标准适用性和现场工况匹配性。",
            "basis": "该问题属于设计与选型类，通常与前期设计输入、技术参数和标准适用性有关。",
            "action": "组织设计、建设和运维相关人员联合复核设计文件，并形成修订建议。",
        },
        "采购与制造": {
            "suggestion": "建议核查采购技术协议、出厂试验记录、制造质量证明文件和到货验收记录。",
            "basis": "该问题属于采购与制造类，重点风险集中在技术协议兑现和制造质量一致性。",
            "action": "核对采购技术协议和质保文件，必要时要求厂家补充说明或重新提供证明材料。",
        },
        "安装与施工": {
            "suggestion": "建议复核施工工艺、安装记录、隐蔽工程记录和现场复验结果。",
            "basis": "该问题属于安装与施工类，通常与施工过程控制和现场记录完整性有关。",
            "action": "组织现场复查，核验施工工艺执行情况，并补齐关键安装记录。",
        },
        "调试与试验": {
            "suggestion": "建议核查试验项目完整性、试验数据有效性、试验标准依据和缺项补试安排。",
            "basis": "该问题属于调试与试验类，通常直接影响设备投运前的状态判断。",
            "action": "梳理试验项目清单，尽快完成缺项补试并复核试验依据。",
        },
        "验收与交接": {
            "suggestion": "建议核查验收资料完整性、交接手续、遗留问题闭环和责任单位确认情况。",
            "basis": "该问题属于验收与交接类，重点在于资料闭环和责任边界是否明确。",
            "action": "补齐验收交接资料，明确责任单位和问题闭环时限。",
        },
        "资料与标识": {
            "suggestion": "建议补充资料归档、统一设备编号、完善标识标牌和台账一致性校验。",
            "basis": "该问题属于资料与标识类，通常影响后续运维和追溯管理。",
            "action": "开展资料归档和标识专项核查，统一编号规则并校验台账一致性。",
        },
        "运维与环境": {
            "suggestion": "建议核查运行环境、巡视记录、缺陷处理记录和运维责任落实情况。",
            "basis": "该问题属于运维与环境类，通常反映运行管理或环境约束未被充分控制。",
            "action": "结合现场巡视与缺陷记录开展复查，明确运维责任并跟踪整改。",
        },
        "未知": {
            "suggestion": "建议结合问题描述补充上下文信息，再进一步判断整改方向。",
            "basis": "当前问题类别信息不足，建议先补全业务上下文。",
            "action": "补充设备、环节和责任单位信息后，再组织针对性分析。",
        },
    },
    "high_priority_action": "建议纳入重点督办清单，并要求责任单位限期反馈整改结果。",
    "need_review_action": "该样本模型置信度不足，建议人工复核后再进入正式统计。",
}

# ---------------------------------------------------------------- fixed values
# Matching weights and floors.

MATCH_RULES = {
    "weights": {
        "checkpoint": 0.34,
        "issue": 0.26,
        "keywords": 0.14,
        "category": 0.08,
        "opinion": 0.06,
        "rule": 0.05,
        "stage": 0.04,
        "severity": 0.03,
    },
    "contained_score": 0.95,
    "gram_weight": 0.75,
    "term_weight": 0.25,
    "checkpoint_floor": 0.92,
    "checkpoint_reason": "监督要点文本直接命中",
    "keyword_floor_base": 0.62,
    "keyword_floor_step": 0.05,
    "keyword_floor_top": 0.85,
    "keyword_floor_category": 0.8,
}
TOP_K = 3
MIN_SCORE = 0.18
LABEL_CHARS = 80
TITLE_CHARS = 40
EVIDENCE_CHARS = 120

# ---------------------------------------------------------------- fixed values
# Revision need: first rule whose tests hold wins.  "any" needs one of the
# words, "all" needs every word, "status" looks at the matched standard.

REVISION_TEXT_FIELDS = [
    "text",
    "问题描述",
    "problem_text",
    "supervision_opinion",
    "actual_fix",
    "root_cause_analysis",
    "checkpoint_text",
    "pred_category",
    "predicted_category",
    "预测问题类别",
]
REVISION_RULES = [
    {
        "need": "标准缺失",
        "needed": True,
        "tests": [
            {"any": ["标准缺失", "无标准", "没有标准", "无依据", "缺少依据", "未规定"]},
            {"all": ["标准"], "any": ["缺少", "未覆盖"]},
        ],
        "reason": "问题描述或整改意见出现标准缺失/依据不足信号。",
    },
    {
        "need": "标准冲突",
        "needed": True,
        "tests": [{"any": ["冲突", "矛盾", "不一致", "交叉", "重复规定"]}],
        "reason": "问题描述或整改意见出现标准冲突/交叉不一致信号。",
    },
    {
        "need": "标准表述歧义",
        "needed": True,
        "tests": [{"any": ["歧义", "不明确", "不清晰", "理解偏差", "表述", "边界不清"]}],
        "reason": "问题描述或整改意见出现标准表述不清或理解偏差信号。",
    },
    {
        "need": "适用性不足",
        "needed": True,
        "tests": [{"any": ["不适用", "适用性", "现场实际", "特殊地区", "工况", "图纸修改", "选型"]}],
        "reason": "问题与现场工况、设计选型或标准适用性相关，建议复核标准适用范围。",
    },
    {
        "need": "适用性不足",
        "needed": True,
        "tests": [{"status": ["待修订", "废止"]}],
        "reason": "关联标准状态为{status}，需复核当前条款适用性。",
    },
    {
        "need": "执行落实问题",
        "needed": False,
        "tests": [{"any": ["未按", "未见", "未进行", "未采用", "不符合", "不到位", "漏", "错位"]}],
        "reason": "问题更偏向标准或监督要求执行不到位，优先纳入整改闭环。",
    },
]
REVISION_UNMATCHED = {
    "need": "需人工判断",
    "reason": "未能稳定关联到课题二图谱标准条款，建议人工判断是否形成修订需求。",
}
REVISION_OTHERWISE = {
    "need": "需人工判断",
    "reason": "当前规则未发现明确修订信号，建议结合人工复核确认。",
}
REVISION_EVIDENCE = " 关联标准依据："
LAGGING_STATUSES = ["待修订", "废止"]
REVISION_PRIORITY_RULES = {
    "weights": {"issue": 0.48, "need": 0.24, "match": 0.18, "level": 0.10},
    "label_scores": {"高": 0.85, "中": 0.62, "低": 0.35},
    "label_default": 0.45,
    "level_scores": {"重大": 1.0, "较大": 0.72, "一般": 0.42},
    "level_default": 0.35,
    "lagging_floor": 0.76,
    "label_thresholds": {"high": 0.75, "medium": 0.55},
}
RELATION_OF_NEED = {
    "标准缺失": "standard_missing",
    "标准表述歧义": "standard_ambiguous",
    "标准冲突": "standard_conflict",
    "适用性不足": "standard_lagging",
    "执行落实问题": "standard_execution",
}
REPORT_WEIGHTS = {
    "count": 0.24,
    "need": 0.22,
    "max_priority": 0.20,
    "avg_priority": 0.16,
    "major": 0.10,
    "match": 0.08,
}
REPORT_FULL_COUNT = 5
REPORT_REVISION_SHARE = 0.8
REPORT_EXAMPLES = 5

# ---------------------------------------------------------------- fixed values
# Clause ranking.

RANKING_WEIGHTS = {
    "frequency": 0.25,
    "severity": 0.25,
    "demand": 0.20,
    "confidence": 0.15,
    "coverage": 0.10,
    "existing": 0.05,
    "uncertainty": 0.10,
}
COVERAGE_FULL = {"device_type": 3, "major": 3, "organization": 5, "region": 5}
LOW_CONFIDENCE = 0.6
STATUS_SCORES = {"待修订": 1.0, "废止": 0.8, "现行": 0.45, "在运": 0.45}
RELATION_SCORES = {
    "standard_missing": 1.0,
    "standard_lagging": 0.9,
    "standard_conflict": 0.85,
    "standard_ambiguous": 0.8,
    "manual_review": 0.45,
    "standard_execution": 0.3,
}
NEED_SCORES = {
    "标准缺失": 1.0,
    "适用性不足": 0.9,
    "标准冲突": 0.85,
    "标准表述歧义": 0.8,
    "需人工判断": 0.45,
    "执行落实问题": 0.25,
}
CONTEXT_WEIGHTS = {"status": 0.35, "relation": 0.35, "need": 0.30}
RANKING_LEVELS = [(80, "高优先级"), (60, "中高优先级"), (40, "中优先级")]
RANKING_LEVEL_OTHER = "低优先级"
CERTAIN_DEMANDS = ["标准缺失", "标准表述歧义", "标准冲突", "适用性不足"]
RANKING_PHRASES = {
    "lead": "该标准/条款",
    "count_many": "关联问题数量较多",
    "count_some": "存在多条关联问题",
    "count_few": "当前关联问题数量较少",
    "high_share": "高严重问题占比较高",
    "high_some": "包含高严重问题",
    "medium_some": "包含中高严重问题",
    "demand_many": "多条问题被识别为标准制修订需求",
    "demand_some": "存在标准制修订需求",
    "demand_none": "暂未集中命中标准制修订需求",
    "confidence_high": "图谱关联置信度较高",
    "confidence_some": "图谱关联置信度一般",
    "coverage": "涉及设备、专业或单位地区范围较广",
    "uncertain": "但低置信度或需人工复核样本较多，建议专家复核后再定稿",
    "advice_now": "建议优先纳入标准修订需求池。",
    "advice_later": "可作为后续标准修订储备项持续观察。",
}

# ---------------------------------------------------------------- fixed values
# Field aliases of linked issues; the first filled one counts.

FIELD_ALIASES = {
    "problem_id": ["problem_id", "sample_id", "issue_id", "id"],
    "problem_text": ["问题描述", "problem_text", "text", "issue_text", "supervision_opinion"],
    "device_type": ["设备类型", "device_type"],
    "major": ["监督专业", "major", "specialty"],
    "organization": ["所属单位", "organization", "source_unit", "unit"],
    "region": ["地区", "region", "area"],
    "predicted_category": ["predicted_category", "pred_category", "issue_category", "category"],
    "predicted_severity": ["predicted_severity", "pred_level", "issue_level", "severity", "label"],
    "category_confidence": ["category_confidence", "pred_category_confidence"],
    "severity_confidence": ["severity_confidence", "level_confidence", "confidence"],
    "need_review": ["need_review", "need_manual_review"],
    "review_reason": ["review_reason"],
    "kg_standard_id": ["kg_standard_id", "standard_id", "related_standard_id"],
    "kg_standard_name": ["kg_standard_name", "standard_name", "related_standard_name"],
    "standard_no": ["standard_no", "related_standard_no"],
    "standard_status": ["standard_status"],
    "kg_standard_refs": ["kg_standard_refs", "standard_ref", "standard_refs"],
    "kg_clause_id": ["kg_clause_id", "clause_id", "related_clause_id"],
    "kg_clause_title": ["kg_clause_title", "clause_title", "related_clause_text"],
    "clause_no": ["clause_no", "related_clause_no"],
    "kg_relation_type": ["kg_relation_type", "problem_standard_relation_type"],
    "kg_relation_confidence": [
        "kg_relation_confidence", "kg_match_score", "relation_confidence", "standard_match_confidence",
    ],
    "revision_demand": ["revision_demand", "revision_need"],
    "revision_need_type": ["revision_need_type"],
    "standard_revision_priority": ["standard_revision_priority", "revision_priority_label"],
    "standard_revision_priority_score": [
        "standard_revision_priority_score", "revision_priority_score", "priority_score",
    ],
    "standard_revision_priority_reason": ["standard_revision_priority_reason", "revision_reason"],
}
REQUIRED_FIELDS = [
    "problem_id",
    "problem_text",
    "device_type",
    "major",
    "organization",
    "region",
    "predicted_severity",
    "category_confidence",
    "severity_confidence",
    "need_review",
    "kg_standard_id",
    "kg_standard_name",
    "kg_clause_id",
    "kg_clause_title",
    "kg_relation_confidence",
    "revision_demand",
    "standard_revision_priority_score",
]

# ---------------------------------------------------------------- fixed values
# Field order used when linking issues to clauses.

LINK_ALIASES = {
    "text": ["text", "问题描述", "problem_text", "issue_text"],
    "category": ["pred_category", "predicted_category", "预测问题类别", "problem_category"],
    "level": ["pred_level", "predicted_severity", "预测严重程度", "rule_level", "label", "problem_level"],
    "stage": ["stage_name", "supervision_stage", "监督环节", "problem_stage"],
    "issue_id": ["problem_id", "sample_id", "issue_id"],
}
EQUIPMENT_FIELDS = ["device_type", "设备类型", "equipment_type", "rule_name", "text", "问题描述"]
OPINION_FIELDS = ["supervision_opinion", "actual_fix"]
POINT_NODE = "监督要点"
EQUIPMENT_NODE = "设备类型"

# ---------------------------------------------------------------- fixed values
# Values a linked table may hold.

VALID_RELATIONS = [
    "standard_execution", "standard_missing", "standard_lagging", "standard_ambiguous",
    "standard_conflict", "manual_review", "unmatched",
]
VALID_NEEDS = ["执行落实问题", "标准缺失", "标准表述歧义", "标准冲突", "适用性不足", "需人工判断"]
VALID_PRIORITIES = ["high", "medium", "low", "高", "中", "低"]
VALID_GRAPH_RELATIONS = ["PROBLEM_MATCHES_CLAUSE", "UNMATCHED", ""]
LINKED_FIELDS = [
    "related_standard_name",
    "related_clause_text",
    "standard_match_confidence",
    "problem_standard_relation_type",
    "revision_need_type",
    "standard_revision_priority_initial",
    "graph_relation_type",
]

# ---------------------------------------------------------------- fixed values
# Review sheet: columns in order with their display names.

REVIEW_COLUMNS = {
    "sample_id": "样本编号",
    "need_manual_review": "是否建议人工复核",
    "need_review": "是否进入复核流程",
    "confidence": "等级模型置信度",
    "predicted_label": "原始预测标签",
    "pred_level": "预测问题等级",
    "pred_category": "预测问题类别",
    "level_confidence": "问题等级置信度",
    "category_confidence": "问题类别置信度",
    "priority_score": "优先级得分",
    "priority_label": "优先级标签",
    "priority_reason": "优先级判定原因",
    "suggestion": "优化建议",
    "suggested_basis": "建议依据",
    "suggestion_basis": "建议依据",
    "recommended_action": "建议动作",
    "kg_match_status": "图谱匹配状态",
    "kg_match_score": "图谱匹配得分",
    "kg_point_id": "关联监督要点ID",
    "kg_point_text": "关联监督要点",
    "kg_project": "关联监督项目",
    "kg_stage": "关联技术阶段",
    "kg_severity": "图谱问题分级",
    "kg_standard_refs": "关联标准依据",
    "kg_requirement_texts": "关联监督要求",
    "revision_need": "是否疑似修订需求",
    "revision_need_type": "修订需求类型",
    "revision_priority_score": "修订优先级得分",
    "revision_priority_label": "修订优先级标签",
    "revision_reason": "修订需求判定原因",
    "final_label": "当前最终标签",
    "label": "原始标签",
    "review_status": "复核状态",
    "reviewed_label": "人工确认标签",
    "review_comment": "复核备注",
    "feedback_time": "复核时间",
    "text": "问题文本",
    "device_type": "设备类型",
    "specialty": "监督专业",
    "supervision_stage": "监督环节",
    "problem_stage": "问题阶段",
    "problem_reason": "问题原因",
    "rule_name": "细则名称",
    "checkpoint_text": "监督要点",
    "supervision_opinion": "监督意见",
    "actual_fix": "实际整改措施",
    "event_time": "发现时间",
    "data_source": "数据来源",
    "model_version": "模型版本",
    "prediction_time": "预测时间",
}
SUMMARY_NAMES = {
    "total_rows": "样本总数",
    "need_manual_review_true": "建议人工复核数量",
    "need_manual_review_false": "无需人工复核数量",
    "need_review_true": "进入复核流程数量",
    "review_status_pending": "待复核数量",
    "priority_": "优先级数量",
    "high_priority_and_need_review": "高优先级且需复核数量",
    "revision_need_true": "疑似标准修订需求数量",
    "revision": "修订需求类型::",
    "kg_match": "图谱匹配状态::",
    "category": "问题类别::",
    "level": "问题等级::",
}
PRIORITY_LABELS = ["高", "中", "低"]
# ------------------------------------------------------------ end fixed values


def merged(defaults: Mapping[str, Any], overrides: Mapping[str, Any] | None) -> dict[str, Any]:
    """Defaults with overrides laid on top: maps merge key by key, all else is replaced."""
    out = dict(defaults)
    for key, value in (overrides or {}).items():
        both_maps = isinstance(value, Mapping) and isinstance(out.get(key), Mapping)
        out[key] = merged(out[key], value) if both_maps else value
    return out
