"""Small inputs with results known from the rules.  Fixed values."""

STANDARDS = [
    ("STD-GIS-001", "组合电器安装与接地监督标准", "Q/GDW-SAMPLE-001", "现行", "电气设备", "组合电器", "较大"),
    ("STD-TRANS-002", "主变压器施工质量监督标准", "Q/GDW-SAMPLE-002", "在运", "变电施工", "主变压器", "重大"),
    ("STD-ACCEPT-003", "电力工程验收整改闭环管理标准", "Q/GDW-SAMPLE-003", "待修订", "验收整改", "通用设备", "较大"),
    ("STD-SAFE-004", "施工现场安全风险监督旧版标准", "Q/GDW-SAMPLE-004", "废止", "安全风险", "施工现场", "重大"),
]
STANDARD_SCHEMA = (
    "standard_id string, standard_name string, standard_no string, standard_status string, "
    "domain string, equipment_type string, risk_level string"
)
CLAUSES = [
    ("CLAUSE-GIS-001", "STD-GIS-001", "4.3.10", "GIS接地线应与接地母线采用螺栓连接方式，连接点应可靠防松并保留检查记录。", ["GIS", "接地线", "接地母线", "螺栓连接", "防松", "记录"], "组合电器", "施工质量"),
    ("CLAUSE-GIS-002", "STD-GIS-001", "5.2.4", "组合电器气室压力、密封状态和异常告警应在投运前完成核查，发现渗漏应完成整改。", ["组合电器", "气室", "压力", "密封", "告警", "渗漏"], "组合电器", "设备缺陷"),
    ("CLAUSE-TRANS-001", "STD-TRANS-002", "3.1.2", "主变压器安装前应检查套管、油位、冷却装置和本体密封，缺陷未闭环不得进入下一工序。", ["主变压器", "套管", "油位", "冷却装置", "密封", "缺陷闭环"], "主变压器", "设备缺陷"),
    ("CLAUSE-TRANS-002", "STD-TRANS-002", "6.4.1", "变压器交接试验项目应按批准方案完成，试验报告、数据复核和异常处置记录应齐全。", ["变压器", "交接试验", "试验报告", "数据复核", "异常处置"], "主变压器", "验收整改"),
    ("CLAUSE-ACCEPT-001", "STD-ACCEPT-003", "2.2.1", "验收发现的问题应明确责任单位、整改时限、复验结论和闭环证据，逾期未闭环应升级管控。", ["验收", "整改", "责任单位", "整改时限", "复验", "闭环证据", "逾期"], "通用设备", "验收整改"),
    ("CLAUSE-ACCEPT-002", "STD-ACCEPT-003", "2.4.3", "特殊工况、设计变更或现场条件变化导致原标准难以适用时，应形成标准适用性复核意见。", ["特殊工况", "设计变更", "现场条件", "适用性", "复核意见"], "通用设备", "验收整改"),
    ("CLAUSE-SAFE-001", "STD-SAFE-004", "7.1.1", "高处作业、临边作业和交叉施工应设置隔离、防坠落和现场监护措施。", ["高处作业", "临边", "交叉施工", "隔离", "防坠落", "监护"], "施工现场", "安全风险"),
    ("CLAUSE-SAFE-002", "STD-SAFE-004", "7.3.2", "动火、吊装和带电邻近作业应完成风险辨识、作业票审批和安全交底。", ["动火", "吊装", "带电邻近", "风险辨识", "作业票", "安全交底"], "施工现场", "安全风险"),
]
CLAUSE_SCHEMA = (
    "clause_id string, standard_id string, clause_no string, clause_text string, "
    "keywords array<string>, equipment_type string, problem_category string"
)
ISSUES = [
    (1, "SP-001", "GIS接地线未按要求与接地母线采用螺栓连接，现场缺少防松检查记录。", "组合电器", "电气设备性能", "安装调试", "施工质量", "重大", 0.91, 0.88),
    (2, "SP-002", "组合电器气室压力异常告警后未完成渗漏整改闭环。", "组合电器", "电气设备性能", "竣工验收", "设备缺陷", "较大", 0.86, 0.82),
    (3, "SP-003", "主变压器套管油位检查记录缺失，冷却装置密封缺陷未闭环。", "主变压器", "设备安装", "安装调试", "设备缺陷", "重大", 0.9, 0.87),
    (4, "SP-004", "变压器交接试验报告数据复核不完整，异常处置记录缺失。", "主变压器", "试验验收", "竣工验收", "验收整改", "较大", 0.84, 0.81),
    (5, "SP-005", "验收发现的问题未明确责任单位和整改时限，复验结论缺失。", "通用设备", "验收管理", "竣工验收", "验收整改", "一般", 0.79, 0.76),
    (6, "SP-006", "特殊工况下现场条件变化，现有标准适用性不明确，缺少复核意见。", "通用设备", "验收管理", "工程设计", "验收整改", "较大", 0.83, 0.8),
    (7, "SP-007", "临边高处作业未设置防坠落隔离措施，现场监护不到位。", "施工现场", "安全管理", "施工过程", "安全风险", "重大", 0.93, 0.9),
    (8, "SP-008", "吊装作业票审批缺失，动火作业安全交底记录不完整。", "施工现场", "安全管理", "施工过程", "安全风险", "较大", 0.88, 0.85),
    (9, "SP-009", "现场提出当前验收整改标准缺少数字化闭环证据格式要求。", "通用设备", "验收管理", "竣工验收", "验收整改", "一般", 0.77, 0.72),
    (10, "SP-010", "GIS接地检查条款与设计变更要求存在不一致，现场执行边界不清。", "组合电器", "工程设计", "工程设计", "施工质量", "较大", 0.74, 0.7),
]
ISSUE_SCHEMA = (
    "row_pos bigint, problem_id string, `问题描述` string, `设备类型` string, `监督专业` string, "
    "`监督环节` string, predicted_category string, predicted_severity string, "
    "category_confidence double, severity_confidence double"
)
MATCH_SCORES = [0.85, 0.85, 0.85, 0.85, 0.85, 0.82, 0.85, 0.82, 0.77, 0.67]
NEEDS = [
    "执行落实问题", "执行落实问题", "需人工判断", "需人工判断", "适用性不足",
    "标准缺失", "适用性不足", "适用性不足", "标准缺失", "标准冲突",
]
PRIORITIES = [0.469, 0.441, 0.469, 0.441, 0.76, 0.76, 0.76, 0.76, 0.76, 0.6486]
CLAUSE_SCORES = [66.24, 56.47, 55.79, 52.45, 44.26, 43.82, 34.17, 34.12]

LINKED = [
    (1, "D001", "GIS接地线未按条款要求采用螺栓连接", "组合电器", "电气设备性能", "单位A", "华东", "安装质量", "重大", 0.91, 0.88, False, "STD-GIS-001", "组合电器接地监督标准", "CLAUSE-GIS-4.3.10", "接地连接方式要求", "related_to_clause", 0.88, "True", 88.0),
    (2, "D002", "GIS接地母线连接记录缺失且整改措施不完整", "组合电器", "电气设备性能", "单位B", "华东", "资料记录", "较大", 0.86, 0.82, False, "STD-GIS-001", "组合电器接地监督标准", "CLAUSE-GIS-4.3.10", "接地连接方式要求", "related_to_clause", 0.82, "True", 78.0),
    (3, "D003", "现场空间不足导致GIS接地线无法按标准方式连接", "组合电器", "工程设计", "单位C", "华中", "设计适用性", "重大", 0.89, 0.84, False, "STD-GIS-001", "组合电器接地监督标准", "CLAUSE-GIS-4.3.10", "接地连接方式要求", "related_to_clause", 0.8, "标准表述歧义", 76.0),
    (4, "D004", "隔离开关铭牌参数与出厂资料不一致", "隔离开关", "电气设备性能", "单位D", "华北", "资料记录", "一般", 0.76, 0.74, False, "STD-DS-002", "隔离开关资料监督标准", "CLAUSE-DS-2.1", "铭牌与资料一致性", "related_to_clause", 0.62, "False", 28.0),
    (5, "D005", "特殊运行环境下标准未明确组合电器验收适用要求", "组合电器", "验收管理", "单位E", "华南", "标准适用性", "较大", 0.81, 0.79, False, "STD-GENERAL-003", "通用设备验收监督标准", "", "", "related_to_standard", 0.72, "标准缺失", 70.0),
    (6, "D006", "GIS接地整改描述较模糊需专家确认条款关联", "组合电器", "电气设备性能", "单位F", "西南", "安装质量", "较大", 0.52, 0.58, True, "STD-GIS-001", "组合电器接地监督标准", "CLAUSE-GIS-4.3.10", "接地连接方式要求", "related_to_clause", 0.55, "需人工判断", 55.0),
]
LINKED_SCHEMA = (
    "row_pos bigint, problem_id string, `问题描述` string, `设备类型` string, `监督专业` string, "
    "`所属单位` string, `地区` string, predicted_category string, predicted_severity string, "
    "category_confidence double, severity_confidence double, need_review boolean, "
    "kg_standard_id string, kg_standard_name string, kg_clause_id string, kg_clause_title string, "
    "kg_relation_type string, kg_relation_confidence double, revision_demand string, "
    "standard_revision_priority_score double"
)
