"""Words and rules for the given tables, whose texts are not Chinese.

Same structure as the default rules; only the words differ.
"""

from __future__ import annotations

from clausewise import rules

PRIORITY_OVERRIDES = {
    "device_scores": [
        {"keywords": ["ECONOMY", "PROMO"], "score": 1.0},
        {"keywords": ["STANDARD"], "score": 0.8},
    ]
}
TERMS = {"tion": "sion", "sion": "zion", "License": "permit"}
FIELD_NAMES = {"device_type": "设备", "specialty": "专业", "text": "问题文本"}

CATEGORY_RULES = [
    {"category": "资料与标识", "tests": [{"words": ["License", "@", "copyright"]}]},
    {
        "category": "设计与选型",
        "tests": [{"field": "problem_stage", "values": ["x"], "words": ["quell", "cher"]}, {"words": ["thereth"]}],
    },
    {
        "category": "采购与制造",
        "tests": [{"field": "supervision_stage", "values": ["设备采购"], "words": ["tion"]}],
    },
    {"category": "运维与环境", "tests": [{"field": "specialty", "values": ["es"]}]},
    {
        "category": "安装与施工",
        "tests": [{"field": "problem_reason", "values": ["现场安装"]}, {"words": ["edwhst", "thorre"]}],
    },
    {"category": "调试与试验", "tests": [{"field": "problem_stage", "values": ["设备调试"]}]},
]
CATEGORY_DEFAULT = "验收与交接"

_WORDS = {
    "标准缺失": [{"any": ["License", "@"]}, {"all": ["this"], "any": ["thereth", "orthth"]}],
    "标准冲突": [{"any": ["quell", "vipa"]}],
    "标准表述歧义": [{"any": ["ñ"]}],
    "执行落实问题": [{"any": ["tion", "cher"]}],
}
REVISION_RULES = [
    rule | {"tests": rule["tests"] if "status" in rule["tests"][0] else _WORDS.get(rule["need"], [{"any": ["ç"]}])}
    for rule in rules.REVISION_RULES
]
