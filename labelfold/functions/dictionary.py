"""Label dictionary: the ordered label names that fix the matrix columns.

The position of a name in the dictionary is its ``label_idx``.  A dictionary
is a tiny driver-side value (K entries); its DataFrame form is K rows and is
always safe to broadcast.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The default label set of the reference corpus (order matters,
# it is the column order of every label matrix), its descriptions, the
# English display names (including the spelling variant without a space) and
# the spelling alias accepted for the 8th label in raw splits.
# ---------------------------------------------------------------------------
DEFAULT_LABELS = [
    "여성/가족", "남성", "성소수자", "인종/국적", "연령",
    "지역", "종교", "기타 혐오", "악플/욕설", "clean",
]
DEFAULT_DESCRIPTIONS = {
    "여성/가족": "여성성 및 여성의 성역할에 대한 통념, 여성 차별 희화화, 페미니즘 관련 악플",
    "남성": "집단으로서의 남성 일반을 비하, 조롱, 희화화하는 발언",
    "성소수자": "성소수자를 배척하거나 희화화하는 표현",
    "인종/국적": "특정 인종과 국적에 대한 욕설, 고정관념, 조롱",
    "연령": "특정 세대나 연령을 비하하는 은어 및 혐오 표현",
    "지역": "특정 지역에 대한 은어 및 혐오 표현",
    "종교": "특정 종교에 대한 혐오 및 종교인 집단에 대한 비난",
    "기타 혐오": "위 카테고리 이외의 집단을 대상으로 하는 혐오 표현",
    "악플/욕설": "집단 지칭 없는 비하/욕설, 불쾌감 주는 내용",
    "clean": "혐오표현, 욕설, 불쾌감, 음란성 내용이 없는 일반 문장",
}
DEFAULT_EN_NAMES = {
    "여성/가족": "Women/Family",
    "남성": "Men",
    "성소수자": "LGBTQ",
    "인종/국적": "Race/Nationality",
    "연령": "Age",
    "지역": "Region",
    "종교": "Religion",
    "기타 혐오": "Other Hate",
    "기타혐오": "Other Hate",
    "악플/욕설": "Profanity",
    "clean": "Clean",
}
DEFAULT_ALIASES = {"기타 혐오": ["기타혐오"]}
DEFAULT_TEXT_COLUMN = "문장"
EMPTY_SET_NAME = "clean"


@dataclass(frozen=True)
class LabelDictionary:
    names: tuple
    descriptions: dict = field(default_factory=dict)
    en_names: dict = field(default_factory=dict)
    aliases: dict = field(default_factory=dict)

    @property
    def k(self) -> int:
        return len(self.names)

    def index(self, name: str) -> int:
        return self.names.index(name)

    def en(self, name: str) -> str:
        """English display name; an unmapped name passes through."""
        return self.en_names.get(name, name)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([
            T.StructField("label_idx", T.IntegerType(), False),
            T.StructField("label", T.StringType(), False),
            T.StructField("label_en", T.StringType(), False),
            T.StructField("description", T.StringType(), False),
        ])
        rows = [(i, n, self.en(n), self.descriptions.get(n, ""))
                for i, n in enumerate(self.names)]
        return spark.createDataFrame(rows, schema)

    def to_json(self) -> str:
        return json.dumps({
            "label_columns": list(self.names),
            "num_labels": self.k,
            "label_descriptions": dict(self.descriptions),
        }, ensure_ascii=False)


def default_dictionary() -> LabelDictionary:
    return LabelDictionary(tuple(DEFAULT_LABELS), dict(DEFAULT_DESCRIPTIONS),
                           dict(DEFAULT_EN_NAMES), dict(DEFAULT_ALIASES))


def make_dictionary(names, descriptions=None, en_names=None, aliases=None) -> LabelDictionary:
    return LabelDictionary(tuple(names), dict(descriptions or {}),
                           dict(en_names or {}), dict(aliases or {}))


def dictionary_from_info(info: dict | None) -> LabelDictionary:
    """Build from a label-info mapping; fall back to the default set."""
    if not info or not info.get("label_columns"):
        return default_dictionary()
    base = default_dictionary()
    return LabelDictionary(tuple(info["label_columns"]),
                           dict(info.get("label_descriptions") or {}),
                           dict(base.en_names), dict(base.aliases))
