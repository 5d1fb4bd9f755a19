"""What the operators know of a language: character classes, marks, phrase lists and thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TextProfile:
    counted: str  # inside of a character class: the characters that count
    paragraph: str  # literal between paragraphs
    sentence_end: str  # inside of a character class
    prose_end: str  # inside of a character class: what a finished text may end in
    dialogue_anywhere: tuple[str, ...]
    dialogue_start: tuple[str, ...]
    heading: str  # a whole line, its title in group 1
    note: str  # how an author's note begins
    punctuation: tuple[str, ...]
    trace_phrases: tuple[str, ...]
    generic_phrases: tuple[str, ...]
    outline_markers: tuple[str, ...]
    disclaimer_markers: tuple[str, ...]
    meta_markers: tuple[str, ...]
    directive_markers: tuple[str, ...]
    untitled: str
    preface: str
    shortest: int = 2000
    longest: int = 2500
    padded: int = 2450
    cap_floor: int = 2000
    repetition: float = 0.1
    coverage: float = 0.34
    hook_tail: int = 200
    leak_window: int = 12
    list_item: str = r"^(?:[-*]\s+|\d+[.、]\s*)"
    separator: str = r"^[-—_]{3,}$"
    outline: str = r"【[^】]{1,80}】"
    extra: dict = field(default_factory=dict, hash=False, compare=False)


# Phrase and marker lists, patterns and thresholds of the Chinese fiction profile.
ZH = TextProfile(
    counted=r"\x{4e00}-\x{9fff}",
    paragraph="\n\n",
    sentence_end="。！？!?",
    prose_end="。！？!?…’”）)",
    dialogue_anywhere=("“", "”"),
    dialogue_start=('"',),
    heading=r"^[ \t\x{3000}]*(第\s*[零一二三四五六七八九十百千万0-9]+\s*[章节卷集部].*)$",
    note=r"^[ \t\x{3000}]*(?:作者有话说|作者的话|题外话)",
    punctuation=("。", "，", "、", "；", "：", "！", "？", "“", "”", "…"),
    trace_phrases=("空气仿佛凝固了", "难以言喻的情绪", "心中涌起一股复杂的情绪", "命运的齿轮开始转动", "眼神逐渐坚定起来", "嘴角勾起一抹弧度", "这一刻，他终于明白", "所有人都意识到", "一种前所未有的感觉"),
    generic_phrases=("终于明白", "轻声说", "像是某种", "深吸一口气", "空气仿佛凝固"),
    outline_markers=("【", "】", "章节结构", "以下是正文"),
    disclaimer_markers=("作为AI", "我无法", "不能保证", "仅供参考"),
    meta_markers=("以下是正文", "最终确认", "检查清单", "本章完成", "符合要求"),
    directive_markers=(
        "请严格遵循", "请根据以上", "已激活", "以下是正文", "检查清单", "输出格式", "章节结构", "风格契约", "前情摘要", "本章目标", "人物状态", "必须出现", "必须包含", "禁止事项",
        "章末钩子", "目标字数", "第一人称", "人称视角", "语言风格", "现实主义", "叙事节奏", "叙事视角", "主题锚点", "核心情绪", "关键意象", "情感结构", "最终效果",
    ),
    untitled="未命名章节",
    preface="前置正文",
)

#: For Latin-script tables.
LATIN = TextProfile(
    counted=r"\p{L}",
    paragraph="\n",
    sentence_end=".!?",
    prose_end=".!?)",
    dialogue_anywhere=('"',),
    dialogue_start=("-",),
    heading=r"^[ \t]*(Chapter [0-9]+.*)$",
    note=r"^[ \t]*(?:Author's note)",
    punctuation=(".", ",", "!", "?", ";", ":"),
    trace_phrases=("All rights reserved", "Licensed under", "Copyright"),
    generic_phrases=("of the", "All rights reserved"),
    outline_markers=("|", "[", "]"),
    disclaimer_markers=("All rights reserved", "Copyright"),
    meta_markers=("http", "@"),
    directive_markers=("All rights reserved", "Copyright", "http"),
    untitled="Untitled",
    preface="Preface",
    shortest=300,
    longest=5000,
    padded=2450,
    cap_floor=400,
    leak_window=24,
)
