"""Display texts that are stored in tables, as interchangeable sets."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Labels:
    """One language of stored texts.

    ``buckets`` must keep the digit prefixes ``1.``, ``2.``, ``3.``: sorting and
    the prefix tests over the duration mart rely on them.
    """

    roles: dict[str, str]
    role_default: str
    buckets: tuple[str, str, str]
    strong: str
    weak: str
    normal: str
    win: str
    loss: str
    # marks shown in front of the verdict in the ranking report
    strong_mark: str = "🟢 "
    weak_mark: str = "🔴 "
    normal_mark: str = "⚪ "

    def marked(self) -> "Labels":
        """The same set with the coloured marks in front of the verdicts."""
        from dataclasses import replace

        return replace(
            self,
            strong=self.strong_mark + self.strong,
            weak=self.weak_mark + self.weak,
            normal=self.normal_mark + self.normal,
        )


# The texts that existing star tables hold.
RU = Labels(
    roles={
        "TOP": "Топ",
        "JUNGLE": "Лес",
        "MIDDLE": "Мид",
        "BOTTOM": "Бот / керри",
        "UTILITY": "Саппорт",
    },
    role_default="Не определена",
    buckets=("1. Короткие (<25м)", "2. Средние (25-32м)", "3. Длинные (>32м)"),
    strong="значимо сильный",
    weak="значимо слабый",
    normal="в норме",
    win="Победа",
    loss="Поражение",
)

EN = Labels(
    roles={
        "TOP": "Top",
        "JUNGLE": "Jungle",
        "MIDDLE": "Middle",
        "BOTTOM": "Bottom",
        "UTILITY": "Support",
    },
    role_default="Undefined",
    buckets=("1. short (<25m)", "2. medium (25-32m)", "3. long (>32m)"),
    strong="strong",
    weak="weak",
    normal="normal",
    win="win",
    loss="loss",
)
