"""Prompt labels and prompt text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Labels:
    question: str
    context: str
    prompt: str
    no_context: str


# Labels per language code.
LABELS = {
    "uk": Labels("Питання", "Контекст", "Підказка", "Відсутній контекст"),
    "en": Labels("Question", "Context", "Prompt", "No context"),
}

TEMPLATES = ("full", "inline_prompt", "no_prompt")


def labels_for(language: str) -> Labels:
    code = language.lower()
    if code not in LABELS:
        raise ValueError(f"no prompt labels for {language!r}; known: {sorted(LABELS)}")
    return LABELS[code]


def render_prompt(question: Column, context: Column, prompt: str = "", language: str = "uk", template: str = "full") -> Column:
    """Prompt text for one row; a null question or context is written as ``None``.

    ``full`` puts the instruction on a line of its own, ``inline_prompt`` does not end that line,
    ``no_prompt`` leaves it out.
    """
    if template not in TEMPLATES:
        raise ValueError(f"template must be one of {TEMPLATES}")
    labels = labels_for(language)
    head = {
        "full": f"[{labels.prompt}]: {prompt}\n",
        "inline_prompt": f"[{labels.prompt}]: {prompt}",
        "no_prompt": "",
    }[template]
    return F.concat(
        F.lit(f"{head}[{labels.question}]: "),
        F.coalesce(question, F.lit("None")),
        F.lit(f"\n[{labels.context}]: "),
        F.coalesce(context, F.lit("None")),
        F.lit("\n"),
    )
