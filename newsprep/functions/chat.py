"""Chat messages, completions and their rendered length."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsprep.functions.fixed_values import (
    SYSTEM_PROMPT,
    USER_PREFIX,
    USER_SUFFIX,
)
from newsprep.functions.text import strip, word_count


@dataclass(frozen=True)
class PromptTemplate:
    """The two prompt messages; the article sits between prefix and suffix."""

    system: str = SYSTEM_PROMPT
    user_prefix: str = USER_PREFIX
    user_suffix: str = USER_SUFFIX


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_prompt(article: Column, template: PromptTemplate = PromptTemplate()) -> Column:
    """System and user message. The article is concatenated, never searched, so
    text that looks like a placeholder stays as it is."""
    user = F.concat(F.lit(template.user_prefix), article, F.lit(template.user_suffix))
    return F.array(message("system", F.lit(template.system)), message("user", user))


def completion_text(summary: Column, label: Column) -> Column:
    return F.concat(
        F.lit("<SUMMARY>\n"), strip(summary),
        F.lit("\n</SUMMARY>\n<SENTIMENT>\n"), label, F.lit("\n</SENTIMENT>"),
    )


def build_completion(summary: Column, label: Column) -> Column:
    return F.array(message("assistant", completion_text(summary, label)))


def render_chat(messages: Column) -> Column:
    """All messages as one string, each between tags named after its role."""

    def render(m: Column) -> Column:
        return F.concat(
            F.lit("<"), m["role"], F.lit(">"), m["content"], F.lit("</"), m["role"], F.lit(">")
        )

    return F.array_join(F.transform(messages, render), "")


def token_count(text: Column, unit: str) -> Column:
    """Number of ``char`` or ``word`` tokens of a string."""
    if unit == "char":
        return F.length(text)
    if unit == "word":
        return word_count(text)
    raise ValueError(f"unknown unit: {unit!r}")


def rendered_length(prompt: Column, completion: Column, unit: str = "char") -> Column:
    return token_count(render_chat(F.concat(prompt, completion)), unit)


def chat_overhead(
    summary: Column, label: Column, *, unit: str, template: PromptTemplate = PromptTemplate()
) -> Column:
    """Rendered length of everything except the article.

    Lengths add up because the article is set between whitespace: the template
    must end its prefix and start its suffix with a whitespace character when
    words are counted.
    """
    if unit == "word" and not (
        template.user_prefix[-1:].isspace() and template.user_suffix[:1].isspace()
    ):
        raise ValueError("word counting needs whitespace around the article")
    frame = (
        f"<system>{template.system}</system>"
        f"<user>{template.user_prefix}{template.user_suffix}</user><assistant>"
    )
    text = F.concat(F.lit(frame), completion_text(summary, label), F.lit("</assistant>"))
    return token_count(text, unit)
