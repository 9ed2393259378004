"""The alert decision and the alert message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.html import escape, preview
from newsloom.functions.text import ELLIPSIS, constant_map, strip

# Fixed values of the message: source icons, line marks, lengths.
SOURCE_ICONS = {
    "VNExpress - Thời sự": "🇻🇳",
    "VNExpress - Thế giới": "🌏",
    "VNExpress - Kinh doanh": "💼",
    "VNExpress": "📰",
    "BBC World News": "🌍",
}
DEFAULT_ICON = "📡"
CATEGORY_MARK, SOURCE_MARK, TAGS_MARK, LINK_MARK = "📂", "📌", "🏷", "🔗"
LINK_TEXT = "Read more"
NO_TITLE = "No title"
PREVIEW_LENGTH = 300
HASHTAGS = 5


def feed_alert(text: Column, include: Column, exclude: Column) -> Column:
    """``struct(should_alert, matched_keywords)`` from a feed's keyword lists.

    An excluded keyword silences the article; without include keywords every
    other article alerts; else the include keywords that hit are listed.
    """
    none = F.array().cast("array<string>")
    silenced = F.exists(exclude, lambda k: F.contains(text, k))
    hits = F.when(silenced, none).otherwise(F.filter(include, lambda k: F.contains(text, k)))
    alert = ~silenced & ((F.size(include) == 0) | (F.size(hits) > 0))
    return F.struct(alert.alias("should_alert"), hits.alias("matched_keywords"))


def icon(source: Column, icons: dict[str, str] | None = None, default: str = DEFAULT_ICON) -> Column:
    pairs = SOURCE_ICONS if icons is None else icons
    return F.coalesce(F.try_element_at(constant_map(pairs), source), F.lit(default))


def shorten_preview(c: Column, limit: int = PREVIEW_LENGTH) -> Column:
    """At most ``limit`` characters, the cut marked by an ellipsis three characters earlier."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 3), F.lit(ELLIPSIS))).otherwise(c)


def hashtags(keywords: Column, limit: int = HASHTAGS) -> Column:
    tags = F.transform(
        F.slice(keywords, 1, limit),
        lambda k: F.concat(F.lit("#"), F.replace(k, F.lit(" "), F.lit("_"))),
    )
    return F.array_join(tags, " ")


def alert_message(title: Column, body_preview: Column, url: Column, source: Column,
                  category: Column, keywords: Column) -> Column:
    """The message text; lines without a value are left out.

    ``body_preview`` is the summary after ``html.preview``. ``title`` is null
    when the article has none.
    """
    tags = hashtags(keywords)
    origin = F.when(category != "", F.concat(F.lit(f"{CATEGORY_MARK} <i>"), escape(category), F.lit("</i>"))).when(
        source != "", F.concat(F.lit(f"{SOURCE_MARK} <i>"), escape(source), F.lit("</i>")))
    return F.concat_ws(
        "\n",
        F.concat(icon(source), F.lit(" <b>"), escape(strip(F.coalesce(title, F.lit(NO_TITLE)))), F.lit("</b>")),
        origin,
        F.when(body_preview != "", F.concat(F.lit("\n"), escape(shorten_preview(body_preview)))),
        F.when(F.size(keywords) > 0, F.concat(F.lit(f"\n{TAGS_MARK} "), tags)),
        F.when(url != "", F.concat(F.lit(f'\n{LINK_MARK} <a href="'), escape(url), F.lit(f'">{LINK_TEXT}</a>'))),
    )


def message_preview(summary: Column, content: Column) -> Column:
    """Preview of the summary, or of the content when there is no summary at all."""
    return preview(F.coalesce(summary, content))
