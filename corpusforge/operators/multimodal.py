"""Rewriting chat requests with images into text for a text model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .generate import Generator, call

#: What is asked about each image, and how the reports are put before the user's text.
IMAGE_PROMPT = "Please provide a complete visual report and analysis of this image."
TASK = "**Task:**\nThe images above were described by a vision model. Answer the request below from these descriptions:\n> "
PARTS = "array<struct<type:string,text:string,image_url:struct<url:string>>>"


def parse_content(content: Column, images: Column) -> DataFrame | Column:
    """struct(text, images) of a message whose content is a plain text or a JSON list of parts; the last text part counts, then come the attached images."""
    listed = F.startswith(F.ltrim(F.coalesce(content, F.lit(""))), F.lit("["))
    parts = F.when(listed, F.from_json(content, PARTS))
    texts = F.filter(parts, lambda p: p["type"] == "text")
    text = F.when(parts.isNull(), F.coalesce(content, F.lit(""))).when(F.size(texts) > 0, F.coalesce(F.element_at(texts, -1)["text"], F.lit(""))).otherwise("")
    urls = F.transform(F.filter(parts, lambda p: (p["type"] == "image_url") & (F.coalesce(p["image_url"]["url"], F.lit("")) != "")), lambda p: p["image_url"]["url"])
    attached = F.filter(F.transform(images, lambda i: i["url"]), lambda u: F.coalesce(u, F.lit("")) != "")
    none = F.array().cast("array<string>")
    return F.struct(text.alias("text"), F.concat(F.coalesce(urls, none), F.coalesce(attached, none)).alias("images"))


def report(texts: Column, statuses: Column) -> Column:
    """One section for each image: what the vision model said, or that it failed."""
    section = F.transform(texts, lambda t, i: F.concat(F.lit("### [IMAGE ANALYSIS - DOCUMENT #"), (i + 1).cast("string"), F.when(F.get(statuses, i) == "ok", F.concat(F.lit("]\n"), F.trim(F.coalesce(t, F.lit(""))), F.lit("\n"))).otherwise(F.concat(F.lit(" ERROR]\n*(no description: "), F.coalesce(F.get(statuses, i), F.lit("error")), F.lit(")*\n")))))
    return F.array_join(section, "\n")


def rewritten(text: Column, reports: Column) -> Column:
    return F.concat(reports, F.lit("\n---\n"), F.lit(TASK), text)


def rewrite(df: DataFrame, key: str, generator: Generator, content: str = "content", images: str = "images") -> DataFrame:
    """df with the content of messages that have images replaced by reports and request, and their images cleared. Messages without images stay as they are.

    Images are asked about one by one, in parallel over the cluster; a message gathers its own images only.
    """
    parsed = df.withColumn("__p", parse_content(F.col(content), F.col(images)))
    asked = parsed.where(F.size("__p.images") > 0).select(F.col(key), F.posexplode("__p.images").alias("__at", "__url"))
    replies = call(asked, F.concat(F.lit(IMAGE_PROMPT + "\n"), F.col("__url")), generator, "vision", "__reply")
    held = replies.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__at", "__reply", "__reply_status"))).alias("__r"))
    joined = parsed.join(held, key, "left")
    text = rewritten(F.col("__p.text"), report(F.transform("__r", lambda r: r["__reply"]), F.transform("__r", lambda r: r["__reply_status"])))
    done = F.col("__r").isNotNull()
    cleared = F.when(done, F.array().cast(df.schema[images].dataType)).otherwise(F.col(images))
    return joined.withColumns({content: F.when(done, text).otherwise(F.col(content)), images: cleared}).select(*df.columns)
