"""Sources: layout and task JSON, result and gold directories, images, rule and config files.

Readers take a path or glob and give a DataFrame with the file's name; unreadable files are
kept as rows with a null document, so one broken file never ends a batch.
"""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame, SparkSession, functions as F


def whole_files(spark: SparkSession, path: str, pattern: str = "*.json", exclude: str | None = None) -> DataFrame:
    """(file, name, text) of all files below ``path`` that match, each once."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("wholetext", "true").text(path)
    out = df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text")).dropDuplicates(["file"])
    return out.where(~F.col("name").contains(exclude)) if exclude else out


def documents(spark: SparkSession, path: str, pattern: str = "*.json", exclude: str | None = None) -> DataFrame:
    """(file, name, doc VARIANT, readable): JSON documents; null and not readable where the text is no JSON."""
    df = whole_files(spark, path, pattern, exclude)
    return df.select("file", "name", F.try_parse_json("text").alias("doc"), F.try_parse_json("text").isNotNull().alias("readable"))


def task_files(spark: SparkSession, path: str) -> DataFrame:
    """Task documents anywhere below ``path``, sorted by file."""
    return documents(spark, path, "*mid_task.json").orderBy("file")


def gold_records(spark: SparkSession, path: str) -> DataFrame:
    """Annotated records; the template is left out."""
    return documents(spark, path, "*.json", exclude="template")


def pdf_listing(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(file, name, length) of main papers: supplements (a stem with SI) are left out; ``limit`` is the listing's own."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(path)
    df = df.select(F.col("path").alias("file"), F.element_at(F.split("path", "/"), -1).alias("name"), "length").where("NOT name RLIKE '(^|[ _-])SI([ _.-]|$)'").orderBy("name")
    return df.limit(limit) if limit else df


def images(spark: SparkSession, path: str) -> DataFrame:
    """(file, base64) of image files."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,jpg,jpeg}").option("recursiveFileLookup", "true").load(path)
    return df.select(F.col("path").alias("file"), F.base64("content").alias("base64"))


def rule_book(path: str) -> dict:
    """A JSON rule file of the driver; missing or broken gives an empty one."""
    try:
        with open(path, encoding="utf-8") as f:
            got = json.load(f)
        return got if isinstance(got, dict) else {}
    except (OSError, ValueError):
        return {}


def deep_merge(base: dict, over: dict) -> dict:
    """``over`` laid on ``base``: mappings merge, everything else replaces."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def resolve_env(value: object) -> object:
    """``${NAME}`` and ``env:NAME`` replaced from the driver's environment, anywhere in a config."""
    if isinstance(value, dict):
        return {k: resolve_env(v) for k, v in value.items()}
    if isinstance(value, list):
        return [resolve_env(v) for v in value]
    if isinstance(value, str):
        if value.startswith("env:"):
            return os.environ.get(value[4:], "")
        return re.sub(r"\$\{(\w+)\}", lambda m: os.environ.get(m.group(1), ""), value)
    return value


def load_config(path: str, defaults: dict) -> dict:
    """Defaults, then the file (JSON, or YAML where a parser is installed), then the environment."""
    got: dict = {}
    if os.path.exists(path):
        if path.endswith((".yaml", ".yml")):
            try:
                import yaml

                with open(path, encoding="utf-8") as f:
                    got = yaml.safe_load(f) or {}
            except ImportError:
                got = {}
        else:
            got = rule_book(path)
    return resolve_env(deep_merge(defaults, got))


def fields_schema(fields: DataFrame) -> str:
    """A DDL schema from rows (name, type): the fields a configuration adds to the output."""
    kinds = {"number": "double", "string": "string", "list": "array<string>", "bool": "boolean"}
    return ", ".join(f"`{r['name']}` {kinds.get(r['type'], 'string')}" for r in fields.orderBy("name").collect())


def render(template: str, values: dict[str, object], limit: int = 20) -> str:
    """A prompt from a template with {slots}; lists are cut to ``limit`` lines."""
    out = template
    for k, v in values.items():
        out = out.replace("{" + k + "}", "\n".join(map(str, v[:limit])) if isinstance(v, (list, tuple)) else str(v))
    return out


def task_chunks(tasks: DataFrame) -> DataFrame:
    """(file, ord, chunk, mentions): chunks of task documents padded with their contexts."""
    doc = tasks.where("readable").selectExpr(
        "file", "variant_get(doc, '$.llm_task.chunks', 'array<string>') AS chunks", "variant_get(doc, '$.llm_task.chunk_contexts', 'array<variant>') AS contexts"
    )
    return doc.selectExpr("file", "posexplode(arrays_zip(chunks, contexts)) AS (ord, z)").selectExpr("file", "ord", "z.chunks AS chunk", "try_variant_get(z.contexts, '$.candidate_system_mentions', 'array<string>') AS mentions")
