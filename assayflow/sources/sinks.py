"""Sinks: records, ledgers, reports. Spark's commit protocol takes the place of rename tricks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_records(df: DataFrame, path: str, key: str | None = None) -> None:
    """All rows as JSON lines; an earlier result is replaced as a whole."""
    (df.repartition(key) if key else df).write.mode("overwrite").json(path)


def changed_only(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of ``after`` that differ from ``before`` or are new."""
    same = before.intersect(after.select(before.columns))
    return after.join(same.select(key), key, "left_anti")


def pending(tasks: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Tasks without a stored result for the same keys."""
    return tasks.join(done.select(keys).distinct(), keys, "left_anti")


def cache_key(df: DataFrame, columns: list[str], config: str) -> DataFrame:
    """Adds ``cache_key``: sixteen hexadecimal digits over the columns and the configuration."""
    return df.withColumn("cache_key", F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns], F.lit(config))), 1, 16))


def invalidate(results: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return results.join(keys.select(on).distinct(), on, "left_anti")


def unique_names(files: DataFrame, name: str) -> DataFrame:
    """Adds ``target``: the name, with a running suffix where several files share it."""
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy(name).orderBy("file"))
    stem, ext = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2)
    return files.withColumn("target", F.when(n == 1, F.col(name)).otherwise(F.concat(stem, F.lit("_"), (n - 1).cast("string"), ext)))


def markdown(report: DataFrame, title: str, limit: int = 200) -> str:
    """A small aggregate as a Markdown table; the report itself is limited, not its input."""
    rows = report.limit(limit).collect()
    head = f"# {title}\n\n| " + " | ".join(report.columns) + " |\n|" + "---|" * len(report.columns)
    return "\n".join([head, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows)]) + "\n"


def ledger(tasks: DataFrame) -> DataFrame:
    """Numbers of tasks by their statuses."""
    return tasks.groupBy("parse_status", "preprocess_status", "final_status").agg(F.count("*").alias("n"))


def chart_data(values: DataFrame, group: str) -> DataFrame:
    """Bars of a chart: number of rows of each group; drawing is left to other tools."""
    return values.groupBy(group).agg(F.count("*").alias("n"))
