"""Scans and sinks.

Line order inside a file is recovered from the file's split offset plus a
per-task increasing id (``monotonically_increasing_id`` grows within a task
and splits of one file are ordered by their start offset), so "first" /
"last" / "first N" semantics of the line-oriented reference readers hold
without reading a file in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.plans.prefix import row_numbers


def lines_in_order(spark: SparkSession, paths) -> DataFrame:
    """``(file, line_key, value)`` for text files; ``line_key`` orders the
    lines of a file (not a dense line number)."""
    df = spark.read.text(paths if isinstance(paths, list) else [paths])
    return df.select(F.col("_metadata.file_path").alias("file"),
                     F.struct(F.col("_metadata.file_block_start").alias("block"),
                              F.monotonically_increasing_id().alias("pos")).alias("line_key"),
                     "value")


def _string_field(v: Column, name: str) -> Column:
    f = F.variant_get(v, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(f) == "STRING", F.variant_get(v, f"$.{name}", "string"))


def tolerant_jsonl_texts(spark: SparkSession, paths, limit: int | None = None,
                         fields=("prompt", "response")) -> DataFrame:
    """Skip blank and undecodable lines; emit only *string* values of
    ``fields`` in (file, line, field) order; stop after ``limit`` values.

    The limit holds in file order without sorting the files: values are counted
    per file split (one row each), the split in which the limit falls is found
    from their running sum, splits before it are taken whole, and only that one is
    numbered.  Files are ordered by path."""
    ls = lines_in_order(spark, paths).where(F.trim("value") != "")
    v = F.try_parse_json("value")
    parsed = ls.select("file", "line_key", v.alias("v")).where(F.col("v").isNotNull())
    arr = F.array(*[F.struct(F.lit(i).alias("field_idx"), _string_field(F.col("v"), f).alias("text")) for i, f in enumerate(fields)])
    out = parsed.select("file", "line_key", F.explode(arr).alias("x")).select("file", "line_key", "x.field_idx", "x.text")
    out = out.where(F.col("text").isNotNull())
    if limit is None:
        return out
    split = F.struct("file", F.col("line_key.block").alias("block"))
    counted = out.groupBy(split.alias("split")).agg(F.count("*").alias("n"))
    until = F.sum("n").over(Window.orderBy("split").rowsBetween(Window.unboundedPreceding, 0))  # one row a file split
    edge = counted.withColumn("until", until).where(F.col("until") >= limit).orderBy("split").first()
    if edge is None or limit <= 0:
        return out if limit > 0 else out.limit(0)
    at = F.struct(F.lit(edge.split.file).alias("file"), F.lit(edge.split.block).cast("long").alias("block"))
    rest = limit - (edge.until - edge.n)
    last = out.where(split == at).orderBy("line_key", "field_idx").limit(rest)
    return out.where(split < at).unionByName(last)


def strict_jsonl(spark: SparkSession, paths, schema: str) -> DataFrame:
    """Blank lines skipped, malformed JSON raises (FAILFAST)."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def json_array_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """S3: a file holding one JSON array -> one row per element."""
    r = spark.read.option("multiLine", True)
    if schema:
        r = r.schema(schema)
    return r.json(path)


def first_existing(spark: SparkSession, candidates) -> str | None:
    """Resolve the first existing path of a candidate list (driver-side
    metadata call on the cluster file system, no data read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for c in candidates:
        if c is None:
            continue
        p = jvm.org.apache.hadoop.fs.Path(c)
        if p.getFileSystem(conf).exists(p):
            return c
    return None


def keyed_last_wins(spark: SparkSession, candidates, key: str, schema: str) -> DataFrame:
    """JSONL keyed by ``key``; the last record of a key wins (file, line
    order); the first existing path of ``candidates`` is used."""
    path = first_existing(spark, candidates if isinstance(candidates, list) else [candidates])
    if path is None:
        raise FileNotFoundError(f"none of {candidates} exists")
    ls = lines_in_order(spark, path).where(F.trim("value") != "")
    rows = ls.select("file", "line_key", F.from_json("value", schema).alias("r"))
    last = rows.groupBy(F.col(f"r.{key}").alias(key)).agg(
        F.max_by("r", F.struct("file", "line_key")).alias("r"))
    return last.select("r.*")


def text_tree(spark: SparkSession, root: str, glob: str = "*.txt", packs: str | None = None) -> DataFrame:
    """One row per file under ``root`` (recursive): ``rel_path``, ``content``.

    Files are loose or, where ``packs`` names them, members of packs (see
    ``write_packed_tree``): millions of small files cost a listing entry on the
    driver and an open each, members only their bytes."""
    # .text()'s own wholetext=False default would override an option() value
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root, wholetext=True)
    root_norm = re.sub(r"^[a-z][a-z0-9+.-]*:", "", root).strip("/")  # with or without an authority: what follows the scheme
    rel = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), r"^[a-z][a-z0-9+.-]*:", ""), "^/*" + _quote(root_norm) + "/", "")
    loose = df.select(rel.alias("rel_path"), F.col("value").alias("content"))
    if packs is None:
        return loose
    members = (spark.read.schema("rel_path string, content string").option("mode", "FAILFAST")
               .option("recursiveFileLookup", True).option("pathGlobFilter", packs).json(root))
    named = "(?s)^" + "".join({"*": ".*", "?": "."}.get(ch, _quote(ch)) for ch in glob) + "$"
    return loose.unionByName(members.where(F.regexp_extract("rel_path", "([^/]*)$", 1).rlike(named)))


def write_packed_tree(tree: DataFrame, root: str) -> None:
    """S8 for a tree of small files: rows of ``rel_path`` and ``content`` as packs,
    JSON lines with one member each, as many packs as ``tree`` has partitions."""
    tree.select("rel_path", F.coalesce("content", F.lit("")).alias("content")).write.mode("errorifexists").json(root)


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in s)


def write_jsonl(df: DataFrame, path: str, allow_overwrite: bool = False) -> None:
    """JSON lines (UTF-8 kept); refuse a non-empty target unless allowed."""
    df.write.mode("overwrite" if allow_overwrite else "errorifexists").json(path)


def write_sidecar(meta: DataFrame, path: str, allow_overwrite: bool = True) -> None:
    """The one-row metadata table as a single JSON object file."""
    meta.coalesce(1).write.mode("overwrite" if allow_overwrite else "errorifexists").json(path)


def with_prompt_file_names(df: DataFrame, category: str = "category", language: str = "language",
                           order_cols=("id",)) -> DataFrame:
    """``file_name`` = ``{i:03d}_{language}`` numbered per category in
    order (skew-safe row numbers)."""
    rn = row_numbers(df, [category], list(order_cols), "_i")
    return rn.withColumn("file_name", F.format_string("%03d_%s", F.col("_i"), F.col(language))).drop("_i")


def write_prompts_by_category(df: DataFrame, path: str, allow_overwrite: bool = False) -> None:
    """Rows partitioned by category (no file per row)."""
    df.write.mode("overwrite" if allow_overwrite else "errorifexists").partitionBy("category").json(path)


def gz_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Gzip JSONL is read natively (codec from the file suffix)."""
    return spark.read.schema(schema).json(path)


def progress_sink(stream: DataFrame, path: str):
    """Progress snapshots as a streaming append per micro-batch
    (``batch_id`` folders, overwrite = idempotent) — never a rewrite of the
    full prefix."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return stream.writeStream.foreachBatch(write_batch)
