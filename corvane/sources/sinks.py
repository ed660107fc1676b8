"""Writers. All replace what the target folder held."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def write_records(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Binary records (Parquet), in ``partitions`` files if given."""
    out = df if partitions is None else df.repartition(partitions)
    out.write.mode("overwrite").parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_text(df: DataFrame, path: str, partitions: int | None = None,
               compression: str = "none") -> None:
    """Tab-separated text of all columns, quoted nowhere."""
    row = F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns])
    out = df.select(row.alias("value"))
    out = out if partitions is None else out.repartition(partitions)
    out.write.mode("overwrite").option("compression", compression).text(path)


def write_scored_pairs(scored: DataFrame, path: str) -> None:
    """Lines ``(a, b)<TAB>pmi``."""
    write_text(scored.select(F.format_string("(%s, %s)", "a", "b").alias("k"), "pmi"), path)


def partition_graph(edges: DataFrame, partitions: int, path: str) -> DataFrame:
    """Rewrite the edges into hash partitions of their source node."""
    edges.repartition(partitions, "src").write.mode("overwrite").parquet(path)
    return edges.sparkSession.read.parquet(path)


# Folder of the term directory inside a stored index; readers of the index skip it.
DIRECTORY = "_terms"


def write_index(index: DataFrame, path: str) -> None:
    """Store an index in term order, with a directory of its files.

    Files hold disjoint ranges of terms and are sorted inside; the directory has the first
    and last term of each, one row a file, and is written last. Row groups carry Bloom
    filters of their terms.
    """
    (index.repartitionByRange("term", "shard").sortWithinPartitions("term", "shard")
     .write.mode("overwrite").option("parquet.bloom.filter.enabled#term", "true").parquet(path))
    files = index.sparkSession.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file"))
    (files.agg(F.min("term").alias("first"), F.max("term").alias("last"))
     .write.mode("overwrite").parquet(f"{path}/{DIRECTORY}"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def index_stands(spark: SparkSession, path: str) -> bool:
    """Whether a whole index is stored at ``path``: its directory is written last."""
    try:
        return bool(spark.read.parquet(f"{path}/{DIRECTORY}").columns)
    except AnalysisException:
        return False


def find_terms(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """The rows of the given terms of a stored index.

    Only files whose range holds a term are opened: the directory names them, at most as
    many as a term's rows fill. Row groups inside are skipped by range and Bloom filter.
    """
    whole = read_index(spark, path)
    if not terms:
        return whole.where("false")
    asked = spark.createDataFrame([(t,) for t in dict.fromkeys(terms)], "term STRING")
    directory = spark.read.parquet(f"{path}/{DIRECTORY}")
    files = directory.join(F.broadcast(asked), F.col("term").between(F.col("first"), F.col("last")))
    names = [r.file for r in files.select("file").distinct().collect()]
    if not names:
        return whole.where("false")
    found = spark.read.schema(whole.schema).parquet(*[f"{path}/{name}" for name in sorted(names)])
    return found.where(F.col("term").isin(terms))
