"""Releases: published assignments, the register of issued ones, conflicts, checksums and the site's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.operators.keys import DataError, assert_empty, assert_key, differing_rows
from tessella.operators.frames import FRAME_COLUMNS
from tessella.operators.privacy import public_assignments
from tessella.sources.readers import assert_sources, relative_digests, write_csv_file, write_csv_text
from tessella.sources.shared import exists

KEYS = {"authorities": "authority_id", "assignments": "application_id"}
# What a batch without these columns stands for.
DEFAULTS = {"template_version": "", "language": "", "channel": "", "randomization_stratum": "batch", "tier": "", "node_id": "", "tree_department": ""}


def combine_batches(batches: dict[str, DataFrame], sizes: dict[str, int], frame: DataFrame) -> DataFrame:
    """Assignments of all catalogued batches: ids and row counts checked, defaults filled, offices looked up by exact state and name.

    Of several offices of one state and name the first in the frame's order counts (its column pos, else authority_id).
    """
    parts = []
    for batch_id, rows in batches.items():
        other = F.count_if(~F.col("batch_id").eqNullSafe(batch_id)) if "batch_id" in rows.columns else F.lit(0)
        facts = rows.agg(F.count("*").alias("n"), other.alias("other")).first()
        if facts["n"] != sizes[batch_id]:
            raise DataError(f"{batch_id}: expected {sizes[batch_id]} rows")
        if facts["other"]:
            raise DataError(f"{batch_id}: the catalogue differs from the batch's ids")
        department = F.coalesce(F.col("tree_department"), F.lit("")) if "tree_department" in rows.columns else F.lit("")
        made = {"batch_id": F.lit(batch_id), "state_code": F.regexp_extract("application_id", "^([^-]*)", 1), **({} if "dept_group" in rows.columns else {"dept_group": department})}
        parts.append(rows.withColumns({**made, **{c: F.lit(v) for c, v in DEFAULTS.items() if c not in rows.columns}}))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).fillna("")
    if "authority_id" not in union.columns:
        union = union.withColumn("authority_id", F.lit(""))
    first = F.min_by("authority_id", "pos") if "pos" in frame.columns else F.min("authority_id")
    offices = frame.groupBy("state", "office_name").agg(first.alias("__authority"))
    joined = union.join(offices, ["state", "office_name"], "left")
    found = joined.withColumn("authority_id", F.when(F.col("authority_id") == "", F.col("__authority")).otherwise(F.col("authority_id"))).drop("__authority")
    assert_empty(found.filter("authority_id is null").select("application_id").orderBy("application_id"), "assignment without office")
    assert_empty(found.join(frame.select("authority_id"), "authority_id", "left_anti").select("application_id"), "unknown office")
    return assert_key(assert_key(found, "application_id", "assignments"), "authority_id", "assignments")


def build_release(actual_files: DataFrame, manifest: DataFrame, frame: DataFrame, assignments: DataFrame, path: str) -> DataFrame:
    """Verify sources, check what is public, write both tables, each as one CSV file in the order of its key; returns (table, rows, sha256) over their contents. files/ holds the SHA-256 of both files."""
    from tessella.operators.sampling import table_digest

    assert_sources(actual_files, manifest)
    spark = frame.sparkSession
    public, offices = public_assignments(assignments), frame.select([c for c in FRAME_COLUMNS if c in frame.columns])
    tables = {"authorities": offices, "assignments": public}
    for name, rows in tables.items():
        write_csv_file(rows, f"{path}/{name}.csv", [KEYS[name]])
    sums = spark.createDataFrame([(name, rows.count(), table_digest(rows)) for name, rows in tables.items()], "table string, rows long, sha256 string")
    write_csv_text(sums, f"{path}/checksums")
    digests = relative_digests(spark, path, "*.csv").filter(F.col("path").isin([f"{name}.csv" for name in tables]))
    write_csv_text(digests, f"{path}/files")
    return sums


def build_site(release: dict[str, DataFrame], instruments: DataFrame, path: str, root: str | None = None) -> None:
    """JSON rows of the public tables, worklists by assistant, and the catalogue of instruments of released batches.

    Private columns stay out whatever tables are given. With root, every instrument's file must be there.
    """
    spark = instruments.sparkSession
    public = public_assignments(release["assignments"])
    public.write.json(f"{path}/assignments")
    write_csv_text(public, f"{path}/assignments_csv")
    if "authorities" in release:
        release["authorities"].select([c for c in FRAME_COLUMNS if c in release["authorities"].columns]).write.json(f"{path}/authorities")
    shown = instruments.join(public.select("batch_id"), "batch_id", "left_semi")
    if root is not None:
        # The catalogue has a row for each batch and arm.
        for row in shown.select("path").distinct().toLocalIterator():
            if not exists(spark, f"{root}/{row['path']}"):
                raise DataError(f"instrument without file: {row['path']}")
    named = {"treatment", "template_version"} <= set(instruments.columns)
    name = F.concat_ws(" ", "treatment", "template_version") if named else F.element_at(F.split("path", "/"), -1)
    shown.withColumn("name", name).withColumn("path", F.concat(F.lit("batches/"), "path")).write.json(f"{path}/instruments")
    write_worklists(public, f"{path}/worklists")


def write_worklists(assignments: DataFrame, path: str) -> None:
    """One folder of CSV for each assistant, public columns only; names must be safe as file names."""
    from tessella.functions.text import safe_file_name

    public = public_assignments(assignments)
    assert_empty(public.filter(~safe_file_name("assigned_ra")).select("assigned_ra"), "unsafe assistant name")
    public.withColumn("ra", F.col("assigned_ra")).write.partitionBy("ra").option("header", True).option("emptyValue", "").csv(path)


def publication_differences(frozen: DataFrame, registered: DataFrame) -> DataFrame:
    """Rows in which a registered batch and its published copy differ on the registered columns, in any order."""
    missing = [c for c in registered.columns if c not in frozen.columns]
    if missing:
        raise DataError(f"published copy differs: it lacks {missing}")
    shared = frozen.join(registered.select("batch_id").distinct(), "batch_id", "left_semi")
    kept = registered.join(frozen.select("batch_id").distinct(), "batch_id", "left_semi")
    return differing_rows(shared.select([F.col(c).cast("string") for c in registered.columns]), kept.select([F.col(c).cast("string") for c in registered.columns]))


def combine_issued(frozen: DataFrame, registered: DataFrame) -> DataFrame:
    """All issued assignments: published ones, and registered batches that are not published yet."""
    assert_empty(publication_differences(frozen, registered), "published copy differs")
    fresh = registered.join(frozen.select("batch_id").distinct(), "batch_id", "left_anti")
    union = frozen.unionByName(fresh, allowMissingColumns=True).fillna("")
    return assert_key(assert_key(union, "application_id", "issued: duplicate key"), "authority_id", "issued: duplicate key")


def read_issued(frozen: DataFrame, batches: list[DataFrame]) -> DataFrame:
    """The register over frozen assignments and the private batches at hand."""
    return combine_issued(frozen, reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)) if batches else frozen


def register_conflicts(batch: DataFrame, issued: DataFrame) -> DataFrame:
    """(kind, value) of ids, offices and batch ids that are taken."""
    parts = []
    for kind, column in (("application", "application_id"), ("office", "authority_id"), ("batch", "batch_id")):
        taken = batch.select(column).distinct().join(issued.select(column), column, "left_semi")
        parts.append(taken.select(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("value")))
    return reduce(lambda a, b: a.union(b), parts)


# Columns that a batch must have.
REQUIRED = ["application_id", "authority_id", "batch_id", "state", "treatment", "assigned_ra", "template_version", "language", "channel"]


def register_batch(batch: DataFrame, issued: DataFrame) -> DataFrame:
    """The register with a new batch."""
    missing = [c for c in REQUIRED if c not in batch.columns]
    if missing:
        raise DataError(f"batch lacks {missing}")
    facts = batch.agg(F.countDistinct("batch_id").alias("ids"), F.count_if(~F.col("treatment").isin("legal_salience", "plain")).alias("arms")).first()
    if facts["ids"] != 1 or facts["arms"]:
        raise DataError("a batch has one id and known arms")
    assert_key(assert_key(batch, "application_id", "batch"), "authority_id", "batch")
    assert_empty(register_conflicts(batch, issued), "batch conflicts with the register")
    return issued.unionByName(batch, allowMissingColumns=True).fillna("")
