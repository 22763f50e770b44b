"""What may be published: the allowlist of columns and the search for personal details."""

from __future__ import annotations

import csv
import io
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import REGISTRATION, has_contact_details
from tessella.operators.keys import DataError, assert_empty, assert_key

# The public columns in their order.
PUBLIC_COLUMNS = [
    "application_id", "authority_id", "batch_id", "state", "state_code", "office_name", "dept_group", "district", "block", "portal", "node_id", "tree_department", "tier", "treatment", "assigned_ra",
    "randomization_stratum", "template_version", "language", "channel",
]
# Columns that must be empty in published files, paths that must not be published, and files that are searched.
PRIVATE_COLUMNS = ["registration_number", "filed_by", "pio_name", "pio_email", "pio_phone", "payment_reference", "evidence_url", "screen_recording_url", "document_url"]
PRIVATE_PATH = r"(^|/)(private|intake_raw)/|^config/filers?\.yaml$|\.(rds|sqlite|db|zip)$"
SEARCHED = r"\.(csv|txt|json|md|yaml|yml|html)$"


def public_assignments(rows: DataFrame) -> DataFrame:
    """The allowed columns that are there, in the allowlist's order, after checking key and cells."""
    return check_public(rows.select([c for c in PUBLIC_COLUMNS if c in rows.columns]))


def contact_cells(rows: DataFrame) -> DataFrame:
    """(column) names with a contact detail in some cell, by one pass over the table."""
    found = rows.agg(*[F.coalesce(F.bool_or(has_contact_details(f"`{c}`")), F.lit(False)).alias(c) for c in rows.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("hit")) for c in rows.columns])
    return found.select(F.explode(pairs).alias("p")).filter("p.hit").select("p.column")


def check_public(rows: DataFrame) -> DataFrame:
    """rows, after checking columns, key and cells."""
    unknown = [c for c in rows.columns if c not in PUBLIC_COLUMNS]
    if unknown:
        raise DataError(f"columns that are not public: {unknown}")
    assert_key(rows, "application_id", "assignments")
    assert_empty(contact_cells(rows), "contact details in a public column")
    return rows


def private_findings(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, reason) of files that must not be published; files has path, text and sha256.

    Paths are checked for every file. Contents are searched in text files outside renv/, except files whose digest equals the manifest's.
    """
    known = manifest.select(F.col("path").alias("__path"), F.col("sha256").alias("__sha"), F.lit(True).alias("__known"))
    marked = files.join(known, (F.col("path") == F.col("__path")) & (F.col("sha256") == F.col("__sha")), "left")
    searched = F.col("__known").isNull() & F.col("path").rlike(SEARCHED) & ~F.col("path").startswith("renv/")
    checks: list[tuple[str, Column]] = [
        ("private path", F.col("path").rlike(PRIVATE_PATH)),
        ("populated private column", populated_private_column(F.when(searched & F.col("path").endswith(".csv"), F.col("text")))),
        ("contact details", searched & has_contact_details("text")),
        ("registration number", searched & F.coalesce(F.col("text").rlike(REGISTRATION), F.lit(False))),
    ]
    reasons = F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in checks]), lambda r: r.isNotNull())
    return marked.select("path", F.explode(reasons).alias("reason"))


def populated_private_column(text: Column) -> Column:
    """Whether a CSV text has a private column with a value in some record; quotes, commas and line ends inside fields are read as CSV has them."""

    @F.pandas_udf("boolean")
    def populated(texts: pd.Series) -> pd.Series:
        return pd.Series([_has_private_value(t) for t in texts], dtype=bool)

    # Only texts that name such a column are parsed: a Python function sees every row, so the others reach it as null.
    named = reduce(lambda a, b: a | b, [text.contains(c) for c in PRIVATE_COLUMNS])
    return F.coalesce(populated(F.when(named, text)), F.lit(False))


def _has_private_value(text: str | None) -> bool:
    csv.field_size_limit(2**31 - 1)
    records = csv.reader(io.StringIO(text or "", newline=""))
    header = [h.strip(" \t\ufeff") for h in next(records, [])]
    private = [k for k, h in enumerate(header) if h in PRIVATE_COLUMNS]
    return any(r[k].strip(" \t") for r in records for k in private if k < len(r))
