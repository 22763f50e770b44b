"""Letters: templates rendered for each assignment."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.text import render, safe_file_name
from tessella.operators.keys import DataError, assert_empty, assert_key
from tessella.sources.shared import qualified
from tessella.sources.textfiles import TextFiles

FIELD = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


def render_letter(template: str, values: dict[str, str]) -> str:
    """One letter with plain values."""
    for name in dict.fromkeys(FIELD.findall(template)):
        if values.get(name) is None:
            raise DataError(f"missing template field {name}")
        template = template.replace("{" + name + "}", str(values[name]))
    return template


def render_letters(assignments: DataFrame, template: str, paragraph: str, filer: dict[str, str], config: dict[str, str] | None = None, own_fields: bool = False) -> DataFrame:
    """assignments with `letter`. Fields are the assignment's columns, `authority` for its office, the filer's and the batch's values (period_start, period_end, fee);
    `treatment_paragraph` and `legal_salience` are the paragraph, in the treated arm only. Missing columns and null values fail.

    Fields are replaced in the order in which the template has them, so a field that a value brings along is replaced if its turn comes later. The paragraph is a value like
    others; with own_fields its fields are replaced before it is put in.
    """
    treated = ("treatment_paragraph", "legal_salience")
    given = {k: str(v) for k, v in {**(config or {}), **filer}.items() if v is not None}
    wanted = [n for n in dict.fromkeys(FIELD.findall(template) + (FIELD.findall(paragraph) if own_fields else [])) if n not in treated]
    source = {n: "office_name" if n == "authority" and n not in assignments.columns else n for n in wanted}
    columns = {n: F.col(c).cast("string") for n, c in source.items() if n not in given and c in assignments.columns}
    if missing := [n for n in wanted if n not in columns and n not in given]:
        raise DataError(f"missing template field {missing[0]}")
    plain = {**columns, **{n: F.lit(given[n]) for n in wanted if n in given}}
    inserted = render(F.lit(paragraph), {n: plain[n] for n in dict.fromkeys(FIELD.findall(paragraph)) if n in plain}) if own_fields else F.lit(paragraph)
    text = F.when(F.col("treatment") == "legal_salience", inserted).otherwise(F.lit(""))
    lacking = F.lit(False)
    for column in columns.values():
        lacking = lacking | column.isNull()
    assert_empty(assignments.filter(lacking).select("application_id"), "missing template value")
    return assignments.withColumn("letter", render(F.lit(template), {n: text if n in treated else plain[n] for n in dict.fromkeys(FIELD.findall(template))}))


def write_letters(letters: DataFrame, path: str) -> None:
    """A table of letters (application_id, letter) with a folder for each assistant, in any file system."""
    assert_empty(letters.filter(~safe_file_name("assigned_ra") | ~safe_file_name("application_id")).select("application_id"), "unsafe file name")
    letters.select("assigned_ra", "application_id", "letter").write.partitionBy("assigned_ra").json(path)


def export_letters(spark: SparkSession, path: str, root: str) -> int:
    """root/<assistant>/<application>.txt for printing, from a written table of letters; the tasks write the files. Returns their number."""
    found = spark.read.schema("assigned_ra string, application_id string, letter string").json(path)
    assert_key(found, "application_id", "letters")
    spark.dataSource.register(TextFiles)
    place = F.concat_ws("/", "assigned_ra", F.concat("application_id", F.lit(".txt")))
    found.select(place.alias("path"), F.col("letter").alias("text")).write.format("text_files").mode("append").save(qualified(spark, root))
    return found.count()


def word_count(text: str = "letter"):
    """Words of a text, for portals that limit them."""
    return F.regexp_count(F.col(text), F.lit(r"\S+")).cast("long")
