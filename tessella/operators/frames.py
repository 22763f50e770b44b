"""Population frames: offices of several states in one schema with stable identifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import authority_id, authority_key, clean_location, clean_office_text, department_group, match_key, normalize_key
from tessella.operators.keys import DataError, assert_key, assert_same_rows, lookup_keep_last, occurrence, one_to_one

FRAME_COLUMNS = ["authority_id", "state", "state_code", "office_name", "district", "block", "portal", "node_id", "tree_department", "tier", "dept_group"]
LONG_NAME = 30


def blank(name: str, rows: DataFrame) -> Column:
    """A column, or blanks where a table has none or nulls."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in rows.columns else F.lit("")


def flat_frame(names: DataFrame, legacy: DataFrame, code: str, state: str, portal: str) -> DataFrame:
    """Offices of a portal list with places from an older list, matched by stripped name; of repeated older rows the last counts.

    The older list is cut to the state where it has a column state. In the state whose office names begin with a place, an unmatched office gets what stands before its first dash, unless that is long or lists several.
    """
    if "state" in legacy.columns:
        legacy = legacy.filter(F.col("state") == state)
    values = F.col("portal_value_id") if "portal_value_id" in names.columns else F.lit("")
    listed = names.select("office_name", values.alias("portal_value_id"), match_key("office_name").alias("key"))
    older = legacy.select(match_key("office_name").alias("key"), *[F.col(c).alias(f"old_{c}") for c in ("district", "block")], F.col("pos"), F.lit(True).alias("matched"))
    joined = lookup_keep_last(listed, older, ["key"], "pos")
    guess = F.trim(F.regexp_replace("office_name", r"\s*-.*", ""))
    guess = F.when((F.char_length(guess) > LONG_NAME) | guess.contains(","), F.lit("")).otherwise(guess)
    district = F.coalesce("old_district", F.lit(""))
    if code == "KA":
        district = F.when(F.col("matched"), district).otherwise(guess)
    return joined.select(
        "office_name", F.lit(code).alias("state_code"), F.lit(state).alias("state"), F.lit(portal).alias("portal"), district.alias("district"), F.coalesce("old_block", F.lit("")).alias("block"),
        department_group("office_name", code).alias("dept_group"), "portal_value_id",
    )


def normalize_frame(frame: DataFrame, order: list[str]) -> DataFrame:
    """The canonical columns; offices with one key are numbered in order and so get identifiers of their own."""
    full = frame.select(*[blank(c, frame).alias(c) for c in FRAME_COLUMNS if c != "authority_id"], *[F.col(c).alias(f"__{c}") for c in order])
    key = authority_key("state", "office_name", "district", "block")
    keyed = full.withColumn("__key", key).withColumn("__n", occurrence(["__key"], [f"__{c}" for c in order]))
    return keyed.withColumn("authority_id", authority_id(F.col("__key"), F.col("__n"))).select(FRAME_COLUMNS)


def categorized_frame(tree: DataFrame, places: DataFrame, code: str, state: str, portal: str) -> DataFrame:
    """A tree of categorised offices with places from a list that must match it one to one, the k-th repeat of a name with its k-th repeat.

    tree has office_name, node_id, tree_department, tier and pos; places has office_name, district, block and pos. Offices are told by their node.
    """
    left = tree.withColumn("__key", normalize_key(clean_office_text("office_name")))
    right = places.select(normalize_key(clean_office_text("office_name")).alias("__key"), F.col("pos").alias("__pos"), "district", "block")
    joined = one_to_one(left, right, "__key", "pos", "__pos")
    department = clean_office_text("tree_department")
    values = {"authority_id": F.concat(F.lit(f"{code}-"), F.col("node_id").cast("string")), "state": F.lit(state), "state_code": F.lit(code), "office_name": clean_office_text("office_name")}
    values |= {"district": clean_location("district"), "block": clean_location("block"), "portal": F.lit(portal), "node_id": F.col("node_id").cast("string")}
    values |= {"tree_department": department, "tier": clean_office_text("tier"), "dept_group": department}
    return joined.select([values[c].alias(c) for c in FRAME_COLUMNS])


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """All states in one frame with unique identifiers."""
    if not frames:
        raise DataError("no frames")
    return assert_key(reduce(lambda a, b: a.unionByName(b), frames), "authority_id", "frame")


def assert_frozen(rebuilt: DataFrame, frozen: DataFrame, state: str) -> DataFrame:
    """rebuilt, after checking that it equals the frozen frame."""
    assert_same_rows(rebuilt, frozen, f"frame of {state}")
    return rebuilt


def pool_small_groups(rows: DataFrame, group: str, least: int = 5, pooled: str = "OTHER") -> DataFrame:
    """Groups of fewer rows than `least` as one group."""
    sizes = rows.groupBy(group).agg(F.count("*").alias("__n"))
    return rows.join(sizes, group).withColumn(group, F.when(F.col("__n") < least, pooled).otherwise(F.col(group))).drop("__n")


def build_frames(states: dict[str, DataFrame], frozen: dict[str, DataFrame] | None = None) -> DataFrame:
    """The canonical frame of all states; a state with a frozen frame must rebuild to it exactly.

    Offices of a categorised tree keep the identifiers of their nodes; those of portal lists (tables with pos) get theirs from their keys.
    """
    built = []
    for state, rows in states.items():
        frame = rows.select(FRAME_COLUMNS) if set(FRAME_COLUMNS) <= set(rows.columns) else normalize_frame(rows, ["pos"])
        built.append(assert_frozen(frame, frozen[state], state) if frozen and state in frozen else frame)
    return union_frames(built)
