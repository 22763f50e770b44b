import hashlib
import json
import os
import subprocess
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessella.functions import text as tx
from tessella.operators import allocate, frames, intake, keys, letters, privacy, release, sampling, tree
from tessella.operators.allocate import apportion, apportion_table
from tessella.operators.keys import DataError
from tessella.sources import readers
from tessella.sources import state as state_log
from tessella.streaming import intake_stream


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# --- apportionment


def test_apportion_values():
    assert list(apportion({"a": 4, "b": 3, "c": 2}, 4).values()) == [2, 1, 1]
    assert list(apportion({"a": 9, "b": 1}, 5, {"a": 3, "b": 2}).values()) == [3, 2]
    assert list(apportion({"a": 1, "b": 1, "c": 1}, 2).values()) == [1, 1, 0]
    assert sum(apportion({"a": 5, "b": 8}, 10, minimum={"a": 4, "b": 4}).values()) == 10
    with pytest.raises(DataError, match="cannot be met"):
        apportion({"a": 1}, 2)
    with pytest.raises(DataError, match="positive weight"):
        apportion({"a": 0}, 1, {"a": 2})


@pytest.mark.parametrize("total", [0, 1, 7, 20, 33])
def test_apportion_table_equals_driver_form(spark, monkeypatch, total):
    groups = {"a": (9, 5, 1), "b": (1, 4, 0), "c": (30, 12, 2), "d": (0, 3, 0), "e": (7, 12, 3), "f": (7, 3, 1)}
    low, high = sum(g[2] for g in groups.values()), sum(g[1] for k, g in groups.items() if k != "d")
    total = max(low, min(total, high))
    rows = spark.createDataFrame([(k, *v) for k, v in groups.items()], "g string, w long, cap long, lo long")
    expected = apportion({k: v[0] for k, v in groups.items()}, total, {k: v[1] for k, v in groups.items()}, {k: v[2] for k, v in groups.items()})
    assert {r["g"]: r["allocated"] for r in apportion_table(rows, total, "g", "w", "cap", "lo").collect()} == expected
    monkeypatch.setattr(allocate, "DRIVER_GROUPS", 3)  # the rounds of a table too large for the driver
    assert {r["g"]: r["allocated"] for r in apportion_table(rows, total, "g", "w", "cap", "lo").collect()} == expected


@pytest.mark.parametrize("few", [1, 10_000])
def test_infeasible_totals_fail(spark, monkeypatch, few):
    monkeypatch.setattr(allocate, "DRIVER_GROUPS", few)
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "g string, w long")
    for total, why in ((5, "cannot be met"), (-1, "")):
        with pytest.raises(DataError, match=why):
            allocate.apportion_once(rows, total, "g", "w")
    with pytest.raises(DataError, match="duplicate key"):
        allocate.apportion_once(rows.union(rows), 2, "g", "w")
    ten = spark.createDataFrame([(i, "s") for i in range(10)], "k int, b string")
    with pytest.raises(DataError):
        sampling.assign_treatments(ten, 15, ["b"], 1, "k")


# --- sampling


def office_frame(spark, n=100):
    return spark.createDataFrame([(f"office-{i:03d}", "KA", "Karnataka", "A" if i <= n // 2 else "B", f"Name {i}") for i in range(1, n + 1)], "authority_id string, state_code string, state string, dept_group string, office_name string")


def test_draw_batch(spark):
    frame = office_frame(spark)
    issued = spark.createDataFrame([("KA-180", "office-001")], "application_id string, authority_id string")
    stamp = {"template_version": "v1", "language": "en", "channel": "post"}
    more = {"stamp": stamp, "state_codes": ["KA"]}
    draw = lambda f, **k: sampling.draw_batch(f, issued, sampling.Design(40), 7, "b1", 12, ["dept_group"], ["w", "x", "y", "z"], **{**more, **k})[0]
    rows = draw(frame).collect()
    assert len(rows) == 40 and sum(r["treatment"] == "legal_salience" for r in rows) == 12
    assert {sum(r["assigned_ra"] == a for r in rows) for a in "wxyz"} == {10}
    assert min(r["application_id"] for r in rows) == "KA-181" and "office-001" not in {r["authority_id"] for r in rows}
    again = draw(frame.orderBy(F.desc("authority_id")).repartition(3)).collect()
    assert {(r["application_id"], r["authority_id"], r["treatment"], r["assigned_ra"]) for r in rows} == {(r["application_id"], r["authority_id"], r["treatment"], r["assigned_ra"]) for r in again}
    both = frame.union(frame.withColumns({"authority_id": F.concat(F.lit("t"), "authority_id"), "state_code": F.lit("TN")}))
    assert {r["authority_id"] for r in draw(both).collect()} == {r["authority_id"] for r in rows}  # other states' offices are out
    assert {r["application_id"][:2] for r in draw(both, state_codes=["KA", "TN"]).collect()} == {"KA", "TN"}
    for bad in ({"state_codes": []}, {"stamp": {"channel": "post"}}, {"stamp": {**stamp, "language": ""}}):
        with pytest.raises(DataError, match="needs"):
            draw(frame, **bad)
    with pytest.raises(DataError, match="duplicate key"):
        draw(frame.union(frame))


def test_samples_by_large_quotas_are_the_same(spark, monkeypatch):
    rows = office_frame(spark)
    quotas = spark.createDataFrame([("A", 7), ("B", 3)], "dept_group string, allocated long")
    pick = lambda: {r["authority_id"] for r in sampling.sample_per_group(rows, quotas, "dept_group", 5, "authority_id").collect()}
    small = pick()
    assert len(small) == 10
    for ranked, digits in ((1, 3), (3, 1), (20, 1)):
        monkeypatch.setattr(sampling, "RANKED", ranked)
        monkeypatch.setattr(sampling, "DIGITS", digits)
        assert pick() == small
    whole = spark.createDataFrame([("A", 10_000), ("B", 0)], "dept_group string, allocated long")
    assert sampling.sample_per_group(rows, whole, "dept_group", 5, "authority_id").count() == rows.filter("dept_group = 'A'").count()


def test_a_stratum_of_millions_is_not_ranked(spark):
    """Half of one stratum is drawn; the ranked rows are those of one of 4096 hash prefixes."""
    rows = spark.range(3_000_000).select(F.col("id").alias("k"), F.lit("s").alias("g"))
    quotas = spark.createDataFrame([("s", 1_500_000)], "g string, allocated long")
    drawn = sampling.sample_per_group(rows, quotas, "g", 5, "k")
    assert drawn.count() == 1_500_000
    ends = rows.select(F.when(F.col("k").isNotNull(), sampling.draw_hash(5, "select", "k")).alias("h"), "k")
    cut = ends.join(drawn.select("k"), "k", "left_anti").agg(F.min("h")).first()[0]
    assert ends.join(drawn.select("k"), "k").agg(F.max("h")).first()[0] < cut
    assert sampling.sample_rows(rows, 1_000_000, 5, "k").count() == 1_000_000


def test_table_digests(spark):
    d = lambda *rows: sampling.table_digest(spark.createDataFrame(list(rows), "a string, b string"))
    assert d(("x", None), ("y", "z")) == d(("y", "z"), ("x", None)) and len(d()) == 64
    assert len({d(("x", None)), d((None, "x")), d(("x", "")), d(("x", None), ("x", None)), d(("=x", "-")), d()}) == 6


def test_tier_quotas(spark):
    rows = [(str(i), g, t) for i, (g, t) in enumerate((g, t) for g in "AB" for t in ["Department", "Head of Department", *["Sub Office"] * 6])]
    frame = spark.createDataFrame(rows, "authority_id string, dept_group string, tier string")
    design = sampling.Design(12, "department_tier_quotas", tier_quotas={"Department": 1, "Head of Department": 1, "Sub Office": 2})
    got = [r["tier"] for r in sampling.select_offices(frame, design, 3).collect()]
    assert len(got) == 12 and got.count("Department") == 2 and got.count("Sub Office") == 8
    with pytest.raises(DataError, match="certainty tier"):
        sampling.select_offices(frame.filter("tier = 'Sub Office'"), design, 3)
    with pytest.raises(DataError, match="certainty tier"):
        sampling.select_offices(frame, sampling.Design(12, "department_tier_quotas", tier_quotas={"Head of Department": 1, "Sub Office": 2}), 3)
    with pytest.raises(DataError, match="larger"):
        sampling.select_offices(frame, sampling.Design(99, "department_tier_quotas", tier_quotas=design.tier_quotas), 3)
    with pytest.raises(DataError, match="strategy"):
        sampling.select_offices(frame, sampling.Design(1, "other"), 3)
    with pytest.raises(DataError):
        sampling.sample_rows(frame, 99, 1, "authority_id")


def test_assistant_balance(spark):
    rows = spark.createDataFrame([(i, "legal_salience" if i < 3 else "plain", "s" + str(i % 2)) for i in range(10)], "k int, treatment string, randomization_stratum string")
    loads = sampling.assign_assistants(rows, list("abcd"), 1, "k").groupBy("assigned_ra").count().collect()
    assert max(r["count"] for r in loads) - min(r["count"] for r in loads) <= 1


# --- text, keys, frames


def test_text_functions(spark):
    v = lambda c: value(spark, c)
    assert v(tx.normalize_text(F.lit(" a   b\n"))) == "a b" and v(tx.normalize_text(F.lit(None).cast("string"))) == ""
    assert v(tx.form_key(F.lit(" What happened? "))) == "what happened" and v(tx.match_key(F.lit("A-b 1"))) == "ab1"
    assert v(tx.application_id(F.lit("TN"), F.lit(1014))) == "TN-1014" and v(tx.application_id(F.lit("KA"), F.lit(7))) == "KA-007"
    key = lambda *p: tx.authority_key(*map(F.lit, p))
    one, same, two = (v(tx.authority_id(k, F.lit(n))) for k, n in ((key("S", "An  Office", "d", ""), 1), (key("s", "an office ", "D", ""), 1), (key("s", "an office", "d", ""), 2)))
    assert one == same != two and len(one) == 12
    assert v(tx.department_group(F.lit("Public Works & Roads Department (Unit 3)"), "TN")) == "PUBLIC WORKS AND ROADS"
    assert v(tx.department_group(F.lit("Taluk Office - Mysuru, Department of Revenue"), "KA")) == "REVENUE"
    assert v(tx.department_group(F.lit("(x)"), "TN")) == "UNKNOWN" and v(tx.department_group(F.lit("A &amp; B"), "TN")) == "A AND AMP; B"
    assert v(tx.has_contact_details(F.lit("Call 9800000123"))) and v(tx.has_contact_details(F.lit("a.b@c.org"))) and not v(tx.has_contact_details(F.lit("No 19800000123 x")))
    assert [v(tx.is_iso_date(F.lit(d), True)) for d in ("2026-02-28", "2026-02-30", "", "26-1-1")] == [True, False, False, False] and v(tx.is_iso_date(F.lit("")))
    assert v(tx.render(F.lit("{a}-{b}"), {"a": F.lit("$1 \\1"), "b": F.lit("x")})) == "$1 \\1-x"


def test_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4)], "k string, v int")
    assert {(r["value"], r["reason"]) for r in keys.key_violations(rows, "k").collect()} == {("a", "duplicate"), ("", "blank")}
    with pytest.raises(DataError, match="duplicate key"):
        keys.assert_key(rows, "k")
    with pytest.raises(DataError, match="missing column"):
        keys.assert_key(rows, "z")
    with pytest.raises(DataError, match="one to one"):
        keys.one_to_one(rows, rows.limit(2).withColumnRenamed("v", "w"), "k", "v", "w")
    with pytest.raises(DataError, match="no match"):
        keys.mandatory_lookup(rows.filter("k = 'a'"), rows.filter("k = ''").select("k"), "k", "x")
    keys.assert_same_rows(rows, rows.orderBy("v"), "copy")
    with pytest.raises(DataError, match="differs"):
        keys.assert_same_rows(rows, rows.limit(3), "copy")


def test_frames(spark):
    names = spark.createDataFrame([("Roads Office",), ("Mysuru  - Office of works",), ("A, B - Office",), ("A name of more than thirty characters - Office",)], "office_name string")
    legacy = spark.createDataFrame([("ROADS-OFFICE", "Old", "b", 1), ("roads office", "New", "c", 2)], "office_name string, district string, block string, pos int")
    flat = frames.flat_frame(names, legacy, "KA", "Karnataka", "p")
    assert {(r["office_name"][:5], r["district"], r["block"]) for r in flat.collect()} == {("Roads", "New", "c"), ("Mysur", "Mysuru", ""), ("A, B ", "", ""), ("A nam", "", "")}
    doubled = flat.union(flat).withColumn("pos", F.monotonically_increasing_id())
    full = frames.normalize_frame(doubled, ["pos"])
    assert full.columns == frames.FRAME_COLUMNS and full.select("authority_id").distinct().count() == 8
    assert frames.union_frames([full]).count() == 8
    with pytest.raises(DataError):
        frames.union_frames([full, full])
    places = spark.createDataFrame([('"An office"', "NA", "x", 1), ("an  Office", "d", "-", 2)], "office_name string, district string, block string, pos int")
    cats = spark.createDataFrame([("an office", 7, "T1", "D", 1), ("An Office", 9, "T2", 'Dep"t', 2)], "office_name string, node_id int, tier string, tree_department string, pos int")
    found = frames.categorized_frame(cats, places, "TN", "Tamil Nadu", "p")
    assert found.columns == frames.FRAME_COLUMNS
    built = frames.build_frames({"TN": found, "KA": flat.withColumn("pos", F.monotonically_increasing_id())}, {"TN": found})
    assert {"TN-7", "TN-9"} <= {r["authority_id"] for r in built.collect()} and built.count() == 6
    elsewhere = legacy.withColumn("state", F.lit("Kerala"))
    assert {r["district"] for r in frames.flat_frame(names, elsewhere, "TG", "Telangana", "p").collect()} == {""}
    assert [(r["authority_id"], r["tier"], r["district"], r["block"], r["dept_group"]) for r in found.orderBy("authority_id").collect()] == [("TN-7", "T1", "", "x", "D"), ("TN-9", "T2", "d", "", "Dep't")]
    with pytest.raises(DataError, match="one to one"):
        frames.categorized_frame(cats, places.limit(1), "TN", "Tamil Nadu", "p")


# --- intake

VOCABULARY = {
    "filing_outcome": intake.choice_map(["filed", "not_filed"], {"Could not file": "not_filed"}, {"yes": "filed", "no": "not_filed"}),
    "not_filed_reason": intake.choice_map(["portal_down"], {}),
    "payment_mode": intake.choice_map(["online"], {}),
    "event_type": intake.choice_map(["response_received", "acknowledgment"], {}),
    "medium": intake.choice_map(["email"], {}),
}
FIELDS = ["application_id", "timestamp", "filing_outcome", "not_filed_reason", "filing_date", "registration_number", "payment_mode"]


def filing(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"{f} string" for f in FIELDS) + ", pos long")


def intake_state(spark):
    return intake.new_intake(spark.createDataFrame([("TN-001", "TN"), ("TN-002", "XX")], "application_id string, state string"))


def rules(spark):
    return spark.createDataFrame([("TN", 30), ("_default", 45)], "state string, statutory_days int")


def test_filing_last_wins_and_replay(spark):
    state = intake_state(spark)
    rows = filing(spark, ("TN-001", "one", "Could not file", "portal down", "", "", ""), ("TN-001", "two", "Filed", "", "2026-01-01", "R1", "Online"), ("TN-002", "two", "yes", "", "2026-01-01", "", ""))
    done = intake.apply_form(state, rows, "filing", rules(spark), VOCABULARY)
    got = {r["application_id"]: r for r in done.applications.collect()}
    assert got["TN-001"]["filing_outcome"] == "filed" and got["TN-001"]["due_date"] == "2026-01-31" and got["TN-001"]["payment_mode"] == "online" and got["TN-002"]["due_date"] == "2026-02-15"
    assert done.submissions.count() == 3
    fixed = intake.Intake(done.applications.withColumn("notes", F.lit("by hand")), done.events, done.submissions)
    again = intake.apply_form(fixed, rows, "filing", rules(spark), VOCABULARY)
    assert again.submissions.count() == 3 and {r["notes"] for r in again.applications.collect()} == {"by hand"}
    with pytest.raises(DataError, match="changed"):
        intake.apply_form(done, filing(spark, ("TN-001", "two", "Filed", "", "2026-01-02", "R1", "Online")), "filing", rules(spark), VOCABULARY)


@pytest.mark.parametrize("row", [("TN-999", "x", "filed", "", "2026-01-01", "", ""), ("TN-001", "x", "filed", "", "2026-01-01", "", "unknown option"), ("TN-001", "", "filed", "", "2026-01-01", "", ""), ("TN-001", "x", "", "", "", "", ""), ("TN-001", "x", "filed", "", "2026-02-30", "", ""), ("TN-001", "x", "no", "", "", "", ""), ("TN-001", "x", "no", "???", "", "", ""), ("TN-001", "x", "filed", "", "2026-01-01", "", "-")])
def test_bad_filings_fail(spark, row):
    with pytest.raises(DataError):
        intake.apply_form(intake_state(spark), filing(spark, row), "filing", rules(spark), VOCABULARY)


def test_states_without_response_period_fail(spark):
    row = filing(spark, ("TN-002", "x", "filed", "", "2026-01-01", "", ""))
    with pytest.raises(DataError, match="response period"):
        intake.apply_form(intake_state(spark), row, "filing", rules(spark).filter("state = 'TN'"), VOCABULARY)
    unfiled = filing(spark, ("TN-002", "x", "no", "portal down", "", "", ""))
    assert intake.apply_form(intake_state(spark), unfiled, "filing", rules(spark).filter("state = 'TN'"), VOCABULARY).submissions.count() == 1


def test_only_aliases_name_a_field(spark):
    raw = spark.createDataFrame([("own", "alias", "x")], "medium string, `How sent` string, other string")
    assert intake.read_form(raw, {"medium": ["How sent"]}).first()["medium"] == "alias"
    assert intake.read_form(raw, {"medium": ["Remarks"]}).first()["medium"] == ""
    with pytest.raises(DataError, match="ambiguous"):
        intake.read_form(raw.withColumn("OTHER!", F.lit("")), {"medium": ["How sent"]})


def test_updates_and_sync(spark):
    raw = spark.createDataFrame([("a", " tn-001 ", "Response received", "2026-01-05", "Email", 0), ("b", "TN-001", "acknowledgment", "", "", 1)], "Timestamp string, `Application ID` string, `What happened` string, Date string, Medium string, pos long")
    rows = intake.read_form(raw, {"timestamp": ["Timestamp"], "application_id": ["Application ID"], "event_type": ["What happened"], "event_date": ["Date"], "medium": ["Medium"], "notes": []})
    state = intake_state(spark)
    done = intake.apply_form(state, rows, "update", rules(spark), VOCABULARY, ["acknowledgment"])
    assert [(r["event_id"], r["event_type"], r["direction"], r["recorded_at"]) for r in done.events.orderBy("event_id").collect()] == [("1", "response_received", "inbound", "a"), ("2", "acknowledgment", "outbound", "b")]
    assert intake.apply_form(done, rows, "update", rules(spark), VOCABULARY).events.count() == 2
    with pytest.raises(DataError, match="ambiguous"):
        intake.read_form(raw.withColumn("DATE ", F.lit("")), {"event_date": ["Date"]})
    issued = spark.createDataFrame([("TN-001", "TN"), ("TN-002", "XX"), ("TN-003", "TN")], "application_id string, state string")
    assert intake.sync_intake(done, issued).applications.count() == 3
    with pytest.raises(DataError, match="unregistered"):
        intake.sync_intake(done, issued.limit(1))


# --- release, letters, privacy


def register(spark):
    return spark.createDataFrame([("A-1", "o1", "b1", "plain", "w"), ("A-2", "o2", "b1", "legal_salience", "x")], "application_id string, authority_id string, batch_id string, treatment string, assigned_ra string")


def test_register_and_publication(spark):
    r = register(spark)
    assert release.combine_issued(r.orderBy(F.desc("application_id")), r).count() == 2
    for other in (r.withColumn("assigned_ra", F.lit("z")), r.limit(1), r.drop("assigned_ra")):
        with pytest.raises(DataError, match="differs"):
            release.combine_issued(other, r)
    with pytest.raises(DataError, match="duplicate key"):
        release.combine_issued(r, r.withColumn("batch_id", F.lit("b2")))
    full = r.withColumns({c: F.lit("v") for c in ("state", "template_version", "language", "channel")})
    fresh = full.withColumns({"application_id": F.concat("application_id", F.lit("x")), "authority_id": F.concat("authority_id", F.lit("x")), "batch_id": F.lit("b9")})
    assert release.register_batch(fresh, r).count() == 4
    for bad in (full, fresh.withColumn("treatment", F.lit("other")), fresh.drop("channel")):
        with pytest.raises(DataError):
            release.register_batch(bad, r)


def test_release_and_worklists(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "a.txt").write_text("x")
    found = readers.file_digests(spark, str(src))
    frame = spark.createDataFrame([("o1", "S", "Office 1"), ("o2", "S", "Office 2")], "authority_id string, state string, office_name string")
    batch = spark.createDataFrame([("A-1", "S", "Office 1", "w", "secret"), ("A-2", "S", "Office 2", "x", "")], "application_id string, state string, office_name string, assigned_ra string, pio_name string")
    rows = release.combine_batches({"b1": batch}, {"b1": 2}, frame)
    with pytest.raises(DataError, match="expected"):
        release.combine_batches({"b1": batch}, {"b1": 3}, frame)
    with pytest.raises(DataError, match="without office"):
        release.combine_batches({"b1": batch.withColumn("office_name", F.lit("?"))}, {"b1": 2}, frame)
    assert release.build_release(found, found, frame, rows, str(tmp_path / "out")).count() == 2
    with pytest.raises(DataError, match="manifest"):
        release.build_release(found, found.withColumn("sha256", F.lit("0")), frame, rows, str(tmp_path / "out2"))
    assert {r["state_code"] for r in rows.collect()} == {"A"} and {r["batch_id"] for r in rows.collect()} == {"b1"}
    with pytest.raises(DataError, match="catalogue"):
        release.combine_batches({"b1": batch.withColumn("batch_id", F.lit("b2"))}, {"b1": 2}, frame)
    doubled = frame.withColumn("pos", F.lit(2)).union(spark.createDataFrame([("o0", "S", "Office 1", 1)], "authority_id string, state string, office_name string, pos int"))
    assert {r["authority_id"] for r in release.combine_batches({"b1": batch}, {"b1": 2}, doubled).collect()} == {"o0", "o2"}
    sums = readers.read_csv_text(spark, str(tmp_path / "out" / "files"))
    assert sums.count() >= 2 and all(hashlib.sha256((tmp_path / "out" / r["path"]).read_bytes()).hexdigest() == r["sha256"] for r in sums.collect())
    instruments = spark.createDataFrame([("b1", "x/y.txt"), ("b2", "z.txt")], "batch_id string, path string")
    (tmp_path / "given" / "x").mkdir(parents=True)
    with pytest.raises(DataError, match="without file"):
        release.build_site({"assignments": rows, "authorities": frame}, instruments, str(tmp_path / "site0"), str(tmp_path / "given"))
    (tmp_path / "given" / "x" / "y.txt").write_text("letter")
    release.build_site({"assignments": rows, "authorities": frame}, instruments, str(tmp_path / "site"), str(tmp_path / "given"))
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "site" / "instruments")).select("name", "path").collect()] == [("y.txt", "batches/x/y.txt")]
    assert "pio_name" not in spark.read.json(str(tmp_path / "site" / "assignments")).columns
    for secret in (release.write_worklists, lambda a, p: release.build_site({"assignments": a}, instruments, p)):
        with pytest.raises(DataError, match="contact"):
            secret(rows.withColumn("district", F.lit("Call 9800000123")), str(tmp_path / "secret"))
    header = spark.read.option("header", True).csv(str(tmp_path / "site" / "worklists")).columns
    assert "pio_name" not in header
    with pytest.raises(DataError, match="unsafe"):
        release.write_worklists(rows.withColumn("assigned_ra", F.lit("../x")), str(tmp_path / "bad"))


def test_letters(spark, tmp_path):
    assert letters.render_letter("{a} {a}{b}", {"a": "$1 \\1", "b": ""}) == "$1 \\1 $1 \\1"
    with pytest.raises(DataError, match="missing"):
        letters.render_letter("{a}{z}", {"a": "x"})
    a = register(spark).withColumn("office_name", F.lit("O"))
    done = letters.render_letters(a, "To {office_name}. {treatment_paragraph}{filer_name}", "Law. ", {"filer_name": "Me"})
    assert {r["letter"] for r in done.collect()} == {"To O. Me", "To O. Law. Me"}
    letters.write_letters(done, str(tmp_path / "table"))
    assert letters.export_letters(spark, str(tmp_path / "table"), str(tmp_path)) == 2
    assert (tmp_path / "x" / "A-2.txt").read_text() == "To O. Law. Me"
    batch = letters.render_letters(a, "{authority}, {period_start} to {period_end}: {fee}.{legal_salience}", " Law.", {}, {"period_start": "1 May", "period_end": "9 May", "fee": 10})
    assert {r["letter"] for r in batch.collect()} == {"O, 1 May to 9 May: 10.", "O, 1 May to 9 May: 10. Law."}
    braces = letters.render_letters(a.filter("treatment = 'legal_salience'"), "{one}{legal_salience}{two}", "<{one}{two}{three}>", {"one": "{two}{legal_salience}", "two": "2"})
    assert braces.first()["letter"] == letters.render_letter("{one}{legal_salience}{two}", {"one": "{two}{legal_salience}", "two": "2", "legal_salience": "<{one}{two}{three}>"}) == "2<{one}2{three}><{one}2{three}>2"
    with pytest.raises(DataError, match="missing"):
        letters.render_letters(a, "{nobody}", "", {})
    with pytest.raises(DataError, match="missing"):
        letters.render_letters(a.withColumn("office_name", F.lit(None).cast("string")), "{office_name}", "", {})


def test_privacy(spark):
    rows = register(spark).withColumn("new_private_field", F.lit("x"))
    assert privacy.public_assignments(rows.select("authority_id", "application_id", "new_private_field")).columns == ["application_id", "authority_id"]
    with pytest.raises(DataError, match="not public"):
        privacy.check_public(rows)
    with pytest.raises(DataError, match="contact"):
        privacy.check_public(register(spark).withColumn("assigned_ra", F.lit("me@x.org")))
    files = spark.createDataFrame([("a.csv", "application_id,filed_by\nA,Someone", "1"), ("b.csv", "application_id,filed_by\nA,", "2"), ("c.txt", "see /R/2026/12345", "3"), ("renv/d.txt", "a@b.org", "4"), ("private/e", "", "5"), ("k.txt", "a@b.org", "6"), ("l.bin", "a@b.org", "7"), ("m.csv", 'office_name,filed_by\n"A,,B",Someone', "8"), ("n.csv", 'office_name,filed_by\n"A, B",', "9"), ("o.csv", 'office_name,filed_by\n"A\nB","C\n"', "10")], "path string, text string, sha256 string")
    known = files.filter("path = 'k.txt'").select("path", "sha256")
    assert {tuple(r) for r in privacy.private_findings(files, known).collect()} == {("a.csv", "populated private column"), ("m.csv", "populated private column"), ("o.csv", "populated private column"), ("c.txt", "registration number"), ("private/e", "private path")}


# --- sources, crawl, streaming


def test_csv_and_json(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,note\n1," say ""hi"" "\nNA,\n')
    rows = readers.read_csv_text(spark, str(tmp_path / "x.csv")).orderBy("id")
    assert [tuple(r) for r in rows.collect()] == [("1", 'say "hi"'), ("NA", "")]
    readers.write_csv_text(rows, str(tmp_path / "out"))
    assert readers.read_csv_text(spark, str(tmp_path / "out"), ["id", "note"]).count() == 2
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "page_1.json").write_text('["A \n B", "C"]')
    (pages / "page_2.json").write_text(json.dumps(["C ", "D"]))
    (pages / "page_x.json").write_text('["E"]')
    assert {r[0] for r in readers.read_json_names(spark, str(pages)).collect()} == {"A B", "C", "D"}
    with pytest.raises(DataError, match="no pages"):
        readers.read_json_names(spark, str(tmp_path / "out"))
    options = '<select id="MinistryId"><option value="0">--Select--</option><option value="2">b &amp; c</option><option value="1">B &amp; C</option><option value="">x</option></select>'
    assert [tuple(r) for r in readers.portal_options(spark.createDataFrame([(options,)], "html string")).collect()] == [("B &amp; C", "1")]
    twice = '<select name="MinistryId"><option value="9">Same</option><option value="10">Same</option></select>'
    assert [tuple(r) for r in readers.portal_options(spark.createDataFrame([(twice,)], "html string")).collect()] == [("Same", "9")]
    with pytest.raises(DataError, match="select"):
        readers.portal_options(spark.createDataFrame([("<p>",)], "html string"))
    assert [r[0] for r in readers.portal_rows(spark.createDataFrame([("<table><tr><th>n<th>x</tr><tr><td>1</td><td> A  B</td></tr></table>",)], "html string")).collect()] == ["A B"]
    assert readers.second_cells("<table><tr><th>n<th>x</tr><tr><td>1</td><td> A  <b>B</b></td></tr></table>") == ["A B"]


PAGE = '<table><tr><th>No</th><th>Office</th></tr><tr><td>1</td><td><div class="x text-primary">Head</div><div>Hall</div><div>else</div></td><td><a href="/show_sub_office/1">m</a></td></tr><tr><td>2</td><td>Leaf</td><td></td></tr><tr><td>x</td><td>no</td><td></td></tr></table>'
LEAF = "<table><tr><td>1</td><td>Sub</td><td></td></tr></table>"


def test_crawl_resumes(spark, tmp_path):
    offices = readers.office_rows(PAGE, "https://x.org/a")
    assert offices == [{"office_name": "Head", "address": "Hall", "url": "https://x.org/show_sub_office/1", "is_leaf": False}, {"office_name": "Leaf", "address": "", "url": "", "is_leaf": True}]
    seen = []

    def fetch(url):
        seen.append(url)
        return LEAF if "sub" in url else PAGE

    keep = lambda d: spark.createDataFrame(d.collect(), tree.CRAWL_SCHEMA)
    cache = tree.PageCache(spark, str(tmp_path / "pages"))
    first = tree.crawl(tree.start_crawl(spark, "https://x.org/a"), fetch, keep, cache, levels=1)
    done = tree.crawl(first, fetch, keep, cache)
    assert len(seen) == 2 and tree.crawl(done, fetch, keep, cache).count() == 4 and len(seen) == 2
    assert {r["path"] for r in done.collect()} == {"", "Head", "Leaf", "Head > Sub"}
    for login in ("<table>login</table>", "<table><tr><td>1</td><td> </td><td></td></tr></table>"):
        with pytest.raises(DataError, match="table"):
            tree.crawl(tree.start_crawl(spark, "https://x.org/b"), lambda u: login, keep, cache)
        assert "https://x.org/b" not in cache

    def failing(url):
        if "sub" in url:
            raise OSError(url)
        return PAGE

    again = tree.PageCache(spark, str(tmp_path / "other"))
    with pytest.raises(OSError):
        tree.crawl(tree.start_crawl(spark, "https://x.org/a"), failing, keep, again)
    assert tree.crawl(tree.start_crawl(spark, "https://x.org/a"), lambda u: LEAF, keep, again).count() == 4  # the first page is kept
    assert tree.start_crawl(spark, "https://x.org/displayPa.php?a=1", "ROOT").first()["node_id"] == "displayPa"


def test_offices_of_nested_tables():
    inner = "<table><tr><td>x</td><td>y</td></tr></table>"
    page = f'<table><tr><td>1</td><td><div class="text-primary">Head</div><div>Hall{inner}</div></td><td>{inner}</td></tr><tr><td>2</td><td>Leaf{inner}</td><td></td></tr></table>'
    assert [(o["office_name"], o["address"]) for o in readers.office_rows(page, "https://x.org/")] == [("Head", "Hallxy"), ("Leafxy", "")]


def test_closure_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds, written = [], tree.written
    monkeypatch.setattr(tree, "written", lambda df, name: rounds.append(name) or written(df, name))
    chain = spark.range(10_000).select(F.concat(F.lit("n"), "id").alias("node"), F.when(F.col("id") > 0, F.concat(F.lit("n"), F.col("id") - 1)).alias("parent"), F.lit("x").alias("name"))
    got = tree.closure(chain.repartition(8), separator="")
    assert got.agg(F.max("depth"), F.count("*"), F.count_if(F.length("path") == F.col("depth") + 1)).first()[:] == (9_999, 10_000, 10_000)
    assert len(rounds) <= 20


def test_closure_runs_to_the_last_level(spark):
    chain = spark.createDataFrame([(f"n{k}", f"n{k - 1}" if k else "", str(k)) for k in range(6)], "node string, parent string, name string")
    assert {r["depth"] for r in tree.closure(chain).collect()} == set(range(6))
    with pytest.raises(DataError, match="without a root"):
        tree.closure(chain.union(spark.createDataFrame([("a", "b", ""), ("b", "a", "")], chain.schema)))
    with pytest.raises(DataError, match="duplicate key"):
        tree.closure(chain.union(spark.createDataFrame([("n5", "n1", "")], chain.schema)))
    assert tree.closure(chain.limit(0)).count() == 0


def test_state_versions(spark, tmp_path):
    state = readers.VersionedState(spark, str(tmp_path))
    assert state.save({"t": spark.range(3)}) == 1 and state.save({"t": spark.range(5)}) == 2
    assert state.load()["t"].count() == 5 and state.load(1)["t"].count() == 3
    spark.range(9).write.parquet(str(tmp_path / "v=3-dead" / "t"))  # a writer that died
    (tmp_path / "done=9.mark").write_text('{"t": [')  # a mark that was not finished
    assert state.version() == 2 and len(state.load()) == 1 and state.save({"t": spark.range(4)}) == 3
    assert readers.VersionedState(spark, str(tmp_path)).load()["t"].count() == 4


def test_a_second_writer_changes_nothing(spark, tmp_path):
    row = lambda v: {"t": spark.createDataFrame([(1, v)], "k int, v string")}
    readers.VersionedState(spark, str(tmp_path)).save(row("start"))
    a, b = readers.VersionedState(spark, str(tmp_path)), readers.VersionedState(spark, str(tmp_path))
    a.load(), b.load()
    assert a.save(row("a")) == 2
    folders = set(os.listdir(tmp_path))
    with pytest.raises(DataError, match="another writer"):
        b.save(row("b"))
    assert set(os.listdir(tmp_path)) == folders
    c = readers.VersionedState(spark, str(tmp_path))
    assert c.load()["t"].first()["v"] == "a" and b.load()["t"].first()["v"] == "a" and b.save(row("b")) == 3


def test_deltas_hold_changed_rows_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state_log, "COMPACT", 2)
    store = readers.VersionedState(spark, str(tmp_path))
    want = {k: str(k) for k in range(100)}
    table = lambda: {"t": spark.createDataFrame(sorted(want.items()), "k int, v string")}
    store.save(table(), {"t": ["k"]})
    sizes = []
    for step in range(4):
        want[step] = f"changed {step}"
        want[100 + step] = None
        del want[50 + step]
        store.load()
        version = store.save(table(), {"t": ["k"]})
        sizes.append(json.loads((tmp_path / f"done={version}.mark").read_text())["t"][-1].get("rows"))
        assert dict(map(tuple, readers.VersionedState(spark, str(tmp_path)).load()["t"].collect())) == want
    assert sizes == [3, 3, None, 3]  # the third is a base again
    store.save(table(), {"t": ["k"]})
    assert len(json.loads((tmp_path / "done=6.mark").read_text())["t"]) == 2  # nothing changed, nothing written
    with pytest.raises(DataError, match="duplicate key"):
        store.save({"t": table()["t"].union(table()["t"])}, {"t": ["k"]})


def test_stream_of_forms_and_a_batch_played_again(spark, tmp_path):
    fields = "application_id string, timestamp string, event_type string, event_date string, medium string"
    root = str(tmp_path / "state")
    readers.VersionedState(spark, root).save(vars(intake_state(spark)))
    for k, rows in enumerate(([("TN-001", "a", "acknowledgment", "2026-01-05", "email"), ("TN-002", "b", "response received", "", "")], [("TN-001", "c", "response received", "2026-02-01", "")])):
        spark.createDataFrame(rows, fields).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
    stream = spark.readStream.schema(fields).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    apply = intake_stream.intake_batches(spark, root, "update", rules(spark), VOCABULARY)
    for checkpoint in ("c1", "c2"):  # the second run plays all batches again
        intake_stream.run_available(stream, apply, str(tmp_path / checkpoint))
        now = readers.VersionedState(spark, root).load()
        assert sorted((r["event_id"], r["application_id"]) for r in now["events"].collect())[0][0] == "1" and now["events"].count() == now["submissions"].count() == 3
    out = intake_stream.to_folder(str(tmp_path / "out"))
    out(spark.range(3), 7), out(spark.range(3), 7)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_conflicts_forget_ids_after_the_horizon(spark, tmp_path):
    fields = "source_row_id string, payload_sha256 string, at timestamp"
    day = lambda n: datetime(2026, 1, 1) + timedelta(days=n)
    batches = [[("a", "1", day(0)), ("b", "1", day(0)), ("a", "2", day(1))], [("c", "1", day(20)), ("b", "2", day(20))], [("d", "1", day(90))], [("a", "3", day(91)), ("e", "1", day(91))], [("d", "2", day(92))]]
    out, states = [], []
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(fields).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    for k, rows in enumerate(batches):  # every batch is a run of its own: a restart from the checkpoint
        spark.createDataFrame(rows, fields).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
        query = intake_stream.run_available(intake_stream.conflict_stream(stream, "at"), lambda d, n: out.extend(map(tuple, d.collect())), str(tmp_path / "check"))
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted(out) == [("a", "1", "2"), ("b", "1", "2"), ("d", "1", "2")]  # a's first payload is forgotten by day 91
    assert max(states[:2]) >= 3 and states[-1] < 2 * max(states[:2])
    rows = spark.createDataFrame(batches[0] + batches[1], fields)
    assert sorted(map(tuple, intake_stream.payload_conflicts(rows, ["at", "payload_sha256"]).collect())) == [("a", "1", "2"), ("b", "1", "2")]


def test_streaming_ledger_and_conflicts(spark, tmp_path):
    rows = [("a", "1"), ("a", "1"), ("a", "2"), ("b", "3")]
    spark.createDataFrame(rows, "source_row_id string, payload_sha256 string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("source_row_id string, payload_sha256 string").parquet(str(tmp_path / "in"))
    out = []
    intake_stream.run_available(intake_stream.conflict_stream(stream), lambda d, n: out.extend(d.collect()), str(tmp_path / "c1"))
    assert [tuple(r) for r in out] == [("a", "1", "2")]
    kept = []
    for _ in range(2):  # a restart processes nothing twice
        intake_stream.run_available(intake_stream.ledger_stream(stream), lambda d, n: kept.extend(d.collect()), str(tmp_path / "c2"))
    assert sorted(r["source_row_id"] for r in kept) == ["a", "b"]


def test_a_local_session_without_a_shared_folder(tmp_path):
    """A session of its own, since this one has the setting."""
    code = "from tessella.session import build_session\nfrom tessella.sources import shared\ns = build_session('1', 1)\nassert shared.written(s.range(3), 'x').count() == 3 and shared.shared_dir(s) == shared.shared_dir(s)\nprint('fine')"
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, env=os.environ | {"TMPDIR": str(tmp_path)}, cwd=tmp_path)
    assert found.stdout.strip().endswith("fine"), found.stderr[-2000:]
