import json
import subprocess

import pytest
from pyspark.sql import functions as F

from tessella import commands
from tessella.operators import frames
from tessella.operators.keys import DataError
from tessella.sources import readers


def test_draw_issue_render_ingest(spark, tmp_path):
    names = spark.createDataFrame([(f"Office {i}", "Dept A" if i % 2 else "Dept B", i) for i in range(60)], "office_name string, dept_group string, pos int")
    frame = frames.build_frames({"KA": names.withColumns({"state": F.lit("Karnataka"), "state_code": F.lit("KA")})})
    readers.write_csv_text(frame, str(tmp_path / "frame"))
    readers.write_csv_text(spark.createDataFrame([("KA-009", "none", "b0", "Karnataka")], "application_id string, authority_id string, batch_id string, state string"), str(tmp_path / "issued"))
    stamp = {"template_version": "v1", "language": "en", "channel": "post"}
    config = {"batch_id": "b1", "seed": 3, "n_treated": 6, "blocks": ["dept_group"], "assistants": ["RA1", "RA2"], "stamp": stamp, "state_codes": ["KA"], "design": {"n": 20}}
    (tmp_path / "c.yaml").write_text(json.dumps(config))
    args = [spark, str(tmp_path / "frame"), str(tmp_path / "issued"), str(tmp_path / "c.yaml"), str(tmp_path / "batch")]
    assert commands.draw(*args)["n"] == 20
    with pytest.raises(DataError, match="exists"):
        commands.draw(*args)
    assert commands.issue(spark, str(tmp_path / "batch"), str(tmp_path / "issued"), str(tmp_path / "register")) == 1
    register = readers.VersionedState(spark, str(tmp_path / "register")).load()["issued"]
    assert register.count() == 21 and {"KA-010", "KA-029"} <= {r[0] for r in register.select("application_id").collect()}
    for name, text in (("t.txt", "To {office_name}: {treatment_paragraph}{filer_name}"), ("p.txt", "Law. "), ("f.yaml", "filer_name: Me")):
        (tmp_path / name).write_text(text)
    commands.render(spark, str(tmp_path / "batch"), str(tmp_path / "t.txt"), str(tmp_path / "p.txt"), str(tmp_path / "f.yaml"), str(tmp_path / "letters"))
    written = [p.read_text() for p in (tmp_path / "letters" / "files").glob("RA*/KA-*.txt")]
    assert len(written) == 20 and sum("Law. " in t for t in written) == 6
    readers.write_csv_text(register.filter("batch_id = 'b1'"), str(tmp_path / "register_csv"))
    intake_config = {
        "statutory_days": {"_default": 30}, "forms": {"filing": {"timestamp": ["Timestamp"], "application_id": ["Application ID"], "filing_outcome": ["Outcome"], "not_filed_reason": [], "filing_date": ["Date filed"], "payment_mode": []}},
        "vocabulary": {"filing_outcome": {"values": ["filed", "not_filed"]}, "not_filed_reason": {"values": ["portal_down"]}, "payment_mode": {"values": ["online"]}},
    }
    (tmp_path / "i.yaml").write_text(json.dumps(intake_config))
    (tmp_path / "export.csv").write_text("Timestamp,Application ID,Outcome,Date filed\none,ka-010,Filed,2026-01-01\n")
    run = [spark, str(tmp_path / "state"), str(tmp_path / "register_csv"), "filing", str(tmp_path / "export.csv"), str(tmp_path / "i.yaml")]
    assert [commands.ingest(*run), commands.ingest(*run)] == [1, 0]
    got = readers.VersionedState(spark, str(tmp_path / "state")).load()["applications"].filter("application_id = 'KA-010'").first()
    assert got["due_date"] == "2026-01-31"


def test_privacy_scan_of_tracked_files(spark, tmp_path, capsys):
    git = lambda *a: subprocess.run(["git", "-C", str(tmp_path), *a], check=True, capture_output=True)
    (tmp_path / "a.txt").write_text("write to me@x.org")
    (tmp_path / "b.txt").write_text("nothing")
    git("init", "-q"), git("add", ".")
    known = readers.file_digests(spark, str(tmp_path), "b.txt").withColumn("path", F.lit("b.txt"))
    readers.write_csv_text(known, str(tmp_path / "manifest"))
    assert commands.check_privacy(spark, str(tmp_path), str(tmp_path / "manifest")) == 1 and "a.txt: contact details" in capsys.readouterr().out


def test_publish_reads_paths_relative_to_the_sources(spark, tmp_path):
    for folder in ("a", "b"):
        (tmp_path / "src" / folder).mkdir(parents=True)
        (tmp_path / "src" / folder / "same.txt").write_text(folder)
    readers.write_csv_text(readers.relative_digests(spark, str(tmp_path / "src")), str(tmp_path / "manifest"))
    assert {r["path"] for r in readers.read_manifest(spark, str(tmp_path / "manifest")).collect()} == {"a/same.txt", "b/same.txt"}
    rows = spark.createDataFrame([("A-1", "o1", "b1", "RA1", "secret")], "application_id string, authority_id string, batch_id string, assigned_ra string, pio_name string")
    readers.write_csv_text(rows, str(tmp_path / "rows"))
    readers.write_csv_text(spark.createDataFrame([("o1", "Office", "x")], "authority_id string, office_name string, pio_email string"), str(tmp_path / "frame"))
    readers.write_csv_text(spark.createDataFrame([("b1", "t.txt", "plain", "v1")], "batch_id string, path string, treatment string, template_version string"), str(tmp_path / "instruments"))
    commands.publish(spark, *(str(tmp_path / n) for n in ("src", "manifest", "frame", "rows", "instruments", "out")))
    assert spark.read.json(str(tmp_path / "out" / "site" / "instruments")).first()["name"] == "plain v1"
    assert "pio_email" not in spark.read.json(str(tmp_path / "out" / "site" / "authorities")).columns
    (tmp_path / "src" / "a" / "same.txt").write_text("other")
    with pytest.raises(DataError, match="manifest"):
        commands.publish(spark, *(str(tmp_path / n) for n in ("src", "manifest", "frame", "rows", "instruments", "out2")))


def test_collect_goes_on(spark, tmp_path):
    page = '<table><tr><td>1</td><td><div class="text-primary">Head</div></td><td><a href="/show_sub_office/1">m</a></td></tr></table>'
    leaf = "<table><tr><td>1</td><td>Sub</td><td></td></tr></table>"
    assert commands.collect(spark, "https://x.org/", str(tmp_path / "s"), lambda u: leaf if "sub" in u else page, 0) == 3
    assert commands.collect(spark, "https://x.org/", str(tmp_path / "s"), lambda u: 1 / 0) == 3
