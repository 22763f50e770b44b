"""Command line: python -m tessella.commands COMMAND ... Each command reads its inputs, runs the operators and writes new folders; none overwrites."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessella.operators import intake, letters, privacy, release, sampling, tree
from tessella.operators.keys import DataError, differing_rows
from tessella.session import build_session
from tessella.sources import portal, readers, shared


def draw(spark: SparkSession, frame: str, issued: str, config: str, out: str) -> dict:
    """Draw a batch into a new folder: assignments, worklists and metadata."""
    if shared.exists(spark, out):
        raise DataError(f"{out} exists")
    c = readers.read_yaml(config)
    register = readers.read_csv_text(spark, issued)
    if "batch_id" in register.columns and register.filter(F.col("batch_id") == c["batch_id"]).limit(1).count():
        raise DataError("batch_id is taken")
    design = sampling.Design(**c["design"])
    rows, meta = sampling.draw_batch(readers.read_csv_text(spark, frame), register, design, c["seed"], c["batch_id"], c["n_treated"], c.get("blocks", []), c["assistants"], c.get("stamp", {}), c.get("state_codes", []))
    readers.write_csv_text(rows, f"{out}/assignments")
    release.write_worklists(rows, f"{out}/worklists")
    written = readers.read_csv_text(spark, f"{out}/assignments")
    meta |= {"config": c, "assignments_sha256": sampling.table_digest(written)}
    shared.put_text(spark, f"{out}/meta.json", json.dumps(meta, indent=1))
    return meta


def issue(spark: SparkSession, batch: str, issued: str, out: str) -> int:
    """Add an untouched batch to the register, written as a new version."""
    rows = readers.read_csv_text(spark, f"{batch}/assignments")
    meta = json.loads(shared.get_text(spark, f"{batch}/meta.json"))
    if sampling.table_digest(rows) != meta["assignments_sha256"]:
        raise DataError("assignments were changed after the draw")
    return readers.VersionedState(spark, out).save({"issued": release.register_batch(rows, readers.read_csv_text(spark, issued))})


def render(spark: SparkSession, batch: str, template: str, paragraph: str, filer: str, out: str) -> None:
    """One letter for each assignment of a batch: a table in out/table, files in out/files."""
    config = json.loads(shared.get_text(spark, f"{batch}/meta.json"))["config"]
    texts = shared.get_text(spark, template), shared.get_text(spark, paragraph)
    letters.write_letters(letters.render_letters(readers.read_csv_text(spark, f"{batch}/assignments"), *texts, readers.read_yaml(filer), config.get("letter")), f"{out}/table")
    letters.export_letters(spark, f"{out}/table", f"{out}/files")


def ingest(spark: SparkSession, state: str, issued: str, form: str, export: str, config: str) -> int:
    """Put a form export through the intake; returns the number of new submissions."""
    c = readers.read_yaml(config)
    store = readers.VersionedState(spark, state)
    register = readers.read_csv_text(spark, issued)
    now = intake.Intake(**store.load()) if store.version() else intake.new_intake(register)
    now = intake.sync_intake(now, register)
    # One export file is read whole, so that a row's place in it is known.
    raw = readers.read_csv_text(spark, export).coalesce(1).withColumn("pos", F.monotonically_increasing_id())
    rules = spark.createDataFrame([(s, int(d)) for s, d in c["statutory_days"].items()], "state string, statutory_days int")
    words = {k: intake.choice_map(v["values"], v.get("labels", {}), v.get("extra")) for k, v in c["vocabulary"].items()}
    done = intake.apply_form(now, intake.read_form(raw, c["forms"][form]), form, rules, words, c.get("outbound", []))
    before = now.submissions.count()
    store.save({"applications": done.applications, "events": done.events, "submissions": done.submissions}, intake.STATE_KEYS)
    return store.load()["submissions"].count() - before


def check_privacy(spark: SparkSession, root: str, manifest: str) -> int:
    """Print findings in tracked files; returns their number. An empty manifest path means that no file is known."""
    files = readers.file_texts(spark, root, readers.tracked_files(root))
    known = readers.read_manifest(spark, manifest) if manifest else spark.createDataFrame([], "path string, sha256 string")
    found = 0
    for row in privacy.private_findings(files, known).toLocalIterator():
        print(f"{row['path']}: {row['reason']}")
        found += 1
    return found


def collect(spark: SparkSession, url: str, state: str, fetch=None, pause: float = 1.0) -> int:
    """Crawl a portal, keeping every page and saving the nodes after every level; a second run goes on from there. One task asks the portal, or the driver by `fetch`."""
    store = readers.VersionedState(spark, f"{state}/nodes")

    def save(nodes):
        store.save({"nodes": nodes}, {"nodes": ["node_id"]})
        return store.load()["nodes"]

    start = store.load()["nodes"] if store.version() else tree.start_crawl(spark, url)
    if fetch is None:
        return portal.crawl_pages(start, f"{state}/pages", save, pause=str(pause)).count()
    return tree.crawl(start, fetch, save, tree.PageCache(spark, f"{state}/pages"), pause=pause).count()


def publish(spark: SparkSession, sources: str, manifest: str, frame: str, assignments: str, instruments: str, out: str) -> None:
    """Release and site from verified sources, whose paths in the manifest are relative to their folder."""
    found = readers.relative_digests(spark, sources)
    offices, rows = readers.read_csv_text(spark, frame), readers.read_csv_text(spark, assignments)
    release.build_release(found, readers.read_manifest(spark, manifest), offices, rows, f"{out}/release")
    release.build_site({"authorities": offices, "assignments": rows}, readers.read_csv_text(spark, instruments), f"{out}/site")


def compare(spark: SparkSession, left: str, right: str) -> int:
    """Rows in which two text tables differ."""
    return differing_rows(readers.read_csv_text(spark, left), readers.read_csv_text(spark, right)).count()


COMMANDS = {"draw": draw, "issue": issue, "render": render, "ingest": ingest, "check-privacy": check_privacy, "collect": collect, "publish": publish, "compare": compare}


def main(args: list[str] | None = None) -> int:
    import inspect

    parser = argparse.ArgumentParser(prog="tessella")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, function in COMMANDS.items():
        p = sub.add_parser(name, help=function.__doc__)
        for parameter in list(inspect.signature(function).parameters.values())[1:]:
            if parameter.default is inspect.Parameter.empty:
                p.add_argument(parameter.name)
    given = vars(parser.parse_args(args))
    command = given.pop("command")
    found = COMMANDS[command](build_session(), **given)
    print(found)
    return int(command in ("check-privacy", "compare") and bool(found))


if __name__ == "__main__":
    raise SystemExit(main())
