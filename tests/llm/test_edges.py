"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names: every operator has a defined result."""

import pytest
from pyspark.sql import functions as F

from tessella.llm import chunking, hilbert, html_text, langid, lattice, media, minhash, mixing, token_counts, toxicity

LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (1, "The first text about rivers and hills.", "en", "a", 10),
    (2, "The first text about rivers and hills.", "en", "a", 10),
    (2, "The first text about rivers and hills.", "en", "a", 10),
    (3, "", "en", None, 0),
    (4, None, None, "b", None),
    (5, LONG, "fr", "b", 1),
    (6, " \n\t ", "fr", "a", None),
    (None, "No id here at all.", "fr", "a", 3),
    (None, None, None, None, None),
    (7, "1234 !!", "en", "c", 7),
    (8, "One", "fr", "c", 7),
]
CLASH = ["id", "comp", "digest", "n", "a", "b", "signature", "shingles", "tree", "p1", "p2", "range", "tail", "word", "w", "score", "place", "part", "local", "rank", "size", "tokens", "epoch", "block", "source_key", "toxic", "grp", "fold", "predicted", "piece", "__times", "__epoch", "__copies", "__id", "mix_id", "mix_times", "mix_epoch", "spread", "times", "copies", "told", "order", "sets", "to", "before"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (2, 1, 1), (2, 1, 0), (3, 0, 0), (5, None, None), (None, 1, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "hilbert": lambda d, l: hilbert.hilbert_shards(d, 4),
    "minhash": lambda d, l: minhash.near_duplicates(d, 2),
    "toxicity": toxicity.toxicity,
    "media": lambda d, l: media.text_media(d),
    "langid": lambda d, l: langid.language_id(d),
    "chunking": lambda d, l: chunking.fingerprints(d),
    "lattice": lambda d, l: lattice.encode_documents(d),
    "token_counts": lambda d, l: token_counts.token_counts(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(docs, labels, name):
    got = OPERATORS[name](docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)
    by_id: dict = {}
    for r in got:
        if "shard" not in r:  # rows of one text may lie in different slots
            by_id.setdefault(r["doc_id"], set()).add(str({k: v for k, v in r.asDict().items() if k not in ("edited_sha256", "edited_fingerprint", "near_edited", "near_next")}))
    assert len(by_id.get(2, {0})) == 1


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, labels, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_defined_values(docs, labels):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs, 2).collect() if r["doc_id"] is not None}
    assert (got[1]["component_id"], got[2]["component_id"], got[2]["kept"]) == (1, 1, False)
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) for i in (3, 4, 6)] == [(0, 3, True), (0, 4, True), (0, 6, True)] and got[8]["n_shingles"] == 1
    lang = {r["doc_id"]: r["lang_pred"] for r in langid.language_id(docs).collect()}
    assert lang[3] == lang[4] == lang[6] == lang[7] == "und" and lang[1] != "und"
    counts = {r["doc_id"]: r for r in token_counts.token_counts(docs).collect()}
    assert counts[3]["n_tokens"] == counts[4]["n_tokens"] == counts[4]["n_bytes"] == 0 and counts[5]["over_limit"]
    near = {r["doc_id"]: r for r in chunking.fingerprints(docs).collect()}
    assert near[3]["near_next"] == 1.0 and near[1]["near_next"] == 1.0 and near[8]["near_next"] in (0.0,)
    found = {r["doc_id"]: r for r in media.text_media(docs).collect()}
    assert found[3]["payload_bytes"] == 64 and found[3]["payload_sha256"] == found[4]["payload_sha256"] and found[3]["n_bytes"] == 0


def test_rows_without_id_are_not_held_out(docs, labels):
    for table in (langid.language_id(docs), toxicity.toxicity(docs, labels)):
        assert {r["held_out"] for r in table.filter("doc_id is null").collect()} == {False}


def test_languages_beyond_the_bound_fail(docs, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        langid.language_id(docs)


def test_rows_without_id_are_dealt_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(chunking, "TASK_BYTES", 200)
    texts = [f"text {k} " * 9 for k in range(60)] + ["same text here"] * 4
    rows = chunking.with_next(spark.createDataFrame([(None if k % 3 else k, t) for k, t in enumerate(texts)], "doc_id long, text string"))
    assert rows.filter("doc_id is null and tail = 0").select("range").distinct().count() > 8
    got = chunking.fingerprints(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect()
    assert len(got) == len(texts) and sum(r["near_next"] == 1.0 for r in got) == 3  # equal texts follow each other


def test_mixing_deals_rows_without_id_by_text(spark):
    rows = spark.createDataFrame([(None, f"text number {k}", "a") for k in range(3000)], "doc_id long, text string, source string")
    assert mixing.mix_sources(rows).select("block").distinct().count() > 1


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_of_odd_rows(spark, docs, tmp_path, empty):
    import corpus_pipeline

    table = docs.limit(0) if empty else docs.union(docs)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, 0), (8, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if empty:
        assert got == []
        return
    # Without letters, or one phrase repeated for half a million characters: no language. Of rows 1 and 2 the copies go; rows without doc_id stay.
    assert {r["doc_id"] for r in got} == {1, 8, None} and all(r["round_trip"] for r in got)


def test_mixing_edges(spark, docs):
    got = mixing.mix_sources(docs).collect()
    assert {str(r["doc_id"]) for r in got} == {str(r[0]) for r in ROWS}
    assert {r["source"] for r in got} == {"a", "b", "c", None}
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_filters_keep_columns(spark, docs, labels):
    for kept in (toxicity.without_toxic(docs, labels), langid.with_known_language(docs), minhash.deduplicated(docs)):
        assert kept.columns == docs.columns and 0 < kept.count() <= len(ROWS)
    assert minhash.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_labels_missing(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.toxicity(docs, one).collect()} <= {0.0, 1.0}


def test_html_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (None, None, "text only, no markup at all."), (4, "u", "<div" * 5000), (5, "u", "<div>" * 3000 + "deep"), (6, "u", "<script>if (a < b) </p>"), (7, "u", "<a href='x" + "y" * 200_000)]
    got = {r["page_id"]: r for r in html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))).collect()}
    assert set(got) == {r[0] for r in rows} and got[1]["text"] == got[2]["text"] == "" and got[1]["n_chars"] == 0
    assert html_text.extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
