import zipfile

import pytest

from kinfold import cli
from kinfold.operators import blocking, keys, preprocess
from kinfold.sources import reports, sinks, tables
from kinfold.streaming import incremental

AT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Sources and ground truth as files."""
    at = tmp_path_factory.mktemp("root")
    for split in ("train", "test"):
        for i in (1, 2, 3):
            tables.view(spark, AT, f"s{i}").coalesce(2).write.options(sep="\t", header=True).csv(str(at / split / f"source{i}.tsv"))
    tables.view(spark, AT, "gt").coalesce(1).write.options(sep="\t", header=True, emptyValue="").csv(str(at / "train" / "ground_truth.tsv"))
    return at


def run(spark, *argv):
    return cli.main(list(map(str, argv)), spark)


def test_train_then_predict(spark, root, tmp_path):
    with pytest.raises(SystemExit):
        run(spark, "train", "--root", root, "--out", tmp_path / "m")
    report = run(spark, "train", "--root", root, "--out", tmp_path / "m", "--confirm-full", "--extended")
    assert report["validation"]["macro_f05"] > 0.7 and len(report["sweep"]) == 19 and len(report["importances"]) == 34
    assert reports.read_report(spark, str(tmp_path / "m" / "report"))["threshold"] == report["threshold"]
    said = run(spark, "predict", "--root", root, "--out", tmp_path / "p", "--matcher", tmp_path / "none", "--matcher", tmp_path / "m", "--smoke-n", 40)
    assert said["check"] == {"n_rows": 40, "n_ids": 40, "n_missing": 0, "n_unknown": 0} and said["matcher"] == str(tmp_path / "m")
    with zipfile.ZipFile(tmp_path / "p" / "results.zip") as z:
        assert z.namelist() == ["matching_results.tsv", "candidate_pairs.tsv"]
        lines = z.read("matching_results.tsv").decode().splitlines()
        assert lines[0] == "source1_entity_id\tmatched_entity_ids" and len(lines) == 41 and lines[1:] == sorted(lines[1:])
    # the same against a finished index
    run(spark, "ingest", "--root", root, "--out", tmp_path / "i")
    again = run(spark, "predict", "--root", root, "--out", tmp_path / "q", "--matcher", tmp_path / "m", "--smoke-n", 40, "--index", tmp_path / "i")
    with zipfile.ZipFile(tmp_path / "q" / "results.zip") as z:
        assert z.read("matching_results.tsv").decode().splitlines() == lines
    assert again["threshold"] == report["threshold"]
    with pytest.raises(SystemExit):
        run(spark, "predict", "--root", root, "--out", tmp_path / "r", "--matcher", tmp_path / "none")
    with pytest.raises(Exception):
        run(spark, "train", "--root", root, "--out", tmp_path / "m", "--max-s1", 60)  # what is there stays


def test_compare_validate_inspect_bench(spark, root, tmp_path):
    report = run(spark, "validate", "--root", root, "--out", tmp_path / "v", "--max-s1", 80, "--distractors", 40)
    assert report["blocking"]["total_s1_entities"] == 80 and not (tmp_path / "v" / "matcher").exists()
    report = run(spark, "inspect", "--root", root, "--out", tmp_path / "s")
    assert {r["source"] for r in report["sources"]} == {"S1", "S2", "S3"} and set(report["broken_lines"].values()) == {0} and report["matches"]
    report = run(spark, "bench", "--root", root, "--out", tmp_path / "b", "--sizes", 10, 20)
    assert [r["n_s1"] for r in report["runs"]] == [10, 20] and report["runs"][1]["verdict"] in ("GO", "NOT READY")


def test_index_is_made_once_and_anew_when_cut_off(spark, root, tmp_path):
    at = tmp_path / "index"
    first = run(spark, "ingest", "--root", root, "--out", at, "--profile", "v2")
    assert not first["reused"] and run(spark, "ingest", "--root", root, "--out", at, "--profile", "v2") == first | {"reused": True}
    index, vocabulary, _ = sinks.read_index(spark, str(at))
    s1, pool = tables.view(spark, AT, "s1"), tables.pool(spark, AT)
    rows = lambda df: sorted((r.s1_id, r.candidate_id, round(r.score, 6), r.rnk) for r in df.collect())
    assert rows(blocking.candidates_from_index(s1, index, keys.V2, vocabulary)) == rows(blocking.candidates(s1, pool, keys.V2))
    (at / "sources" / "_SUCCESS").unlink()  # as if it had been cut off
    with pytest.raises(ValueError):
        sinks.read_index(spark, str(at))
    assert run(spark, "ingest", "--root", root, "--out", at, "--profile", "v2") == first
    assert run(spark, "ingest", "--root", root, "--out", at, "--remove") == {"removed": True} and not at.exists()


def test_lines_and_quoted_breaks(spark, tmp_path):
    (tmp_path / "x.tsv").write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\n1\t"two\nlines"\t"a ""b"""\tus\n2\tplain\t\tus\n')
    assert tables.broken_lines(spark, str(tmp_path / "x.tsv")) == 2
    rows = {r.entity_id: r for r in tables.read_tsv(spark, str(tmp_path / "x.tsv"), multi_line=True).collect()}
    assert rows["1"].business_name == "two\nlines" and rows["1"].business_address == 'a "b"' and rows["2"].business_address is None
    (tmp_path / "y.tsv").write_text("entity_id\tbusiness_name\n1\tx\n")
    assert tables.read_tsv(spark, str(tmp_path / "y.tsv"), strict=False).first().country is None
    assert tables.record_of(tables.read_tsv(spark, str(tmp_path / "y.tsv"), strict=False), "1")["business_name"] == "x"
    assert tables.record_of(tables.read_tsv(spark, str(tmp_path / "y.tsv"), strict=False), "9") is None


def test_ids_that_come_again_replace_and_counts_are_strict(spark, tmp_path):
    folder = tmp_path / "in"
    spark.createDataFrame([("S2-1", "Old Name", "1 Oak St", "us"), ("S2-2", "Stays", None, "us")], tables.RECORD).coalesce(1).write.options(sep="\t", header=True).csv(str(folder))
    ingest = lambda: incremental.ingest_keys(incremental.record_stream(spark, str(folder)), str(tmp_path / "k"), str(tmp_path / "r"), str(tmp_path / "c")).awaitTermination()
    ingest()
    spark.createDataFrame([("S2-1", "New Name", "1 Oak St", "us")], tables.RECORD).coalesce(1).write.mode("append").options(sep="\t", header=True).csv(str(folder))
    ingest()  # goes on where the first run ended
    records = incremental.latest(spark, str(tmp_path / "r"))
    assert {r.entity_id: r.name_norm for r in records.collect()} == {"S2-1": "new name", "S2-2": "stays"}
    assert incremental.latest(spark, str(tmp_path / "k")).where("key like '%old%'").count() == 0
    incremental.check_count(records, 2)
    with pytest.raises(ValueError):
        incremental.check_count(records, 3)


def test_document_frequencies_of_parts_are_those_of_all(spark):
    from kinfold.operators import features

    names = preprocess.preprocess(tables.pool(spark, AT)).select("name_norm", "entity_id")
    parts = [names.where(f"abs(hash(entity_id)) % 3 = {i}") for i in range(3)]
    state = None
    for part in parts:
        state = incremental.add_documents(state, part)
    rows = lambda df: sorted((r.token, r.df, round(r.idf, 9)) for r in df.select("token", "df", "idf").collect())
    assert rows(incremental.idf_of(state)) == rows(features.token_idf(names))


def test_shards(spark, tmp_path):
    pool = tables.pool(spark, AT)
    held = sinks.write_shards(pool, str(tmp_path / "s"), 4).collect()
    assert sum(r.n for r in held) == pool.count() and {r.shard for r in held} == {0, 1, 2, 3} and {r.source for r in held} == {"S2", "S3"}
