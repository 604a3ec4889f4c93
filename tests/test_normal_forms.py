import unicodedata

from kinfold.plans import registry


def test_normal_forms_take_whole_texts(spark, tmp_path):
    texts = ["", None, "plain", "x" * 300 + "é", "ﬁ①Ｗ" * 200, "naïve ½ İstanbul ß 数字 " * 50, "end "]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in registry.queries()["normal_forms"](spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = (None, None) if text is None else (unicodedata.normalize("NFKC", text), unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode())
        assert (got[i].nfkc, got[i].base_letters) == want
