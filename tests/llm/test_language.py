"""Operator 7: held-out accuracy and the odd cases."""
import numpy as np
from pyspark.sql import functions as F

from acct_health.llm import language


def test_held_out_accuracy(spark):
    got = language.op7_language(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_folded_weights_equal_the_kernel_machine():
    texts = ["the cat and the dog", "of the house is here", "der hund und die katze", "das haus ist gross", "le chat et le chien", "la maison est ici"]
    langs = ["en", "en", "de", "de", "fr", "fr"]
    model = language.Model(texts, langs)
    assert model.predict(texts)[0] == langs
    spectrum = language.Spectrum(model.alphabet)
    sets = [set(spectrum.grams(t)[0].tolist()) for t in texts]
    kernel = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets] for a in sets])
    values, vectors = np.linalg.eigh(kernel)
    phi = np.column_stack([kernel @ (vectors / np.sqrt(values)), np.ones(6)])
    y = np.where(np.array(langs)[:, None] == np.array(model.langs)[None], 1.0, -1.0)
    penalty = language.RIDGE * np.eye(7)
    penalty[-1, -1] = 0
    beta = np.linalg.solve(phi.T @ phi / 2 + penalty / 3, phi.T @ y / 2)
    want = np.clip(((phi @ beta).max(axis=1) + 1) / 2, 0, 1)
    assert np.allclose(model.predict(texts)[1], want, atol=1e-4)


def test_grams_in_slices(monkeypatch):
    spectrum = language.Spectrum(np.array([ord(c) for c in "abcde"], np.uint32))
    text = "Abc  de!!caB é zz a b"
    whole = spectrum.grams(text)[0].tolist()
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(language, "SLICE", size)
        assert spectrum.grams(text)[0].tolist() == whole


def test_odd_rows(odd, empty):
    model = language.learn(odd)
    rows = language.identified(odd.withColumn("score", F.lit("old")), model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not lettered)
    assert language.identified(empty, language.learn(empty)).count() == 0
    assert {r["lang_pred"] for r in language.identified(odd, language.learn(empty)).collect()} == {"und"}
    kept = language.drop_undetermined(odd)
    assert kept.columns == odd.columns and kept.where("text IS NULL OR text = ''").count() == 0
