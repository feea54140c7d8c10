from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossa.llm.common import id_remainder
from glossa.llm.language import LanguageSettings, language_mixture, learn_languages, predict_language
from glossa.llm.quality import QualityModel, QualitySettings, keep_predicted, learn_quality, score_quality, term_counts, vote


def test_held_out_quality(small):
    docs, labels = small("documents"), small("labels")
    model = learn_quality(docs, labels.filter(id_remainder("doc_id", 3) != 1))
    scored = score_quality(docs.withColumn("score", F.lit("clash")), model)
    assert scored.columns[-2:] == ["score", "predicted"]
    held = scored.join(labels, "doc_id").filter(id_remainder("doc_id", 3) == 1).collect()
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    kept = {r.doc_id for r in keep_predicted(docs, model).collect()}
    assert kept == {r.doc_id for r in scored.collect() if r.predicted}


def test_quality_odd_rows(documents, spark):
    rows = [(1, None), (2, ""), (3, "word " * 20_000), (3, "word " * 20_000), (None, "the of and"), (4, "x" * 200_000)]
    docs = documents(rows)
    labels = spark.createDataFrame([(1, 0, None), (3, 1, None), (9, 1, 0), (2, 7, None), (None, None, None)], "doc_id long, quality int, toxic int")
    got = score_quality(docs, learn_quality(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    model = learn_quality(docs, labels.limit(0))
    assert {r.score for r in score_quality(docs, model).collect()} == {0.5}
    assert score_quality(docs.limit(0), model).collect() == []


def test_votes_equal_brute_force():
    random = np.random.default_rng(1)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    vectors, labels = unit(random.standard_normal((700, 12))), (random.random(700) < 0.8).astype(float)
    settings = QualitySettings(neighbours=9)
    model = QualityModel(np.ones(1), np.eye(12), vectors.astype(np.float32), labels, labels.mean())
    latent = random.standard_normal((1100, 12))
    got = vote(latent, model, settings)
    for i in range(0, 1100, 53):
        cosine = vectors @ (latent[i] / np.linalg.norm(latent[i]))
        near = np.argsort(-cosine)[:9]
        weight = np.exp(settings.sharpness * cosine[near]) * np.where(labels[near] == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
        assert got[i] == pytest.approx((weight * labels[near]).sum() / weight.sum(), abs=1e-5)


def test_terms_cover_the_whole_text():
    assert term_counts("a b " * 5000 + "zebra", 8192) != term_counts("a b " * 5000, 8192)
    assert term_counts(None, 8192) == term_counts("", 8192)


def test_terms_cover_long_words():
    line = "".join(chr(0x4E00 + i * 7 % 5000) for i in range(300))
    changed = [line[:i] + "a" + line[i + 1 :] for i in (0, 63, 64, 150, 299)]
    assert all(term_counts(c, 8192) != term_counts(line, 8192) for c in changed)
    names = "one,two,three"
    assert all(term_counts(names.replace(w, "other"), 8192) != term_counts(names, 8192) for w in names.split(","))


def test_held_out_language(small):
    docs = small("documents")
    model = learn_languages(docs.filter(id_remainder("doc_id", 4) != 2).select("text", "lang"))
    held = predict_language(docs, model).filter(id_remainder("doc_id", 4) == 2).collect()
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.97


EN = "the house on the hill was old and the people who lived there knew that it would not stand for ever "
DE = "das haus auf dem huegel war alt und die leute die dort wohnten wussten dass es nicht ewig stehen wuerde "


@pytest.fixture(scope="module")
def two_languages(documents):
    rows = [(i, EN, "en") for i in range(20)] + [(20 + i, DE, "de") for i in range(20)] + [(90, "zzz", None)]
    return learn_languages(documents(rows).select("text", "lang"))


def test_mixture_of_languages(two_languages):
    settings = LanguageSettings()
    mixed = language_mixture((EN * 6 + DE * 2).encode(), two_languages, settings)
    assert [m[0] for m in mixed] == ["en", "de"]
    assert mixed[0][1] == pytest.approx(0.75, abs=0.08) and sum(m[1] for m in mixed) == pytest.approx(1)
    assert [m[0] for m in language_mixture((DE * 3).encode(), two_languages, settings)] == ["de"]


def test_mixture_of_many_languages(documents):
    random = np.random.default_rng(3)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    # Seven invented languages, each of thirty words of its own.
    words = [["".join(random.choice(letters, 6)) for _ in range(30)] for _ in range(7)]
    text = lambda i, n: " ".join(random.choice(words[i], n))
    model = learn_languages(documents([(i, text(i % 7, 200), f"l{i % 7}") for i in range(70)]).select("text", "lang"))
    for n in (1, 5, 6, 7):
        mixed = language_mixture(" ".join(text(i, 100) for i in range(n)).encode(), model, LanguageSettings())
        assert {m[0] for m in mixed} == {f"l{i}" for i in range(n)}
        assert all(m[1] == pytest.approx(1 / n, abs=0.05) for m in mixed)


def test_language_odd_rows(documents, two_languages):
    rows = [(1, None), (2, ""), (3, "123 !? \n"), (4, EN), (4, EN), (None, DE), (5, DE * 2000), (6, "語"), (7, "a")]
    got = predict_language(documents(rows).withColumn("lang_pred", F.lit(1)), two_languages).collect()
    named = {r.doc_id: r.lang_pred for r in got}
    assert named[1] == named[2] == named[3] == "und" and named[4] == "en" and named[None] == named[5] == "de"
    assert named[6] in ("en", "de") and named[7] in ("en", "de")
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(rows)


def test_language_without_labels(documents):
    docs = documents([(1, EN, None)])
    model = learn_languages(docs.select("text", "lang"))
    assert [r.lang_pred for r in predict_language(docs, model).collect()] == ["und"]
    assert predict_language(docs.limit(0), model).collect() == []
    many = documents([(i, "a b", f"l{i}") for i in range(5)])
    with pytest.raises(ValueError, match="more than 3 languages"):
        learn_languages(many.select("text", "lang"), LanguageSettings(most_languages=3))
